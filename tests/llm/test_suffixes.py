import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from bronzeflow.llm import repeats, suffixes
from bronzeflow.llm.queries import op2_suffix_dedup

SF_DIR = "/root/testdata/sf0.001"


def brute(texts, window):
    """Maximal runs of bytes of each text that windows starting elsewhere too cover."""
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    found = []
    for t in texts:
        runs = []
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + window
                else:
                    runs.append([i, i + window])
        found.append([tuple(r) for r in runs])
    return found


def without(text, runs):
    at, parts = 0, []
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def made_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé日 ", k=rng.randint(1, 6)))
    passages = ["".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p))
            parts += [p[cut:] if rng.random() < 0.3 else p, "".join(word() for _ in range(rng.randint(0, 9)))]
        texts.append("".join(parts))
    return texts + ["", None, "a" * 300, "ab" * 150, texts[0], texts[0], texts[1] * 3, "\0" * 90]


@pytest.mark.parametrize(("seed", "crowded"), [(1, 2000), (2, 3), (3, 2000), (4, 12)])
def test_against_brute_force(spark, seed, crowded):
    texts = made_texts(seed)
    df = spark.createDataFrame(
        [(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, text_key string"
    ).repartition(3)
    got = suffixes.without_repeats(df, window=40, gram=12, crowded=crowded)
    assert got.columns == [*df.columns, "kept_text", "kept_text_spans"]
    bodies = [(t or "").encode() for t in texts]
    wanted = brute(bodies, 40)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(texts)
    for i, (body, runs) in enumerate(zip(bodies, wanted)):
        assert [tuple(x) for x in rows[i].kept_text_spans or []] == runs, i
        assert bytes(rows[i].kept_text) == without(body, runs)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    bodies = [(r.text or "").encode() for r in docs]
    runs = brute(bodies, 200)
    wanted = sorted(
        (r.doc_id, len(b), sum(y - x for x, y in own), len(own), hashlib.sha256(without(b, own)).hexdigest())
        for r, b, own in zip(docs, bodies, runs)
    )
    assert sorted(map(tuple, op2_suffix_dedup(spark, SF_DIR).collect())) == wanted


def test_empty_table(spark):
    assert suffixes.without_repeats(spark.createDataFrame([], "text string")).count() == 0


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (5000, 6)).astype(np.uint64)
    order = suffixes.multikey_quicksort(words)
    assert words[order].tolist() == sorted(words.tolist())


def test_long_text_is_taken_in_stretches(monkeypatch):
    spec = repeats.Windows(40, 12, words=False)
    text = np.random.default_rng(2).integers(1, 4, 5000).astype(np.uint64)
    whole = repeats.anchors_of(text, np.array([0, len(text)]), spec)
    monkeypatch.setattr(repeats, "PIECE", 300)
    parts = repeats._long_anchors(text, spec)
    assert [x.tolist() for x in parts] == [x.tolist() for x in whole]


def test_buckets_grow_in_number_with_the_contexts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET", 2)
    asked, by_range = [], type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(
        type(spark.range(0)),
        "repartitionByRange",
        lambda self, n, *cols: asked.append(n) or by_range(self, n, *cols),
    )
    texts = made_texts(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = suffixes.without_repeats(df, window=40, gram=12).collect()
    assert asked and asked[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    bodies = [(t or "").encode() for t in texts]
    wanted = brute(bodies, 40)
    assert all([tuple(x) for x in r.kept_text_spans or []] == wanted[r.doc_id] for r in rows)


def vanishing_difference():
    """Steps between two texts that a polynomial over bytes modulo 2**64 does not see.

    Any odd base to the power of an even number is one modulo a power of two, so a
    product of such differences vanishes. The steps leave 40 bytes in the middle alone.
    """
    steps = np.array([1], dtype=object)
    for power, times in ((1, 2), (2, 3), (4, 3), (8, 3), (16, 1), (32, 1), (64, 1), (200, 1)):
        factor = np.zeros(power + 1, dtype=object)
        factor[0], factor[power] = -1, 1
        for _ in range(times):
            steps = np.convolve(steps, factor)
    return steps


def test_texts_made_for_a_polynomial_are_told_apart(spark):
    steps = vanishing_difference()
    assert sum(int(c) * pow(repeats.BASE, i, 1 << 64) for i, c in enumerate(steps)) % (1 << 64) == 0
    assert max(abs(int(c)) for c in steps) <= 94
    assert not any(steps[160:200])
    one = bytes(32 + max(0, int(c)) for c in steps).ljust(360, b"~")
    two = bytes(32 + max(0, -int(c)) for c in steps).ljust(360, b"~")
    df = spark.createDataFrame([(1, one.decode()), (2, two.decode())], "doc_id long, text string")
    rows = suffixes.without_repeats(df).collect()
    assert all(not r.kept_text_spans for r in rows)


def few_of_many(copies):
    """Two texts that differ at one end, with very many copies of each."""
    rng = random.Random(7)
    body = "".join(rng.choices("abcdefgh", k=400))
    return [body + "x" * 30] * copies + [body + "y" * 30]


def asked_by_stretches(spark, monkeypatch, texts, crowded, window, gram):
    """Contexts of crowded grams, and ranges of windows made of them, the spans being right."""
    counts, ranges_of = [], suffixes._ranges_of

    def counted(rows, *args):
        made = ranges_of(rows, *args)
        counts.append((rows.count(), made.count()))
        return made

    monkeypatch.setattr(suffixes, "_ranges_of", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = suffixes.without_repeats(df, window=window, gram=gram, crowded=crowded).collect()
    wanted = brute([t.encode() for t in texts], window)
    assert all([tuple(x) for x in r.kept_text_spans or []] == wanted[r.doc_id] for r in rows)
    return (counts[0][0] if counts else 0), sum(made for _, made in counts)


def test_copies_do_not_crowd_a_gram(spark, monkeypatch):
    texts = few_of_many(50)
    assert asked_by_stretches(spark, monkeypatch, texts, 20, 40, 12) == (0, 0)


def test_crowded_grams_are_not_expanded_window_by_window(spark, monkeypatch):
    rng = random.Random(8)
    other = lambda: "".join(rng.choices("pqrstuvw", k=250))
    passage = "".join(rng.choices("abcdefgh", k=230))
    texts = [other() + passage + other() for _ in range(60)]
    contexts, made = asked_by_stretches(spark, monkeypatch, texts, 5, 200, 40)
    assert contexts >= 60 and made < contexts * 161 / 4


def least_gram(spec):
    """A gram whose hash is so small that every window which holds it has its anchor there."""
    text = "".join(random.Random(9).choices("ijklmno", k=200_000))
    symbols, _ = spec.symbols([text.encode()])
    at = int(repeats.Sums(symbols, spec).of_each(spec.gram).argmin())
    return text[at : at + spec.gram]


def test_parts_that_few_contexts_share_are_not_cut_again(spark, monkeypatch):
    spec = repeats.Windows(200, 40, words=False, seed=7)
    monkeypatch.setattr(suffixes, "Windows", lambda *_, **__: spec)
    rng = random.Random(10)
    made = lambda k: "".join(rng.choices("pqrstuvw", k=k))
    hot, texts = least_gram(spec), []
    for _ in range(30):
        both = made(100) + hot + made(100)
        texts += [made(250) + both + made(250), made(250) + both + made(250)]
    contexts, rows = asked_by_stretches(spark, monkeypatch, texts, 5, 200, 40)
    assert contexts == 60 and rows <= 3 * contexts


def test_a_gram_that_fits_its_bucket_is_not_parted(spark, monkeypatch):
    rng = random.Random(11)
    made = lambda k: "".join(rng.choices("pqrstuvw", k=k))
    passages = made(230), made(230)
    texts = [made(20) + p + made(20) for _ in range(suffixes.CROWDED + 50) for p in passages]
    parted, ranges_of = [], suffixes._ranges_of
    monkeypatch.setattr(suffixes, "_ranges_of", lambda *a: parted.append(1) or ranges_of(*a))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = suffixes.without_repeats(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted = brute([t.encode() for t in texts], 200)
    assert all([tuple(x) for x in r.kept_text_spans or []] == wanted[r.doc_id] for r in rows)
    assert not parted
