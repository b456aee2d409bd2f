import random
import tracemalloc

import numpy as np
import pytest

from bronzeflow.llm import minhash
from bronzeflow.llm.queries import op10_minhash

SF_DIR = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").split(" ") if text else []
    words = [w for w in minhash_words(text or "")]
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def minhash_words(text):
    return text.encode().split()


def classes(rows, similarity=0.8):
    """Smallest id of the component of each row, by comparing all with all."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in by_shingle[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, common in near.items():
            if common >= similarity * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    by_text = {}
    for i, (_, t) in enumerate(rows):
        j = by_text.setdefault(t or "", i)
        parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        best[r] = min(best.get(r, d), d)
    return sorted((d, best[find(i)]) for i, (d, _) in enumerate(rows))


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.class_id) for r in op10_minhash(spark, SF_DIR).collect())
    assert got == classes(rows)


def test_group_of_near_copies_and_odd_texts(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows, at = [], 0
    for k in range(60):  # a chain: neighbours are near, the ends are not
        base[at % 120] = f"new{k}"
        at += 7
        rows.append((k, " ".join(base)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "a b"), (104, "a  b"), (105, "a b c")]
    rows += [(106, rows[3][1])] * 20
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, class_id int")
    got = minhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == classes(rows)
    assert {r.copies for r in got if r.doc_id == 106} == {21}
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in classes(rows)})


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert [tuple(r) for r in minhash.near_duplicates(df).collect()] == [(None, None, None, 2)] * 2
    assert minhash.deduplicated(df).count() == 1
    assert minhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("common", [400, 800, 950])
def test_signatures_estimate_jaccard(common):
    rng = np.random.default_rng(common)
    values = rng.integers(0, 1 << 63, 2000 - common, dtype=np.uint64)
    a, b = values[:1000], values[1000 - common :]
    owner = np.repeat([0, 1], [len(a), len(b)])
    name = minhash.signatures(np.concatenate([a, b]), owner, 2, 4096)
    agree = (name[0] == name[1]).mean()
    assert abs(agree - common / (2000 - common)) < 0.04


def test_signature_of_one_element_is_full():
    name = minhash.signatures(np.array([5], dtype=np.uint64), np.array([0]), 1, 96)
    assert (name != 0).all()


def test_darts_of_many_sets_are_not_held_together(monkeypatch):
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 60, minhash.AT_ONCE)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    elements = rng.integers(0, 1 << 63, len(owner), dtype=np.uint64)
    tracemalloc.start()
    name = minhash.signatures(elements, owner, len(sizes), 96)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    for darts in (1, 1 << 40):
        monkeypatch.setattr(minhash, "DARTS", darts)
        assert (minhash.signatures(elements, owner, len(sizes), 96) == name).all()


def test_long_texts_in_tiles(spark, monkeypatch):
    """Few very long texts and many short ones, all in large buckets, in tiles of few shingles."""
    monkeypatch.setattr(minhash, "LARGE", 1)
    monkeypatch.setattr(minhash, "TILE", 3)
    monkeypatch.setattr(minhash, "TILE_SHINGLES", 2000)
    rng = random.Random(5)
    long = [f"v{rng.randrange(10**6)}" for _ in range(30_000)]
    short = [f"s{rng.randrange(100)}" for _ in range(60)]
    rows = []
    for k in range(8):
        own = list(long)
        own[k * 900 : k * 900 + 3 + 200 * k] = [f"own{k}"] * (3 + 200 * k)
        rows.append((k, " ".join(own)))
    for k in range(8, 60):
        own = list(short)
        own[k % 60] = f"own{k}"
        own[(k * 7) % 60] = "other"
        rows.append((k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id) for r in minhash.near_duplicates(df).collect())
    assert got == classes(rows)
    assert len({c for _, c in got}) < len(rows)


def test_tile_against_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype(np.uint64) for _ in range(50)]
    tile = minhash.Tile()
    for k, x in enumerate(sets):
        tile.add(str(k).encode(), x.tobytes())
    for pivot in [*sets[:10], np.zeros(0, dtype=np.uint64)]:
        mine = set(pivot.tolist())
        wanted = {
            str(k).encode()
            for k, x in enumerate(sets)
            if mine and len(mine & set(x.tolist())) >= 0.5 * len(mine | set(x.tolist()))
        }
        assert tile.near(pivot.tobytes(), 0.5) == wanted
    assert minhash.Tile().near(sets[0].tobytes(), 0.5) == set()


def test_stretches_are_bounded_in_rows_and_bytes():
    texts = minhash.pa.array([b"x"] * 2500 + [b"y" * 100] * 3)
    parts = list(minhash.parts_of(texts, most=150))
    assert [p.start for p in parts[1:]] == [p.stop for p in parts[:-1]] and parts[-1].stop == 2503
    lengths = [1] * 2500 + [100] * 3
    assert all(p.stop - p.start == 1 or sum(lengths[p]) <= 150 for p in parts)
    many = list(minhash.parts_of(texts, most=10**6))
    assert max(p.stop - p.start for p in many) == minhash.AT_ONCE
