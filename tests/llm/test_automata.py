import hashlib
import random

import pytest

from bronzeflow.llm import automata
from bronzeflow.llm.queries import op7_substring_dedup

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, window):
    """Indices of the words of each row that a smaller document's windows cover."""
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, d), d)
    found = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < d:
                gone.update(range(i, i + window))
        found.append((words, gone))
    return found


def made_rows(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "dé", "ee e", "f"])
    passages = [[word() for _ in range(rng.randint(3, 30))] for _ in range(5)]
    rows = []
    for k in range(70):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            words += p[rng.randint(0, 5) :] if rng.random() < 0.4 else p
            words += [word() for _ in range(rng.randint(0, 4))]
        rows.append((k // 2 if k > 50 else k, rng.choice([" ", "\n", "\x0b "]).join(words)))
    return rows + [(900, ""), (901, None), (902, "a " * 40), (903, "a " * 60), (904, rows[3][1]), (2, rows[5][1])]


@pytest.mark.parametrize(("seed", "crowded"), [(1, 2000), (2, 3), (3, 10)])
def test_against_brute_force(spark, seed, crowded):
    rows = made_rows(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, own_id int")
    got = automata.without_held_passages(df, window=6, gram=3, crowded=crowded)
    assert got.columns == [*df.columns, "kept_words", "kept_words_spans"]
    wanted = []
    for (d, t), (words, gone) in zip(rows, brute(rows, 6)):
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        wanted.append((d, t or "", kept, len(gone)))
    size = lambda spans: sum(s.end - s.start for s in spans or [])
    found = [(r.doc_id, r.text or "", r.kept_words, size(r.kept_words_spans)) for r in got.collect()]
    assert sorted(found) == sorted(wanted)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    wanted = []
    for (d, _), (words, gone) in zip(rows, brute(rows, 13)):
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        wanted.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, op7_substring_dedup(spark, SF_DIR).collect())) == sorted(wanted)


def test_null_ids_and_empty_table(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, text), (None, text), (7, text)], "doc_id long, text string")
    got = {r.doc_id: r.kept_words for r in automata.without_held_passages(df).collect()}
    assert got == {None: "", 7: text}
    assert automata.without_held_passages(df.limit(0)).count() == 0


def test_automaton_knows_all_windows():
    rng = random.Random(9)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 25))] for _ in range(30)]
    automaton = automata.SuffixAutomaton()
    for k, t in enumerate(texts):
        automaton.add(t, 30 - k)
    automaton.settle()
    for t in texts + [[b"c", b"z", b"a", b"b", b"a"]]:
        for n in (1, 3, 4):
            wanted = [
                min((30 - k for k, o in enumerate(texts) if any(o[j : j + n] == t[i : i + n] for j in range(len(o) - n + 1))), default=automata.NOBODY)
                for i in range(len(t) - n + 1)
            ]
            assert automaton.window_owners(t, n) == wanted
