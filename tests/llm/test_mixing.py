import random
from collections import Counter

import numpy as np
import pytest

from bronzeflow.llm import mixing
from bronzeflow.llm.queries import op9_mixing

SF_DIR = "/root/testdata/sf0.01"


def targets(sizes):
    """Weights 1, 2, 3 in code point order, null last; what is above 3 sizes is reshared."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        share = {s: left * weights[s] / sum(weights[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > 3 * sizes[s]}
        if not over:
            return share | {s: 3.0 * sizes[s] for s in stopped}
        stopped |= over


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = op9_mixing(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter(
        (d.doc_id, len((d.text or "").encode().split())) for d in docs
    )
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len((d.text or "").encode().split())
    wanted = targets(sizes)
    taken, longest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 2 * longest[s]
    assert sorted(rows) == sorted(op9_mixing(spark, SF_DIR).collect())


def test_targets_stop_and_are_reshared(spark):
    sizes = {"a": 900, "b": 10, "c": 60, "d": 5, None: 25, "e": 0}
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, words long, rows int")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))
    assert sum(got.values()) == pytest.approx(1000)


def test_units_of_odd_kinds(spark):
    rng = random.Random(4)
    rows = [(i, " w" * rng.randint(0, 30), rng.choice(["s", "t", None])) for i in range(400)]
    rows += [(None, "a b", "s")] * 30 + [(1, None, "s"), (2, "", None), (3, "x y", "only")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, copies int")
    got = mixing.mix(df, block=50)
    decided = got.collect()
    assert len(decided) == len(rows)
    # Equal rows are divided: the copies of two of them differ by one at most.
    repeated = {r.copies for r in decided if r.doc_id is None and r["size"] == 2}
    assert max(repeated) - min(repeated) <= 1
    mixed = mixing.mixed_documents(df, block=50)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in decided)
    for s in ("s", "t", None):
        own = [r for r in decided if r.source == s]
        total = sum(r.copies * r["size"] for r in own)
        assert abs(total - own[0].target) <= 2 * 30


def test_a_group_of_equal_rows_does_not_miss_the_target(spark):
    """A source of one row a thousand times over, and rows without an id that differ."""
    rows = [(None, "a b c", "s")] * 1000 + [(i, "d e f g", "t") for i in range(100)]
    rows += [(None, f"x{i} y", "u") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    decided = mixing.mix(df).collect()
    for s in "stu":
        own = [r for r in decided if r.source == s]
        total = sum(r.copies * r["size"] for r in own)
        assert abs(total - own[0].target) <= 2 * own[0]["size"]
        assert all(0 <= r.copies <= 3 for r in own)
        assert max(r.copies for r in own) - min(r.copies for r in own) <= 1
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in decided)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0
    assert mixing.mixed_documents(df).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(6)
    p, w = np.full(500, 0.3), rng.integers(1, 400, 500).astype(float)
    n = np.ones(500)
    before = (p * n).sum(), (p * w).sum()
    left = mixing._flight(p, n, w, rng.random(500))
    assert len(left) <= 2
    assert ((p == 0) | (p == 1)).sum() == 500 - len(left)
    assert ((p * n).sum(), (p * w).sum()) == pytest.approx(before)


def test_documents_of_a_mix_are_moved_once(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(i % 40, f"w{i % 40} " * (1 + i % 9), f"s{i % 3}") for i in range(200)]
    docs = session.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed_documents(docs)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in text.splitlines() if "FileScan" in line and "doc#" in line]) == 1
    copies = mixing.mix(docs).agg({"copies": "sum"}).first()[0]
    assert found.count() == copies
