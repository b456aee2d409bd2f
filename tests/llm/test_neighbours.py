import numpy as np
import pytest
from pyspark.sql import functions as F

from bronzeflow.llm import neighbours
from bronzeflow.llm.queries import op3_nearest_neighbours

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, queries, k):
    """Sorted lists of ``(rank, id, score)`` of each query row."""
    found = []
    for n, (i, q) in enumerate(rows):
        if not queries(i):
            continue
        best = []
        for m, (j, c) in enumerate(rows):
            if m != n and len(c) == len(q):
                best.append((-sum((np.float64(a) * np.float64(b) for a, b in zip(q, c)), np.float64(0)), j))
        found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(best)[:k])]
    return sorted(found)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=7).tolist() for _ in range(90)]
    vectors += [vectors[4]] * 60 + [[1.0, 2.0, 3.0]] * 5 + [[-1e-3] * 7, [1e6] * 7]
    rows = [(i % 150, v) for i, v in enumerate(vectors)]
    odd = [(200, None), (300, [0.0] * 7), (400, [None] * 7), (500, [float("nan")] * 7), (600, [float("inf")] * 7)]
    df = spark.createDataFrame(
        [(i, v, "clash") for i, v in rows + odd], "vec_id long, embedding array<double>, score string"
    )
    got = neighbours.nearest(df, F.col("vec_id") % 10 == 0, k=8, block=32).collect()
    wanted = brute(rows, lambda i: i % 10 == 0, 8)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == wanted


def test_null_id_is_a_candidate_only(spark):
    df = spark.createDataFrame(
        [(None, [1.0]), (20, [1.0]), (21, [1.0])], "vec_id long, embedding array<float>"
    )
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 21), (2, None)]


def test_bounds_hold():
    rng = np.random.default_rng(0)
    q, c = (rng.normal(size=(50, 1500)) * rng.lognormal(size=(50, 1)) for _ in range(2))
    low, high = neighbours.bounds(neighbours.rounded(q), neighbours.rounded(c))
    exact = q @ c.T
    assert (low <= exact).all() and (exact <= high).all()


def test_huge_and_tiny_vectors_lose_no_neighbour(spark):
    big = [[1e200, 1e200], [1e160, -1e160], [-1e160, 1e155], [1e-200, 1e-310], [5e-324, 0.0], [3.0, -2.0]]
    rows = [(n * 10, v) for n, v in enumerate(big * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=30).collect()
    with np.errstate(all="ignore"):
        wanted = []
        for n, (i, q) in enumerate(rows):
            if i % 20:
                continue
            scores = [
                (-np.nan_to_num(np.float64(q[0]) * c[0] + np.float64(q[1]) * c[1], nan=-np.inf, posinf=np.inf, neginf=-np.inf), j)
                for m, (j, c) in enumerate(rows)
                if m != n
            ]
            wanted += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores))]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(wanted)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(20, [1.0])]])
def test_without_candidates(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert neighbours.nearest(df, F.col("vec_id") % 20 == 0).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op3_nearest_neighbours(spark, SF_DIR)
    assert got.dtypes[:4] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    wanted = brute(rows, lambda i: i % 20 == 0, 20)
    assert sorted(map(tuple, got.collect())) == wanted
