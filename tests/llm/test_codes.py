import hashlib
import math

import numpy as np
import pytest

from bronzeflow.llm import codes
from bronzeflow.llm.oracle import ORACLE_SQL
from bronzeflow.llm.queries import op12_vector_codes
from tests.compare import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, rounds=4):
    """``{(id, vector): (code, error)}`` and the codebooks, in Python's integers."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, v, [math.floor(1024 * x) for x in v]) for i, v in good]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-len(whole[0][2]) // 4)
    parts = [[(w + [0] * 4)[p * width : (p + 1) * width] for _, _, w in whole] for p in range(4)]
    books = [[list(x) for x in part[:256]] for part in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            met = {}
            for x in parts[p]:
                met.setdefault(nearest(x, books[p])[1], []).append(x)
            for n, xs in met.items():
                books[p][n] = [sum(column) // len(xs) for column in zip(*xs)]
    coded = []
    for row, (i, v, _) in enumerate(whole):
        found = [nearest(parts[p][row], books[p]) for p in range(4)]
        coded.append((i, "".join(f"{n:02x}" for _, n in found), min(sum(d for d, _ in found), codes.MOST)))
    return coded, books


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, books = codes.compress(df, **options)
    return by_id([(tuple(r)[0][0], r.code, r.error) for r in found.collect()]), books


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e7])
def test_against_brute_force(spark, scale):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8)) * scale
    rows = [(n * 3, (centres[n % 20] + rng.normal(size=8) * scale / 9).tolist()) for n in range(330)]
    rows += rows[:40] + [(5, None), (6, [None] * 8), (7, [float("nan")] * 8), (8, [float("inf")] * 8)]
    found, books = run(spark, rows)
    wanted, lists = brute(rows)
    assert found == by_id(wanted)
    assert [b.tolist() for b in books.parts] == lists
    flat = ",".join(str(x) for b in lists for e in b for x in e)
    assert books.sha256() == hashlib.sha256(flat.encode()).hexdigest()


def test_ties_go_to_the_lower_entry(spark):
    """Whole steps on a line: many parts lie between two entries, many entries are equal."""
    rows = [(n, [(n % 40) * 2 / 1024] * 4) for n in range(256)] + [(300 + n, [(2 * n + 1) / 1024] * 4) for n in range(39)]
    found, _ = run(spark, rows, rounds=0)
    assert dict((i, c) for i, c, _ in found)[300] == "00000000"
    assert found == by_id(brute(rows, 0)[0])
    assert run(spark, rows)[0] == by_id(brute(rows)[0])


def test_equal_sums_are_not_equal_entries():
    """All sums are equal, so the bound excludes nothing."""
    rng = np.random.default_rng(4)
    entries = rng.integers(-9, 9, size=(60, 6))
    entries[:, 5] = -entries[:, :5].sum(axis=1)
    points = rng.integers(-9, 9, size=(700, 6))
    who, far = codes.nearest_entries(points, entries)
    all_far = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (who == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()


@pytest.mark.parametrize("size", [3, 100, 1 << 20, 1 << 40, 1 << 61])
def test_search_is_exact_at_every_size(size):
    rng = np.random.default_rng(size % 97)
    entries = rng.integers(-size, size, size=(50, 5))
    points = np.concatenate([rng.integers(-size, size, size=(90, 5)), entries[:9]])
    who, far = codes.nearest_entries(points, entries)
    for x, w, d in zip(points.tolist(), who.tolist(), far):
        assert (int(d), w) == min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(entries.tolist()))


def test_odd_lengths_huge_numbers_and_null_ids(spark):
    rows = [(n, [n / 7, 1.0, -n / 3]) for n in range(20)] + [(None, [0.5, 0.5, 0.5]), (90, [1.0]), (91, []), (92, [1e300, 1.0, -1e300])]
    found, books = run(spark, rows)
    assert len(found) == 22 and books.length == 3
    huge = next(r for r in found if r[0] == 92)
    assert huge[2] == 0 and max(abs(int(x)) for b in books.parts for e in b for x in e) == codes.LARGEST
    assert len(books.decoded(found[0][1])) == 3


def test_empty_tables_and_clashing_names(spark):
    assert run(spark, [])[0] == [] and run(spark, [(1, None)])[0] == []
    df = spark.createDataFrame([(1, [1.0] * 4, "a", "b")], "vec_id long, embedding array<float>, code string, row string")
    found, _ = codes.compress(df, carry=["code", "row"])
    row = found.first()
    assert (row["row"]["vec_id"], row["row"]["code"], row["row"]["row"], row["code"]) == (1, "a", "b", "00000000")


def test_query(spark):
    assert spark_rows(op12_vector_codes(spark, SF_DIR)) == duck_rows(duck(SF_DIR), ORACLE_SQL["op12_vector_codes"])


def test_label_errors_with_null_labels(spark, tmp_path):
    rows = [(n, [float(n % 5), 0.5, 0.25, n / 9], None if n % 3 == 0 else n % 2) for n in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op12_vector_codes(spark, str(tmp_path)).collect()
    labels = {n: label for n, _, label in rows}
    totals = {}
    for r in found:
        totals[labels[r.vec_id]] = totals.get(labels[r.vec_id], 0) + r.error
    assert len(found) == 400 and all(r.label_error == totals[labels[r.vec_id]] for r in found)
