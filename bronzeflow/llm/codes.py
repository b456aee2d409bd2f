"""Codes of vectors: codebooks per part, found and used by equal-average search.

A vector is cut into consecutive parts, and each part is named by the nearest
entry of its codebook. The squared distance of two parts is at least the squared
gap of their component sums, divided by their length. So entries are sorted by
sum and looked at outward from a part's own sum, until that bound strictly
exceeds the best distance: no nearer entry, and none at the same distance, is
left out. Parts of near sums search together, a block of entries at a time.

All arithmetic is on whole numbers and exact: in doubles while every number in
it has one, in Python's integers beyond. What goes through the driver are the
codebooks, ``ENTRIES`` vectors whatever the table holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Whole numbers are held to this size, and errors to the largest long.
LARGEST, MOST = 1 << 62, np.iinfo(np.int64).max
#: Parts that search together, and entries that they look at in one step.
BLOCK, STEP = 512, 16


@dataclass(frozen=True)
class Codebooks:
    """``length`` of the vectors that take part, and of each part its entries, one a row."""

    length: int
    parts: list[np.ndarray]

    def sha256(self) -> str:
        """Of all components as decimals, by part, entry and position, joined by commas."""
        flat = ",".join(str(x) for book in self.parts for entry in book.tolist() for x in entry)
        return hashlib.sha256(flat.encode()).hexdigest()

    def decoded(self, code: str) -> list[float]:
        """The vector that a code stands for."""
        picked = [int(code[i : i + 2], 16) for i in range(0, len(code), 2)]
        whole = [x for book, i in zip(self.parts, picked) for x in book[i].tolist()]
        return [x / SCALE for x in whole[: self.length]]


def complete(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    number = lambda x: x.cast("double")
    good = F.forall(
        vector,
        lambda x: F.coalesce((F.abs(number(x)) < float("inf")) & ~F.isnan(number(x)), F.lit(False)),
    )
    return F.coalesce(good, F.lit(False))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    carry: Sequence[str] = (),
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """``(row, code, error)`` of each vector that takes part, and the codebooks.

    * ``row`` is a struct of the id and the columns ``carry``, so no name can clash. ``code``
      holds two hex digits a part, ``error`` the squared distance of the vector's
      whole numbers ``floor(1024 * x)`` to those of its entries.
    * A vector takes part unless it is null or holds a null or non-finite
      component. All must have one length; rows of other lengths than the most
      common one (of equally common ones the longest) take no part. A length that
      is no multiple of four is filled up with zeros, which change no distance.
    * The codebooks start as the parts of the rows of the smallest ids, nulls
      last, rows of equal id by vector. Ties go to the lower entry; an entry that
      nothing is nearest to stays.
    * Whole numbers beyond 2^62 are held there, an error beyond a long at its end.
    * Equal rows have equal codes. An empty table gives no rows and no entries.
    """
    kept = vectors.where(complete(F.col(vector_col))).select(
        F.struct(*[F.col(c) for c in dict.fromkeys([id_col, *carry])]).alias("row"),
        F.col(id_col).alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    lengths = kept.groupBy(F.size("vector").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = common["length"] if common else -1
    kept = kept.where(F.size("vector") == length)
    books = _first_entries(kept, length)
    for _ in range(rounds if common else 0):
        books = _moved(kept, books)
    schema = T.StructType([kept.schema["row"]]).add("code", "string").add("error", "long")
    return kept.select("row", "vector").mapInArrow(_coder(books), schema), books


def _first_entries(kept: DataFrame, length: int) -> Codebooks:
    """Parts of the rows that come first by id."""
    order = [F.asc_nulls_last("id"), F.asc("vector")]
    # The id they end at comes first, so that vectors of few partitions move.
    last = kept.select("id").orderBy(order[0]).limit(ENTRIES).agg(F.max("id"), F.count("id")).first()
    few = kept.where(F.col("id") <= last[0]) if last[1] == ENTRIES else kept.where("false")
    # With fewer ids than entries the whole table is hardly larger than a codebook,
    # but for rows without an id.
    few = few if last[1] == ENTRIES else kept
    rows = few.select("id", "vector").orderBy(*order).limit(ENTRIES).collect()
    whole = whole_numbers(np.array([r.vector for r in rows], dtype=np.float64).reshape(len(rows), max(length, 0)))
    return Codebooks(length, [p.astype(np.int64) for p in cut(whole)])


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(1024 * x)`` of every component, as doubles that hold a whole number."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * float(SCALE)), -float(LARGEST), float(LARGEST))


def cut(whole: np.ndarray) -> list[np.ndarray]:
    """The parts of all vectors, filled up with zeros to one width."""
    width = -(-whole.shape[1] // PARTS)
    filled = np.pad(whole, ((0, 0), (0, width * PARTS - whole.shape[1])))
    return [filled[:, p * width : (p + 1) * width] for p in range(PARTS)]


def _moved(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry put at the mean of the parts nearest to it, components floored."""
    schema = "part int, entry int, n long, total array<decimal(38,0)>"
    sums = kept.select("row", "vector").mapInArrow(_summer(books), schema)
    flat = sums.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    # As many rows as the codebooks have components.
    found = flat.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    moved = [book.copy() for book in books.parts]
    for r in found.collect():
        moved[r.part][r.entry, r["at"]] = int(r.x) // r.n
    return Codebooks(books.length, moved)


def nearest_entries(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each point (a row of whole numbers) the nearest entry, and the squared distance."""
    n, width = points.shape
    if not n or not width:
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    largest = int(max(np.abs(points).max(), abs(int(entries.max())), abs(int(entries.min()))))
    # The largest number below is a squared gap of sums.
    if (2 * width * largest) ** 2 < 1 << 53:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    else:
        points, entries = points.astype(np.int64).astype(object), entries.astype(object)
    beyond = width * (2 * largest) ** 2 + 1
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, entries = sums[order], entries[order]
    squares = (entries * entries).sum(axis=1)
    own_sums = points.sum(axis=1)
    best = np.full(n, beyond, dtype=points.dtype)
    who = np.full(n, len(order), dtype=np.int64)
    by_sum = np.argsort(own_sums, kind="stable")
    for lo in range(0, n, BLOCK):
        rows = by_sum[lo : lo + BLOCK]
        s = own_sums[rows]
        left = right = int(np.searchsorted(sums, s[len(s) // 2]))
        searching = True
        while searching:
            searching = False
            for side in ("right", "left"):
                end = right if side == "right" else left - 1
                if not 0 <= end < len(sums):
                    continue
                gap = s - sums[end]
                # Sums that have not been passed yet, or whose bound is not beyond the best.
                ahead = gap >= 0 if side == "right" else gap <= 0
                open_ = rows[(ahead | (gap * gap <= width * best[rows])).astype(bool)]
                if not len(open_):
                    continue
                if side == "right":
                    some = slice(right, min(right + STEP, len(sums)))
                    right = some.stop
                else:
                    some = slice(max(left - STEP, 0), left)
                    left = some.start
                x = points[open_]
                far = (x * x).sum(axis=1)[:, None] - 2 * (x @ entries[some].T) + squares[some]
                least = far.min(axis=1)
                first = np.where(far == least[:, None], order[some], len(order)).min(axis=1)
                better = (least < best[open_]) | ((least == best[open_]) & (first < who[open_]))
                better = better.astype(bool)
                best[open_[better]] = least[better]
                who[open_[better]] = first[better]
                searching = True
    return who, best


def _matrices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Of each batch the column ``row``, and its vectors as whole numbers."""
    for batch in batches:
        flat = np.asarray(batch.column(1).flatten(), dtype=np.float64)
        yield batch.column(0), whole_numbers(flat.reshape(batch.num_rows, length))


def _summer(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books.parts]
        totals = [np.zeros(b.shape, dtype=object) for b in books.parts]
        for _, whole in _matrices(batches, books.length):
            for p, points in enumerate(cut(whole)):
                who, _ = nearest_entries(points, books.parts[p])
                small = len(whole) * float(np.abs(points).max(initial=0)) < LARGEST
                some = np.zeros(totals[p].shape, dtype=np.int64 if small else object)
                np.add.at(some, who, points.astype(np.int64).astype(some.dtype))
                totals[p] += some
                counts[p] += np.bincount(who, minlength=len(counts[p]))
        met = [(p, e) for p, c in enumerate(counts) for e in np.flatnonzero(c).tolist()]
        columns = [
            pa.array([p for p, _ in met], pa.int32()),
            pa.array([e for _, e in met], pa.int32()),
            pa.array([int(counts[p][e]) for p, e in met], pa.int64()),
            pa.array(
                [[Decimal(int(x)) for x in totals[p][e]] for p, e in met],
                pa.list_(pa.decimal128(38, 0)),
            ),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "total"])

    return run


def _coder(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, whole in _matrices(batches, books.length):
            found = [nearest_entries(x, b) for x, b in zip(cut(whole), books.parts)]
            names = np.stack([who for who, _ in found], axis=1).astype(np.uint8)
            codes = [x.tobytes().hex() for x in names]
            errors = [min(sum(int(d) for d in e), MOST) for e in zip(*[far for _, far in found])]
            columns = [rows, pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "code", "error"])

    return run
