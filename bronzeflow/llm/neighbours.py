"""Nearest neighbours by a block matrix join of int8 product tiles.

Candidates and queries are packed into blocks; every pair of blocks meets in one
row, and so in one task. There the tile of int8 products comes first. What
rounding can have changed is bounded from the norms of the rounding errors, so
only pairs whose upper bound reaches the k-th best lower bound are computed again
in double precision from the original vectors. Heaps keep the best of a tile,
and the best of all tiles are ranked per query. No neighbour is missed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeflow.llm.common import scratch

#: Vectors of a block; blocks of wide vectors hold fewer, so that a tile has a bound.
BLOCK = 8192
BLOCK_BYTES = 4 << 20
#: Queries and candidates of one product, and pairs recomputed at once.
ROWS, COLUMNS, PAIR_BYTES = 256, 4096, 64 << 20
#: Products of int8 numbers add up exactly in float32 over so many components.
EXACT = 1024
NO_ID = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not all zero."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")), F.lit(False)),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the k largest inner products of each query.

    * Candidates are all other rows, also those of equal id or equal vector.
      Ties go to the smaller id, a null id last.
    * Vectors that are null, zero, or hold a null or non-finite component take
      no part; vectors of different lengths do not meet.
    * Products too large for a double are infinite, and rank so; one that is no
      number, since its parts are infinite in both directions, counts as the least.
    * A query with fewer candidates has fewer rows, none without any. An empty
      table gives no rows. Other columns are not looked at.
    """
    rows = scratch(
        vectors.where(usable(F.col(vector_col))).select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.size(vector_col).alias("dim"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("query"),
        ),
        "neighbours-rows",
    )
    candidates = _packed(rows, block, "c")
    queries = _packed(rows.where("query"), block, "q")
    # Names of blocks only: one for every thousands of vectors.
    names = lambda df, n: df.groupBy("dim").agg(F.collect_list(n).alias("others"))
    left = candidates.join(names(queries, "q"), "dim").withColumn("q", F.explode("others"))
    right = queries.join(names(candidates, "c"), "dim").withColumn("c", F.explode("others"))
    tiles = left.drop("others", "dim").join(right.drop("others", "dim"), ["c", "q"])
    found = tiles.select(
        "dim_c", "ids_c", "rows_c", "vectors_c", "ids_q", "rows_q", "vectors_q"
    ).mapInArrow(_tile_top(k), "query_id long, query_row long, id long, row long, score double")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(
        "query_id",
        F.col("rank").cast("int").alias("rank"),
        F.nullif(F.col("id"), F.lit(int(NO_ID))).alias(id_col),
        "score",
    )


def _packed(rows: DataFrame, block: int, side: str) -> DataFrame:
    """Blocks ``(name, dim, ids, rows, vectors)`` of the vectors of one length each."""
    n = rows.count()
    dealt = rows.repartition(max(1, -(-n // block)))
    schema = (
        f"{side} long, dim int, dim_{side} int,"
        f" ids_{side} binary, rows_{side} binary, vectors_{side} binary"
    )
    named = dealt.withColumn("part", F.spark_partition_id()).select("id", "row", "dim", "vector", "part")
    return scratch(named.mapInArrow(_packer(block), schema), "neighbours-blocks")


def _packer(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, ...]]] = {}
        made, part = 0, 0

        def pack(dim: int, most: int) -> pa.RecordBatch:
            nonlocal made
            ids, rows, vectors = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            if len(ids) > most:
                waiting[dim] = [(ids[most:], rows[most:], vectors[most:])]
            name = (part << 24) + made
            made += 1
            values = [name, dim, dim, ids[:most].tobytes(), rows[:most].tobytes(), vectors[:most].tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array([v], t) for v, t in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(columns, [str(i) for i in range(6)])

        for batch in batches:
            ids, rows, dims, _, parts = (np.asarray(c) if i != 3 else c for i, c in enumerate(batch.columns))
            part = int(parts[0]) if len(parts) else part
            flat = np.asarray(batch.column(3).flatten())
            ends = np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                vectors = flat[(ends[own] - dim)[:, None] + np.arange(dim)]
                waiting.setdefault(dim, []).append((ids[own], rows[own], vectors))
                most = max(1, min(block, BLOCK_BYTES // (8 * dim)))
                while dim in waiting and sum(len(x[0]) for x in waiting[dim]) >= most:
                    yield pack(dim, most)
        for dim in list(waiting):
            while dim in waiting:
                yield pack(dim, max(1, min(block, BLOCK_BYTES // (8 * dim))))

    return run


class Rounded(NamedTuple):
    """Vectors as whole numbers up to 127 times a scale, and norms for the bound."""

    whole: np.ndarray
    scale: np.ndarray
    norm: np.ndarray
    error: np.ndarray


def rounded(vectors: np.ndarray) -> Rounded:
    with np.errstate(all="ignore"):  # what overflows has no finite bound, see ``bounds``
        scale = np.abs(vectors).max(axis=1) / 127
        whole = np.nan_to_num(np.rint(vectors / scale[:, None])).clip(-127, 127).astype(np.int8)
        error = np.linalg.norm(vectors - whole * scale[:, None], axis=1)
        return Rounded(whole, scale, np.linalg.norm(vectors, axis=1), error)


def bounds(q: Rounded, c: Rounded) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two blocks.

    With q = q' + e and c = c' + f: qc = q'c' + ec + q'f, the last two by the
    norms. A little is added for the rounding of these sums themselves. A pair
    whose bounds are not finite may have any product, so it always survives.
    """
    tile = np.zeros((len(q.whole), len(c.whole)))
    for d in range(0, q.whole.shape[1], EXACT):
        left, right = (x.whole[:, d : d + EXACT].astype(np.float32) for x in (q, c))
        tile += left @ right.T
    with np.errstate(all="ignore"):
        tile *= q.scale[:, None]
        tile *= c.scale
        slack = np.outer(q.error, c.norm) + np.outer(q.norm + q.error, c.error)
        slack += np.outer(q.norm, c.norm) * 1e-12
        low, high = tile - slack, tile + slack
    unknown = ~(np.isfinite(low) & np.isfinite(high))
    low[unknown], high[unknown] = -np.inf, np.inf
    return low, high


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of pairs, added up in the order of components: equal for equal vectors."""
    total = np.zeros(len(q))
    with np.errstate(all="ignore"):
        for d in range(q.shape[1]):
            total += q[:, d] * c[:, d]
    return np.where(np.isnan(total), -np.inf, total)


def _tile_top(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "query_row", "id", "row", "score"]
        for batch in batches:
            for i in range(batch.num_rows):
                dim, *blobs = (c[i].as_py() for c in batch.columns)
                c_ids, c_rows, q_ids, q_rows = (
                    np.frombuffer(blobs[j], dtype=np.int64) for j in (0, 1, 3, 4)
                )
                c, q = (np.frombuffer(blobs[j]).reshape(-1, dim) for j in (2, 5))
                for lo in range(0, len(q), ROWS):
                    part = slice(lo, lo + ROWS)
                    hits = _top(q[part], q_rows[part], c, c_ids, c_rows, k)
                    which = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
                    best = [x for h in hits for x in sorted(h, reverse=True)]
                    score = np.array([x[0] for x in best])
                    own = [np.array([-x[j] for x in best], dtype=np.int64) for j in (1, 2)]
                    columns = [q_ids[part][which], q_rows[part][which], *own, score]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    return run


def _top(q, q_rows, c, c_ids, c_rows, k) -> list[list[tuple[float, int, int]]]:
    """Of each query a heap of its best ``(score, -id, -row)`` in the block."""
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(len(q))]
    small_q = rounded(q)
    for lo in range(0, len(c), COLUMNS):
        part = slice(lo, lo + COLUMNS)
        low, high = bounds(small_q, rounded(c[part]))
        # Its own row takes no part, so one more is needed to be sure of k others.
        floor = np.full(len(q), -np.inf)
        if low.shape[1] > k:
            floor = np.partition(low, low.shape[1] - k - 1, axis=1)[:, low.shape[1] - k - 1]
        known = [h[0][0] if len(h) == k else -np.inf for h in heaps]
        rows, columns = np.nonzero(high >= np.maximum(floor, known)[:, None])
        other = c_rows[part][columns] != q_rows[rows]
        rows, columns = rows[other], columns[other] + lo
        score = np.empty(len(rows))
        some = max(1, PAIR_BYTES // (16 * max(1, q.shape[1])))
        for at in range(0, len(rows), some):
            pairs = slice(at, at + some)
            score[pairs] = products(q[rows[pairs]], c[columns[pairs]])
        order = np.lexsort((c_rows[columns], c_ids[columns], -score, rows))
        rows, columns, score = rows[order], columns[order], score[order]
        first = np.searchsorted(rows, rows, side="left")
        inside = np.arange(len(rows)) - first < k
        for r, s, a, b in zip(
            rows[inside].tolist(),
            score[inside].tolist(),
            c_ids[columns[inside]].tolist(),
            c_rows[columns[inside]].tolist(),
        ):
            heap, item = heaps[r], (s, -a, -b)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
    return heaps
