"""Removal of repeated passages by a sorted array of sampled suffixes.

Every byte goes that is covered by a window of 200 bytes which also starts
anywhere else. ``repeats`` gives the suffixes to look at: those at anchors whose
gram stands elsewhere too. If all places of a gram have one context, its windows
all repeat, with nothing to sort. The other contexts are distinct ones, counted;
sampled splitters range-partition them by their leading bytes, and every bucket
is sorted by multikey quicksort, once by what follows the anchor and once by
what precedes it. Common prefixes of neighbours in both orders tell for every
window whether another context holds it. Splitters are whole grams, so contexts
on the two sides of a boundary share less than a gram, and no window straddles
it; a gram of so many contexts that it would fill a bucket alone is parted first,
by hashes of longer stretches that ranges of its windows hold in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.llm.common import free_name, partitions, release, scratch, whole_text
from bronzeflow.llm.repeats import (
    Windows,
    anchors,
    bodies,
    contexts_of,
    keyed,
    with_texts,
)

WINDOW, GRAM = 200, 40
#: Contexts that a gram may have at least before it is parted.
CROWDED = 2000
#: Parts that a range of distances is cut into while too many contexts share a stretch.
SPLIT = 3
#: Contexts that a bucket takes on average at most; there are more buckets for more.
BUCKET = 50_000
WORD = 8


def repeated_spans(
    docs: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    crowded: int | None = None,
) -> DataFrame:
    """``(key, pos, low, high)``: windows that repeat, by text and anchor.

    For an anchor at ``pos`` of the texts with hash ``key`` windows repeat from
    ``high`` to ``low`` bytes before it, so ``[pos - high, pos - low + window)``
    is covered, cut to the text. A gram of ``crowded`` contexts is parted; by
    default, one of as many as a bucket takes on average, and ``CROWDED`` at least.
    """
    spark = docs.sparkSession
    spec = Windows(window, gram, words=False)
    texts = keyed(docs, text_col, F.lit(0).cast("long"))
    grams = (
        anchors(texts, spec)
        .groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.min("context") < F.max("context")).alias("mixed"),
        )
        .where("n > 1")
        .drop("n")
    )
    grams = scratch(grams, "suffixes-grams")
    release(spark)
    shared = anchors(texts, spec).select("gram", "key", "pos", "context").join(grams, "gram")
    # Copies of a text have the same places.
    shared = shared.groupBy("gram", "key", "pos", "context", "mixed").agg(
        F.count(F.lit(1)).alias("copies")
    )
    shared = scratch(shared, "suffixes-places")
    release(spark)
    same = shared.where("NOT mixed").select(
        "key", "pos", F.lit(0).alias("low"), F.lit(spec.before).alias("high")
    )
    differing = shared.where("mixed").select(
        "gram", "key", "pos", "context", "copies",
        F.lit(False).alias("crowded"), F.lit(0).cast("long").alias("doc"),
    )
    chosen = scratch(contexts_of(differing), "suffixes-contexts")
    contexts = chosen.count()
    ranges = _ranges(spark, contexts)
    if crowded is None:
        # In proportion to the buckets, so that no more of a larger table is parted.
        crowded = max(CROWDED, -(-contexts // ranges))
    placed = with_texts(texts, _crowded(chosen, crowded))
    sorted_ = _by_sorting(placed, spec, ranges)
    found = scratch(sorted_.unionByName(_by_parts(placed, spec, crowded)), "suffixes-found")
    release(spark)
    by_context = differing.join(found, "context").select("key", "pos", "low", "high")
    return same.unionByName(by_context)


def _ranges(spark: SparkSession, contexts: int) -> int:
    """Buckets for so many contexts: what one task holds does not grow with the corpus."""
    return max(partitions(spark), -(-contexts // BUCKET))


def _by_sorting(placed: DataFrame, spec: Windows, ranges: int) -> DataFrame:
    """``(context, low, high)`` from sorted buckets."""
    lead = F.expr(f"substring(body, left + 1, {spec.gram})")
    every = {"low": F.lit(0), "high": F.lit(spec.before)}
    dealt = bodies(placed, spec).select("context", "left", "body", "count", lead.alias("lead"))
    return _sorted(dealt.withColumns(every), spec, ranges)


def _sorted(rows: DataFrame, spec: Windows, ranges: int) -> DataFrame:
    """``(context, low, high)`` of the windows of each row that lie in its own range and that
    another row of the same ``lead`` holds."""
    dealt = rows.repartitionByRange(ranges, "lead")
    schema = "context long, low int, high int"
    names = ("context", "left", "body", "count", "low", "high")
    return dealt.select(*names).mapInArrow(_bucket(spec), schema)


def _by_parts(placed: DataFrame, spec: Windows, crowded: int) -> DataFrame:
    """``(context, low, high)`` of the contexts of crowded grams.

    Their windows are judged by ranges of the distance to the anchor. None of a range
    repeats if what all of them hold stands nowhere else, and all do if the stretch
    that they cover together stands elsewhere. Contexts that share the covered stretch
    are alike for all others too, so one of them goes on, to be compared with. What is
    left is sorted, once less than ``crowded`` contexts share what the range holds in
    common; the other ranges are cut into parts, down to single windows.
    """
    spark = placed.sparkSession
    around = bodies(placed, spec, crowded=True).select("context", "count", "left", "body")
    around = scratch(around, "suffixes-crowded")
    every = {"low": F.lit(0), "high": F.lit(spec.before)}
    # A context of several places repeats as a whole.
    found = around.where("count > 1").select("context").withColumns(every)
    if around.isEmpty():
        return found
    rows = around.withColumns({"open": F.col("count") == 1, **every})
    step, few = spec.before + 1, []
    while step > 1:
        step = -(-step // SPLIT)
        ranges = scratch(_ranges_of(rows, spec, step), "suffixes-ranges")
        met = ranges.groupBy("shared").agg(
            F.sum("count").alias("n"), F.bool_or("open").alias("asked")
        )
        # Written, so that the join is one of plain shuffles, which may be split.
        met = scratch(met.where("n > 1 AND asked").select("shared"), "suffixes-met")
        live = scratch(ranges.join(met, "shared", "left_semi"), "suffixes-live")
        alike = live.groupBy("covered", "low", "high").agg(
            F.min("context").alias("context"),
            F.sum("count").alias("count"),
            F.bool_or("open").alias("open"),
            F.first("shared").alias("shared"),
        )
        alike = scratch(alike, "suffixes-alike")
        again = alike.where("count > 1").select("covered")
        whole = live.where("open").join(again, "covered", "left_semi")
        found = found.unionByName(whole.select("context", "low", "high"))
        held = alike.groupBy("shared").agg(
            F.count(F.lit(1)).alias("contexts"), F.bool_or(F.expr("open AND count = 1")).alias("asked")
        )
        held = held.where("contexts > 1 AND asked").select(
            "shared", (F.col("contexts") >= crowded).alias("crowded")
        )
        held = scratch(held, "suffixes-held")
        left = alike.withColumn("open", F.expr("open AND count = 1")).drop("covered")
        left = scratch(left.join(held, "shared"), "suffixes-left")
        few.append(left.where("NOT crowded").drop("open", "crowded"))
        more = left.where("crowded").drop("shared", "crowded")
        if more.isEmpty():
            break
        rows = around.drop("count").join(more, "context")
    parts = reduce(DataFrame.unionByName, few).withColumnRenamed("shared", "lead")
    buckets = _ranges(spark, parts.count())
    found = found.unionByName(_sorted(around.drop("count").join(parts, "context"), spec, buckets))
    return found.groupBy("context").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _ranges_of(rows: DataFrame, spec: Windows, step: int) -> DataFrame:
    """Ranges cut into parts of ``step`` distances: ``shared`` is a hash of what the windows
    of a part hold in common, ``covered`` one of all that they cover."""

    def stretch(before: str, after: str) -> str:
        size = f"{before} + {spec.length} - {after}"
        return f"xxhash64({spec.seed}L, low, high, substring(body, left - {before} + 1, {size}))"

    def holds(before: str, after: str) -> str:
        return f"left >= {before} AND octet_length(body) - left >= {spec.length} - {after}"

    # At the ends of a text there is no such stretch, and nothing is like it.
    covered = f"IF({holds('high', 'low')}, {stretch('high', 'low')}, xxhash64(context, low, high))"
    cut = rows.withColumn("start", F.explode(F.sequence("low", "high", F.lit(step))))
    cut = cut.withColumn("high", F.least(F.col("start") + step - 1, "high"))
    cut = cut.withColumn("low", F.col("start")).where(holds("low", "high"))
    return cut.selectExpr(
        "context", "count", "open", "low", "high",
        f"{stretch('low', 'high')} AS shared", f"{covered} AS covered",
    )


def _crowded(chosen: DataFrame, crowded: int) -> DataFrame:
    """``chosen`` with ``crowded``: whether the gram has so many different contexts.

    Copies of a text have the same contexts, so they crowd nothing.
    """
    held = chosen.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"))
    held = held.where(F.col("contexts") >= crowded).select("gram", F.lit(True).alias("crowded"))
    return chosen.drop("crowded").join(held, "gram", "left").fillna(False, ["crowded"])


def _bucket(spec: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        names = ("context", "left", "count", "low", "high")
        context, left, count, low, high = (table.column(c).to_numpy() for c in names)
        bodies = table.column("body").to_pylist()
        found = repeated_windows(bodies, left.astype(np.int64), count, spec, low, high)
        hit = found[:, 1] >= 0
        columns = [context[hit], found[hit, 0].astype(np.int32), found[hit, 1].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["context", "low", "high"])

    return run


def repeated_windows(
    bodies: list[bytes],
    left: np.ndarray,
    count: np.ndarray,
    spec: Windows,
    low: np.ndarray,
    high: np.ndarray,
) -> np.ndarray:
    """``(low, high)`` of each context: fewest and most bytes that a repeated window starts
    before the anchor, of those from ``low`` to ``high``; -1 if there is none.

    A window ``back`` bytes before the anchor is known by its class in the order
    of what follows, at depth ``length - back``, and in that of what precedes,
    at depth ``back``.
    """
    n = len(bodies)
    right = np.array([len(b) for b in bodies], dtype=np.int64) - left
    after = padded([b[a:] for b, a in zip(bodies, left.tolist())], spec.length)
    before = padded([b[:a][::-1] for b, a in zip(bodies, left.tolist())], spec.before)
    order_a, order_b = (multikey_quicksort(words_of(x)) for x in (after, before))
    lcp_a = common_prefixes(after[order_a], right[order_a])
    lcp_b = common_prefixes(before[order_b], left[order_b])
    found = np.full((n, 2), -1, dtype=np.int64)
    for back in range(spec.before + 1):
        valid = (left >= back) & (right >= spec.length - back) & (low <= back) & (back <= high)
        if not valid.any():
            continue
        class_a, class_b = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        class_a[order_a] = np.cumsum(lcp_a < spec.length - back)
        class_b[order_b] = np.cumsum(lcp_b < back)
        own = np.flatnonzero(valid)
        _, which = np.unique(class_a[own] * (n + 1) + class_b[own], return_inverse=True)
        total = np.bincount(which, weights=count[own])
        hit = own[total[which] > 1]
        found[hit, 1] = back
        fresh = hit[found[hit, 0] < 0]
        found[fresh, 0] = back
    return found


def padded(rows: list[bytes], width: int) -> np.ndarray:
    """Rows of bytes, filled with zeros to a multiple of eight."""
    width = -(-max(width, 1) // WORD) * WORD
    joined = b"".join(r[:width].ljust(width, b"\0") for r in rows)
    return np.frombuffer(joined, dtype=np.uint8).reshape(len(rows), width)


def words_of(rows: np.ndarray) -> np.ndarray:
    """Eight bytes at a time as numbers in the order of the bytes."""
    return np.ascontiguousarray(rows).view(">u8").astype(np.uint64)


def multikey_quicksort(words: np.ndarray, small: int = 64) -> np.ndarray:
    """Order of rows: three-way partitions, an equal part going on with the next word."""
    order = np.arange(len(words))
    stack = [(0, len(words), 0)]
    while stack:
        lo, hi, depth = stack.pop()
        if hi - lo < 2 or depth == words.shape[1]:
            continue
        own = order[lo:hi]
        if hi - lo <= small:
            rest = words[own, depth:]
            order[lo:hi] = own[np.lexsort(rest.T[::-1])]
            continue
        key = words[own, depth]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[4 if len(key) >= 9 else 0]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        order[lo:hi] = np.concatenate([own[less], own[same], own[more]])
        a = lo + int(less.sum())
        b = a + int(same.sum())
        stack += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def common_prefixes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes that each sorted row shares with the one before it; -1 for the first."""
    if not len(rows):
        return np.zeros(0, dtype=np.int64)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    first = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    return np.concatenate([[-1], first])


def without_repeats(
    docs: DataFrame,
    text_col: str = "text",
    kept_col: str = "kept_text",
    window: int = WINDOW,
    gram: int = GRAM,
    crowded: int | None = None,
    as_text: bool = False,
) -> DataFrame:
    """``docs`` with the bytes that remain, and the removed runs as ``<kept_col>_spans``.

    * The bytes that remain are binary: a removed run may start or end inside a
      character. ``as_text`` gives a string, without what is left of such a
      character. Spans are an array of ``(start, end)``, null if there are none.
    * Null text: empty. Texts shorter than the window stay whole, as do windows
      that cross from one document to another. Repeated rows are documents of
      their own, so texts of the window's size or more that repeat are emptied.
    * Names that are taken get underscores in front. An empty table gives no rows.
    """
    kept, spans = free_name(docs, kept_col), free_name(docs, f"{kept_col}_spans")
    key, places = free_name(docs, "text_key"), free_name(docs, "text_places")
    found = repeated_spans(docs, text_col, window, gram, crowded)
    per_text = scratch(
        found.groupBy(F.col("key").alias(f"_{key}")).agg(
            F.collect_list(F.struct("pos", "low", "high")).alias(places)
        ),
        "suffixes-spans",
    )
    release(docs.sparkSession)
    keyed_docs = docs.withColumn(key, F.xxhash64(whole_text(text_col)))
    joined = keyed_docs.join(per_text, F.col(key) == F.col(f"_{key}"), "left").drop(key, f"_{key}")
    span = T.ArrayType(T.StructType([T.StructField(x, T.IntegerType()) for x in ("start", "end")]))
    kept_type = T.StringType() if as_text else T.BinaryType()
    fields = [*docs.schema.fields, T.StructField(kept, kept_type), T.StructField(spans, span)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        own_type = pa.string() if as_text else pa.binary()
        for batch in batches:
            names = batch.schema.names
            bodies = batch.column(names.index(text_col)).cast(pa.binary())
            lists = batch.column(names.index(places))
            texts, removed = [], []
            for body, own in zip(bodies, lists):
                text, runs = body.as_py() or b"", []
                if own.is_valid:
                    runs = covered(own.values, len(text), window)
                at, parts = 0, []
                for start, end in runs:
                    parts.append(text[at:start])
                    at = end
                left = b"".join([*parts, text[at:]])
                texts.append(left.decode("utf-8", "ignore") if as_text else left)
                removed.append([{"start": a, "end": b} for a, b in runs] or None)
            keep = [c for i, c in enumerate(batch.columns) if names[i] != places]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(texts, own_type), pa.array(removed, kind)],
                [*[x for x in names if x != places], kept, spans],
            )

    return joined.mapInArrow(run, T.StructType(fields))


def covered(places: pa.StructArray, size: int, window: int) -> list[tuple[int, int]]:
    """Maximal runs that the repeated windows of the anchors of a text cover."""
    pos, low, high = (np.asarray(places.field(x)).astype(np.int64) for x in ("pos", "low", "high"))
    start = pos - np.minimum(high, pos)
    end = np.minimum(pos - low + window, size)
    own = end - start >= window
    start, end = start[own], end[own]
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(order) else end
    if not len(start):
        return []
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([new[1:], [True]])
    return list(zip(start[new].tolist(), end[last].tolist()))
