"""Mixing sources to target weights by balanced (cube method) sampling.

Every source has a target number of words. What the target exceeds whole copies
of the source by becomes an inclusion probability, equal within the source, and
the cube method draws the sample: vectors of probabilities move through the null
space of the balancing constraints (document count and word count), which keeps
both totals exactly, until a unit reaches 0 or 1 and is decided. A block of units
ends with at most two of them undecided; these meet those of other blocks in the
next round, until each source has one block left. Only its last two units land
by a draw, so a source misses its target by less than two documents' words.

Rows of equal id, source and text are one unit: of m such rows the whole part of m
times the probability is given out by arithmetic, to as many of them, and only the
remaining fraction, less than one row, is a unit of the flight.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.llm.common import count_words, scratch, whole_text

#: Weights of the sources in code point order (null last), repeating.
CYCLE = (1, 2, 3)
#: A document is taken this often at most, and a target stops at this many times its source.
MOST_COPIES = 3
#: Units that one block of the flight phase takes.
BLOCK = 4000


def source_targets(sized: DataFrame, share: float = 1.0) -> DataFrame:
    """``(source, source_size, units, target)`` of ``(source, words, rows)``.

    Targets share ``share`` of all words by weight. One that would exceed
    ``MOST_COPIES`` times its source stops there, and what is above is shared by
    weight among the others. With sources in the order of size over weight those
    that stop come first, so one pass of running totals finds the level.
    """
    per_source = sized.groupBy("source").agg(F.sum("words").alias("source_size"))
    # One row per source: the only ordering that goes over all of them.
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(w) for w in CYCLE])
    weighed = per_source.withColumn(
        "weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(CYCLE) + 1)
    )
    cap = F.col("source_size") * MOST_COPIES
    everything = Window.partitionBy()
    by_level = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * share).alias("total"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("capped_before"),
        F.sum("weight").over(from_here).alias("weight_left"),
    ).withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    # The first source that does not stop fixes the level for all that follow.
    fits = F.col("level") * F.col("weight") <= cap
    level = F.min(F.when(fits, F.struct(cap / F.col("weight"), F.col("level"))))
    return levels.withColumn("free", level.over(everything)["level"]).select(
        "source",
        "source_size",
        F.least(
            cap.cast("double"),
            F.coalesce(F.col("free") * F.col("weight"), cap.cast("double")),
        ).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 23,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, size, source_size, target, copies)``: how often the mix takes each row.

    * Of rows of equal id, source and text some may be taken once more than others.
    * Null text: no words. Null id and null source: values like any other, the
      null source last. A source without words has target 0 and is not taken.
    * Reruns agree: all draws are hashes of id, source, size, text and seed. Which of
      equal rows is taken once more is not told, since they are equal.
    * An empty table gives no rows. No other columns are looked at.
    """
    rows = _numbered_rows(docs, id_col, text_col, source_col)
    decided, targets = _decided(rows, seed, block)
    named = targets.withColumnRenamed("source", "_source")
    return (
        _given_out(rows, decided)
        .join(named, F.col("source").eqNullSafe(F.col("_source")))
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies")
    )


UNIT = ("id", "source", "size", "kind")


def _numbered_rows(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: bool = False
) -> DataFrame:
    """``(id, source, size, kind, part, place)``, and the whole row as ``doc`` if asked for.

    ``kind`` is a hash of the text, ``part`` and ``place`` tell equal rows apart.
    """
    text = whole_text(text_col)
    columns = [
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        count_words(text).alias("size"),
        F.xxhash64(text).alias("kind"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    ]
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []
    return scratch(docs.select(*columns, *whole), "mixing-rows")


def _decided(rows: DataFrame, seed: int, block: int) -> tuple[DataFrame, DataFrame]:
    """``(id, source, size, kind, rows, whole, extra)`` of each unit; and the targets.

    Every row is taken ``whole`` times, and ``extra`` of them once more.
    """
    units = rows.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("rows"))
    units = scratch(units.withColumn("words", F.col("size") * F.col("rows")), "mixing-units")
    targets = scratch(source_targets(units), "mixing-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # One row per source on the right; the planner broadcasts it only if it is small.
    named = targets.withColumnRenamed("source", "_source")
    part = (ratio - F.floor(ratio)) * F.col("rows")
    planned = units.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
        *UNIT,
        "rows",
        F.lit(1.0).alias("n"),
        F.col("size").cast("double").alias("w"),
        F.floor(ratio).cast("int").alias("whole"),
        F.floor(part).cast("long").alias("sure"),
        (part - F.floor(part)).alias("p"),
        F.xxhash64(*UNIT, F.lit(seed)).alias("draw"),
    )
    return _cube(planned, block), targets


def _given_out(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """``rows`` with ``copies``: equal rows in order of part and place, the first ones once more.

    Rows are numbered within their part, and parts by the counts of those before
    them, so equal rows are never brought together in one task.
    """
    own = decided.withColumnsRenamed({c: f"_{c}" for c in UNIT})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in UNIT]
    joined = rows.join(own, same).drop(*[f"_{c}" for c in UNIT])
    alone = joined.where("rows = 1").withColumn("copies", F.col("whole") + F.col("extra").cast("int"))
    many = joined.where("rows > 1")
    # A row for each part that has rows of the unit.
    counts = many.groupBy(*UNIT, "part").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy(*UNIT).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0)))
    counts = counts.withColumnsRenamed({c: f"_{c}" for c in (*UNIT, "part")}).drop("here")
    within = Window.partitionBy(*UNIT, "part").orderBy("place")
    numbered = many.withColumn("number", F.row_number().over(within)).join(
        counts, [*same, F.col("part") == F.col("_part")]
    )
    more = (F.col("before") + F.col("number") <= F.col("extra")).cast("int")
    columns = [*rows.columns, "copies"]
    return alone.select(*columns).unionByName(
        numbered.withColumn("copies", F.col("whole") + more).select(*columns)
    )


def mixed_documents(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 23,
    block: int = BLOCK,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    rows = _numbered_rows(docs, id_col, text_col, source_col, carry=True)
    slim = rows.drop("doc")
    decided, _ = _decided(slim, seed, block)
    copies = _given_out(slim, decided).where("copies > 0").select("place", "copies")
    # Documents move once at most, when it is known how often each place is taken: written,
    # the copies have a known size, and few are broadcast.
    copies = scratch(copies, "mixing-copies")
    taken = rows.select("place", "doc").join(copies, "place")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def _cube(planned: DataFrame, block: int) -> DataFrame:
    """``(id, source, size, kind, rows, whole, extra)`` of every unit."""
    state = planned.select("*", F.lit(-1).alias("taken"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema.fields])
    done, rounds = [], 0
    while True:
        counts = state.groupBy("source").agg(F.count(F.lit(1)).alias("units"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("units") / block)).cast("long")
        dealt = state.join(
            counts.select(F.col("source").alias("_source"), blocks.alias("blocks")),
            F.col("source").eqNullSafe(F.col("_source")),
        ).drop("_source")
        dealt = dealt.withColumn(
            "block", F.pmod(F.xxhash64("draw", F.lit(rounds)), F.col("blocks"))
        )
        flown = scratch(
            dealt.groupBy("source", "block").applyInPandas(_fly, schema), "mixing-flight"
        )
        done.append(flown.where("taken >= 0"))
        state = flown.where("taken < 0")
        if state.isEmpty():
            break
        rounds += 1
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    extra = (F.col("sure") + F.col("taken")).alias("extra")
    return result.select(*UNIT, "rows", "whole", extra)


def _fly(units: pd.DataFrame) -> pd.DataFrame:
    """Flight phase over one block; it lands if it is the only block of its source."""
    only = bool((units["blocks"] == 1).all())
    # Large units first: those left to the landing are then small.
    units = units.sort_values(["w", "draw"], ascending=[False, True], kind="stable")
    p, n, w = (units[c].to_numpy(dtype=float).copy() for c in ("p", "n", "w"))
    draws = _uniform(units["draw"].to_numpy(dtype=np.int64))
    open_units = _flight(p, n, w, draws)
    taken = np.where(p >= 0.5, 1, 0)
    taken[open_units] = -1
    if only:
        for k in open_units:
            taken[k] = int(draws[k] < p[k])
    decided = units.assign(p=p, taken=taken.astype("int32"))
    return decided.drop(columns=["blocks", "block"])


def _uniform(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def _flight(p: np.ndarray, n: np.ndarray, w: np.ndarray, draws: np.ndarray) -> list[int]:
    """Decide units in place; the indices left open, two at most.

    Three units always have a direction that keeps both totals: the cross
    product of the rows (n) and (w). A step along it, up or down with the odds
    that keep every probability's expectation, decides at least one of them.
    """
    near = 1e-9
    waiting = iter(np.flatnonzero((p > near) & (p < 1 - near)).tolist())
    p[p <= near], p[p >= 1 - near] = 0.0, 1.0
    held: list[int] = []
    while True:
        while len(held) < 3:
            k = next(waiting, None)
            if k is None:
                return held
            held.append(k)
        a, b, c = held
        u = (
            n[b] * w[c] - n[c] * w[b],
            n[c] * w[a] - n[a] * w[c],
            n[a] * w[b] - n[b] * w[a],
        )
        if max(map(abs, u)) < 1e-12:  # all of one shape: any exchange will do
            u = (n[b], -n[a], 0.0)
        up = down = float("inf")
        for k, x in zip(held, u):
            if x > 0:
                up, down = min(up, (1 - p[k]) / x), min(down, p[k] / x)
            elif x < 0:
                up, down = min(up, p[k] / -x), min(down, (1 - p[k]) / -x)
        step = up if draws[a] * (up + down) < down else -down
        draws[a] = (draws[a] * 7919.0 + 0.31830988618) % 1.0
        for k, x in zip(held, u):
            p[k] += step * x
        held = _still_open(p, held, near)


def _still_open(p: np.ndarray, held: list[int], near: float) -> list[int]:
    left = []
    for k in held:
        if p[k] <= near:
            p[k] = 0.0
        elif p[k] >= 1 - near:
            p[k] = 1.0
        else:
            left.append(k)
    return left
