"""Sharding by sampled splitters: shards of near equal bytes.

Records are ordered by a key whose upper half hashes the text and whose lower
half hashes the id, so equal texts stand side by side and still have different
keys. A size-weighted sample of keys gives quantile boundaries, records go to
the ranges between them, and a range that turns out overfull is divided again by
splitters sampled inside it. Ranges are small enough to be ranked one per task;
their exact totals, added up, give every record its place in the global order of
bytes and with it a shard and a slot.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeflow.llm.common import scratch, whole_text

#: Bytes that a record takes in a shard besides its text.
OVERHEAD = 16


def assign_shards(
    docs: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    ranges_per_shard: int = 4,
    samples_per_range: int = 16,
    overfull: float = 2.0,
    small: int = 1000,
    seed: int = 17,
) -> DataFrame:
    """``(id, size, text_crc32, shard, slot, *carry)``, one row for every input row.

    * Shards differ from the mean by less than one record. Slots of a shard run
      from 0 without gaps, in key order.
    * Null text: size 16, crc of the empty text. Null id: a value like any other.
    * Repeated rows are separate records; a group of equal texts, or of wholly
      equal rows, spreads over ranges and shards once it is larger than one.
    * Splitters decide who ranks a record, never its place: a range over
      ``overfull`` times the mean, unless of ``small`` rows, is divided again.
    * An empty table gives no rows; empty shards are allowed. Columns other than
      ``carry`` are not looked at, whatever their names.
    """
    text = whole_text(text_col)
    sized = scratch(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("crc"),
            _key(text, F.col(id_col)).alias("key"),
            F.struct(*[F.col(c) for c in carry], F.lit(0).alias("_")).alias("carried"),
        ),
        "sharding-sizes",
    )
    wanted = n_shards * ranges_per_shard
    splitters = _quantiles(_sample(sized, wanted * samples_per_range, seed), wanted)
    while True:
        ranged = sized.withColumn("range", _range_of(splitters))
        totals = {r["range"]: (r["bytes"], r["rows"]) for r in _totals(ranged).collect()}
        whole = sum(b for b, _ in totals.values())
        limit = overfull * whole / wanted
        full = {
            r: int(np.ceil(b * wanted / whole))
            for r, (b, n) in totals.items()
            if b > limit and n > small
        }
        inside = _samples(ranged, full, samples_per_range, seed)
        finer = set(splitters)
        for r, parts in full.items():
            finer |= set(_quantiles(inside.get(r, []), parts))
        if len(finer) == len(splitters):
            break  # even, or ranges of one key only
        splitters = sorted(finer)

    n = len(splitters) + 1
    bytes_before = [0, *accumulate(totals.get(r, (0, 0))[0] for r in range(n))]
    rows_before = [0, *accumulate(totals.get(r, (0, 0))[1] for r in range(n))]
    order = Window.partitionBy("range").orderBy("key", "id", "crc", "size")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("size").over(running) + _at(bytes_before, "range")
    middle = end.cast("double") - F.col("size") / 2
    ranked = scratch(
        ranged.withColumn("rank", F.row_number().over(order) - 1 + _at(rows_before, "range"))
        .withColumn(
            "shard",
            F.least(F.floor(middle * n_shards / max(whole, 1)), F.lit(n_shards - 1)).cast("int"),
        )
        .drop("range", "key"),
        "sharding-ranks",
    )
    # One row per shard, so its size is bounded by the number of shards.
    starts = ranked.groupBy("shard").agg(F.min("rank").alias("start"))
    return ranked.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("rank") - F.col("start")).cast("long").alias("slot"),
        *[F.col("carried")[c].alias(c) for c in carry],
    )


def _key(text: Column, record: Column) -> Column:
    """High half: the text. Low half: the id, then a salt for wholly equal rows."""
    low = F.shiftleft(F.xxhash64(record).bitwiseAND(F.lit(0xFFFFFF)), 8)
    salt = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFF))
    return F.shiftleft(F.xxhash64(text), 32).bitwiseOR(low.bitwiseOR(salt))


def _sample(df: DataFrame, size: int, seed: int) -> list[int]:
    """Keys drawn with weights in proportion to size: the smallest of exponential clocks.

    At most ``size`` keys reach the driver.
    """
    rows = df.select("key", _clock(seed).alias("clock")).orderBy("clock", "key").limit(size).collect()
    return sorted(r["key"] for r in rows)


def _samples(
    ranged: DataFrame, full: dict[int, int], per_part: int, seed: int
) -> dict[int, list[int]]:
    """Size-weighted keys of every overfull range, ``per_part`` for each part it needs.

    Parts of all ranges add up to a small multiple of the ranges wanted.
    """
    if not full:
        return {}
    quota = F.create_map(*[F.lit(x) for r, n in full.items() for x in (r, n * per_part)])
    best = Window.partitionBy("range").orderBy("clock", "key")
    rows = (
        ranged.where(F.col("range").isin(list(full)))
        .select("range", "key", _clock(seed + 1).alias("clock"))
        .withColumn("nth", F.row_number().over(best))
        .where(F.col("nth") <= max(full.values()) * per_part)
        .where(F.col("nth") <= quota[F.col("range")])
        .collect()
    )
    found: dict[int, list[int]] = {}
    for row in rows:
        found.setdefault(row["range"], []).append(row["key"])
    return {r: sorted(keys) for r, keys in found.items()}


def _clock(seed: int) -> Column:
    """Exponential clock of a record with its size as rate."""
    uniform = (F.xxhash64("key", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) + 1) / float(1 << 52)
    return -F.log(uniform) / F.col("size")


def _quantiles(keys: list[int], parts: int) -> list[int]:
    """Boundaries of ``parts`` equal parts; a range starts at its boundary."""
    if not keys:
        return []
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)})


def _range_of(splitters: list[int]) -> Column:
    edges = np.array(splitters, dtype=np.int64)

    @F.pandas_udf("int")
    def locate(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, key.to_numpy(), side="right").astype("int32"))

    return locate("key")


def _totals(ranged: DataFrame) -> DataFrame:
    return ranged.groupBy("range").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def _at(values: list[int], index: str) -> Column:
    return F.element_at(F.array([F.lit(int(v)).cast("long") for v in values]), F.col(index) + 1)
