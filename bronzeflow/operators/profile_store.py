"""Profile of a growing table, from a stored state of each of its partitions.

A documented feature of which only single instances are given, so the general
semantics are our own.

A state holds counts, least and largest values, means with sums of squared
deviations, and a sketch of the distinct values: all of these merge. So a new
profile reads the partitions whose files changed, and the states of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.config import Target
from bronzeflow.operators.incremental import PARTITIONS_PER_PASS, any_of, renamed_keys, same_key
from bronzeflow.operators.quality import unpivot_row
from bronzeflow.operators.sinks import write_bronze
from bronzeflow.specs import TableSpec

#: Sketches of 2^12 registers: distinct counts have a standard error of 1.6 percent.
SKETCH_BITS = 12
STAMP = "files_stamp"
PROFILE_SCHEMA = (
    "column string, rows long, nulls long, distinct long, min string, max string,"
    " mean double, stddev double"
)


def profile_spec(spec: TableSpec) -> TableSpec:
    return replace(
        spec, name=f"{spec.name}__profile", primary_key=(), partition_by=(), foreign_keys=()
    )


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def sketched(column: str, kind: T.DataType) -> Column:
    """The column as a type that sketches take."""
    direct = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)
    return F.col(column) if isinstance(kind, direct) else F.col(column).cast("string")


def states(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per value of ``by`` with the mergeable state of every column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    measures = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(columns):
        measures += [
            F.count(c).alias(f"set_{i}"),
            F.hll_sketch_agg(sketched(c, kinds[c]), SKETCH_BITS).alias(f"sketch_{i}"),
            F.min(c).alias(f"min_{i}"),
            F.max(c).alias(f"max_{i}"),
        ]
        if is_number(kinds[c]):
            number = F.col(c).cast("double")
            measures += [
                F.avg(number).alias(f"mean_{i}"),
                (F.var_pop(number) * F.count(c)).alias(f"squares_{i}"),
            ]
    return df.groupBy(*by).agg(*measures)


def merged(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, rows, nulls, distinct, min, max, mean, stddev)`` of all states together.

    Squared deviations from the means of the states are carried over to the mean
    of all, which is known first; so large values do not cancel.
    """
    numbers = [i for i in range(len(columns)) if f"mean_{i}" in stored.columns]
    weighted = [
        F.try_divide(F.sum(F.col(f"mean_{i}") * F.col(f"set_{i}")), F.sum(f"set_{i}")).alias(f"mean_{i}")
        for i in numbers
    ]
    means = stored.agg(F.count(F.lit(1)), *weighted).first()
    measures = [F.coalesce(F.sum("total"), F.lit(0)).alias("total")]
    for i in range(len(columns)):
        measures += [
            F.coalesce(F.sum(f"set_{i}"), F.lit(0)).alias(f"set_{i}"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{i}")), F.lit(0)).alias(
                f"distinct_{i}"
            ),
            F.min(f"min_{i}").cast("string").alias(f"min_{i}"),
            F.max(f"max_{i}").cast("string").alias(f"max_{i}"),
        ]
        if i in numbers:
            off = F.col(f"mean_{i}") - F.lit(means[f"mean_{i}"])
            measures.append(
                F.sum(F.col(f"squares_{i}") + F.col(f"set_{i}") * off * off).alias(f"squares_{i}")
            )
    rows = []
    for i, c in enumerate(columns):
        unknown = F.lit(None).cast("double")
        spread = F.sqrt(F.try_divide(F.col(f"squares_{i}"), F.nullif(F.col(f"set_{i}") - 1, F.lit(0))))
        rows.append(
            {
                "column": F.lit(c),
                "rows": F.col("total"),
                "nulls": F.col("total") - F.col(f"set_{i}"),
                "distinct": F.col(f"distinct_{i}"),
                "min": F.col(f"min_{i}"),
                "max": F.col(f"max_{i}"),
                "mean": F.round(F.lit(means[f"mean_{i}"]).cast("double"), 4) if i in numbers else unknown,
                "stddev": F.round(spread, 4) if i in numbers else unknown,
            }
        )
    return unpivot_row(stored.agg(*measures), rows)


def stamps(table: DataFrame, parts: Sequence[str]) -> DataFrame:
    """What the files of each partition are, without reading a column of them."""
    files = table.groupBy(
        *parts, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("time"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(*parts).agg(F.bit_xor(F.xxhash64("path", "size", "time", "n")).alias(STAMP))


def refresh_profile(
    spark: SparkSession, target: Target, spec: TableSpec, columns: Sequence[str] | None = None
) -> int:
    """Bring the stored states up to date; returns the number of partitions that were read.

    A partition is read if its files are not those of its state, and its state goes
    with it. A table without partitions is one of them. If the columns differ from
    those of the states, all is read anew.
    """
    table, parts = spark.table(target.name(spec.name)), list(spec.partition_by)
    columns = profiled(table, parts, columns)
    store, name = profile_spec(spec), target.name(profile_spec(spec).name)
    now = stamps(table, parts)
    old = spark.table(name) if spark.catalog.tableExists(name) else None
    if old is not None and old.select("profiled").limit(1).collect() != [(list(columns),)]:
        old = None
    changed = now
    if old is not None:
        known = renamed_keys(old, [*parts, STAMP])
        changed = now.join(known, same_key(now, known, [*parts, STAMP]), "left_anti")
    # As many rows as partitions changed.
    values = changed.select(*parts, STAMP).collect()
    rows = table
    if parts and old is not None and len(values) <= PARTITIONS_PER_PASS:
        rows = table.where(any_of([r[:-1] for r in values], parts))
    elif parts and old is not None:
        these = renamed_keys(changed, parts)
        rows = table.join(these, same_key(table, these, parts), "left_semi")
    new = states(rows if values else table.where("false"), parts, columns)
    if parts:
        by = renamed_keys(changed, [*parts, STAMP])
        new = new.join(by, same_key(new, by, parts)).withColumnRenamed(f"__{STAMP}", STAMP)
        new = new.drop(*[f"__{p}" for p in parts])
    else:
        new = new.withColumn(STAMP, F.lit(values[0][-1] if values else None).cast("long"))
    new = new.withColumn("profiled", F.array(*[F.lit(c) for c in columns]))
    if not parts and old is not None and not values:
        return 0
    if parts and old is not None:
        current = renamed_keys(now, [*parts, STAMP])
        stay = old.join(current, same_key(old, current, [*parts, STAMP]), "left_semi")
        new = stay.unionByName(new)
    write_bronze(new, target, store, evolve=False)
    return len(values)


def profiled(
    table: DataFrame, parts: Sequence[str], columns: Sequence[str] | None
) -> list[str]:
    """The columns of a profile: by default all but binary ones and those of the layout."""
    if columns:
        return list(columns)
    return [
        f.name
        for f in table.schema.fields
        if f.name not in parts and not isinstance(f.dataType, T.BinaryType)
    ]


def stored_profile(spark: SparkSession, target: Target, spec: TableSpec) -> DataFrame:
    """The profile as of the last refresh, in the shape of ``profile.column_profile``."""
    stored = spark.table(target.name(profile_spec(spec).name))
    first = stored.select("profiled").first()
    if first is None:  # no partition, so no row
        return spark.createDataFrame([], PROFILE_SCHEMA)
    return merged(stored, first[0])
