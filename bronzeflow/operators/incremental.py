"""Incremental load by high-water mark, and upsert.

A documented feature without a given implementation, so the semantics here are
our own. Works on plain partitioned files, which know no MERGE.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from bronzeflow.config import Target
from bronzeflow.operators.sinks import (
    align_to_existing,
    drop_versions,
    literal,
    partitions_tracked,
    restore_previous,
    save,
    sorted_by_key,
    swap_in,
    version_name,
)
from bronzeflow.session import job_session
from bronzeflow.specs import TableSpec


def high_water_mark(bronze: DataFrame, column: str) -> datetime | None:
    """The latest edit that bronze holds; None for an empty table."""
    return bronze.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Rows edited at the mark or later, or without a time: plain tests, so the scan can prune.

    A row may be committed in the microsecond of the mark after the mark was
    taken, and nothing tells when a row without a time was edited. Both kinds are
    offered again; the upsert takes them again without harm.
    """
    return df if mark is None else df.where((F.col(column) >= F.lit(mark)) | F.col(column).isNull())


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The row with the largest ``order_by`` of each key, NULL being the smallest.

    Equal ``order_by`` is settled by the other columns. An aggregate, not a
    window: a key with many versions folds before the shuffle. Rows are sorted by
    key on both sides of it, since a struct is no buffer for a hash aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [order_by] + [c for c in rest if c != order_by]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("row"))
    return newest.select(*[c if c in keys else F.col("row")[c].alias(c) for c in df.columns])


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of the keys, a NULL key being equal to a NULL key."""
    return reduce(
        Column.__and__, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    )


def renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__{k}") for k in keys])


def later(left: Column, right: Column) -> Column:
    """``left > right``, NULL being the smallest."""
    return F.coalesce(left > right, left.isNotNull() & right.isNull())


def not_beaten(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: str
) -> DataFrame:
    """Rows of ``base`` whose key has no incoming row edited at the same time or later.

    The incoming keys join undeduplicated: a small increment is broadcast by its
    size, a large one leaves the base side free to be split where it is uneven.
    """
    new = renamed_keys(incoming, list(dict.fromkeys([*keys, order_by])))
    beaten = same_key(base, new, keys) & ~later(base[order_by], new[f"__{order_by}"])
    return base.join(new, beaten, "left_anti")


def winners(
    incoming: DataFrame, base: DataFrame, keys: Sequence[str], order_by: str
) -> DataFrame:
    """The latest incoming row of each key, unless ``base`` has a later one."""
    latest = latest_per_key(incoming, keys, order_by)
    old = renamed_keys(base, list(dict.fromkeys([*keys, order_by])))
    lost = same_key(latest, old, keys) & later(old[f"__{order_by}"], latest[order_by])
    return latest.join(old, lost, "left_anti")


def upsert(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: str
) -> DataFrame:
    """``base`` with the latest incoming row of each key in place of its own.

    The newest edit wins, whichever side has it; of equal ones the incoming does.
    """
    kept = not_beaten(base, incoming, keys, order_by)
    return kept.unionByName(winners(incoming, base, keys, order_by))


#: Partitions that one pass of an upsert rewrites.
PARTITIONS_PER_PASS = 1000
#: Keys of an increment that stand as a list in the filter of a scan.
KEY_LIST = 1000


def of_keys(rows: DataFrame, keys: Sequence[str], most: int = KEY_LIST) -> Column:
    """A test of literals that every row with a key of ``rows`` passes.

    Up to ``most`` keys are listed, and a scan asks the statistics and the Bloom
    filter of each row group for them; of more keys the range is given. It only
    spares reading: rows that pass are still joined by key. So a sketch tells first
    whether there are far more, and only then are they not shuffled to be listed.
    """
    ends = rows.agg(
        F.approx_count_distinct(F.xxhash64(*keys)).alias("about"),
        *[f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max))],
        *[F.count_if(F.col(k).isNull()).alias(f"nulls_{i}") for i, k in enumerate(keys)],
    ).first()
    tests = []
    # Four standard errors of the sketch.
    listed = rows.select(*keys).distinct().limit(most + 1).collect() if ends["about"] <= 1.2 * most else None
    if listed is not None and len(listed) <= most:
        for k in keys:
            test = one_of(k, sorted({r[k] for r in listed if r[k] is not None}))
            tests.append(test | F.col(k).isNull() if any(r[k] is None for r in listed) else test)
        return reduce(Column.__and__, tests)
    for i, k in enumerate(keys):
        low, high, nulls = ends[f"low_{i}"], ends[f"high_{i}"], ends[f"nulls_{i}"]
        test = F.col(k).between(low, high) if low is not None else F.lit(False)
        tests.append(test | F.col(k).isNull() if nulls else test)
    return reduce(Column.__and__, tests)


def one_of(column: str, values: Sequence[object]) -> Column:
    """``column IN (...)``; numbers and texts as one SQL text, since a list is long."""
    if not values:
        return F.lit(False)
    if all(type(v) in (int, str) for v in values):
        listed = ", ".join(literal(v) if isinstance(v, str) else str(v) for v in values)
        return F.expr(f"`{column}` IN ({listed})")
    return F.col(column).isin(list(values))


def key_session(spark: SparkSession) -> SparkSession:
    """A session whose scans are told the keys of a list one by one, not as a range."""
    return job_session(spark, **{"spark.sql.parquet.pushdown.inFilterThreshold": str(KEY_LIST)})


def upsert_table(
    spark: SparkSession,
    target: Target,
    spec: TableSpec,
    incoming: DataFrame,
    order_by: str,
    keys_stay: bool = False,
) -> None:
    """Upsert rows into a bronze table by its primary key.

    The result is written beside the table first. A partitioned table then has
    only the touched partitions overwritten: those of the incoming rows that win,
    and those the replaced versions were in. Their values, a list as long as the
    touched partitions at most, are literals in the filter of the scan, so no
    other partition is read for it, at any size of the increment.

    The old versions are searched for by the keys of the increment, as literals
    (``of_keys``): files are sorted by key and have Bloom filters on it, so of the
    key columns only row groups that may hold one of the keys are read. With
    ``keys_stay``, a promise that a key never changes its partition, only the
    incoming partitions are looked at.

    Running the same increment again gives the same table, so a run that stopped
    half way is repaired by repeating it. Side tables have names of their own for
    every run; a dead driver may leave some, called ``<table>__side_...``.
    """
    caller, spark = spark, key_session(spark)
    restore_previous(spark, target, spec.name)
    name, keys, parts = target.name(spec.name), spec.primary_key, list(spec.partition_by)
    base = spark.table(name)
    run, made = uuid.uuid4().hex, []

    def side(what: str, rows: DataFrame) -> DataFrame:
        table = f"{spec.name}__side_{run}_{what}"
        made.append(table)
        save(rows, target, target.name(table))
        return spark.table(target.name(table))

    try:
        # The increment is used several times; the source is read once.
        increment = side("rows", align_to_existing(incoming, base.schema).select(*base.columns))
        if not parts:
            drop_versions(spark, target, spec.name)
            landed = version_name(spec.name)
            rows = sorted_by_key(upsert(base, increment, keys, order_by), spec)
            try:
                save(rows, target, target.name(landed), spec)
                swap_in(spark, target, landed, spec)
            except BaseException:
                drop_versions(spark, target, spec.name, only=landed)
                raise
            return
        searched = base.where(of_keys(increment, keys))
        if keys_stay:
            searched = searched.where(any_of(increment.select(*parts).distinct().collect(), parts))
        needed = list(dict.fromkeys([*keys, order_by, *parts]))
        own = renamed_keys(increment, keys)
        slim = searched.select(*needed)
        met = side("met", slim.join(own, same_key(slim, own, keys), "left_semi"))
        won = side("won", winners(increment, met, keys, order_by))
        stay = not_beaten(met, increment, keys, order_by).select(*needed)
        beaten = met.exceptAll(stay)
        # As many rows as partitions are touched, at most.
        touched = beaten.select(*parts).unionByName(won.select(*parts)).distinct().collect()
        for at in range(0, len(touched), PARTITIONS_PER_PASS):
            some = touched[at : at + PARTITIONS_PER_PASS]
            old = base.where(any_of(some, parts))
            rows = not_beaten(old, increment, keys, order_by).unionByName(
                won.where(any_of(some, parts))
            )
            staged = side(f"result{at}", rows)
            overwrite_partitions(spark, target.name(made[-1]), name, spec)
            full = {tuple(r) for r in staged.select(*parts).distinct().collect()}
            drop_partitions(spark, name, [r for r in some if tuple(r) not in full], parts)
    finally:
        for table in made:
            spark.sql(f"DROP TABLE IF EXISTS {target.name(table)}")
        # The caller's session may have listed the replaced files.
        caller.catalog.refreshTable(name)


def any_of(values: Sequence[Row], columns: Sequence[str]) -> Column:
    """Rows of these partitions, as a test of literals that prunes a scan."""
    if len(columns) == 1:
        known = [r[0] for r in values if r[0] is not None]
        test = F.col(columns[0]).isin(known) if known else F.lit(False)
        return test | F.col(columns[0]).isNull() if len(known) < len(values) else test
    rows = [
        reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, r)])
        for r in values
    ]
    return reduce(Column.__or__, rows) if rows else F.lit(False)


def overwrite_partitions(spark: SparkSession, rows_of: str, table: str, spec: TableSpec) -> None:
    """Replace the partitions that table ``rows_of`` has rows for, and no others.

    The overwrite mode is a setting, so the insert runs in a session of its own.
    """
    session = job_session(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"})
    columns = session.table(table).columns
    rows = session.table(rows_of).select(*columns).hint("rebalance", *spec.partition_by)
    sorted_by_key(rows, spec).write.insertInto(table, overwrite=True)
    # The caller's session may have listed the replaced files.
    spark.catalog.refreshTable(table)


def drop_partitions(
    spark: SparkSession, table: str, values: Sequence[Row], columns: Sequence[str]
) -> None:
    """Drop partitions whose rows all moved away.

    In the catalog that is metadata, a batch at a time. Where partitions are found
    by listing, each is overwritten with no rows.
    """
    if values and not partitions_tracked(spark, table):
        fields = [f for f in spark.table(table).schema.fields if f.name not in columns]
        rest = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields]
        session = job_session(spark, **{"spark.sql.sources.partitionOverwriteMode": "static"})
        for row in values:
            session.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION ({partition_spec(row, columns)})"
                f" SELECT {', '.join(rest)} WHERE false"
            )
        spark.catalog.refreshTable(table)
        return
    for at in range(0, len(values), 500):
        partitions = ", ".join(
            f"PARTITION ({partition_spec(row, columns)})" for row in values[at : at + 500]
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partitions}")


def partition_spec(row: Row, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` = {partition_literal(v)}" for c, v in zip(columns, row))


def partition_literal(value: object) -> str:
    return "NULL" if value is None else literal(str(value))
