"""Managed bronze tables: full overwrite, schema evolution, verification."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.config import Target
from bronzeflow.specs import TableSpec


def ensure_namespace(spark: SparkSession, target: Target, use: bool = False) -> None:
    """Create the schema; ``use=True`` also makes it the session's current one.

    A catalog cannot be created by SQL in open-source Spark, it is a setting of
    the session; selecting one works.
    """
    location = f" LOCATION '{target.location}'" if target.location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {target.namespace}{location}")
    if use:
        if target.catalog:
            spark.sql(f"SET CATALOG `{target.catalog}`")
        spark.sql(f"USE SCHEMA `{target.schema}`")


def align_to_existing(df: DataFrame, existing: T.StructType) -> DataFrame:
    """Keep columns a table already has: a removed column comes back as NULL.

    New columns go last. Names are compared as the session compares them, that is
    without case unless it says otherwise, and keep the spelling of the table. A
    column whose type changed is an error, and so are two that are one name. This
    is what a merging table format does by itself; plain parquet would drop the
    column.
    """
    by_case = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    folded = (lambda name: name) if by_case else str.lower
    incoming: dict[str, T.StructField] = {}
    for f in df.schema.fields:
        if folded(f.name) in incoming:
            raise ValueError(f"column {f.name} is there twice")
        incoming[folded(f.name)] = f
    clash = [
        f"{f.name}: {f.dataType.simpleString()} -> {new.dataType.simpleString()}"
        for f in existing.fields
        if (new := incoming.get(folded(f.name))) and new.dataType != f.dataType
    ]
    if clash:
        raise ValueError(f"column types changed: {'; '.join(clash)}")
    known = {folded(f.name) for f in existing.fields}
    kept = [
        F.col(f"`{incoming[folded(f.name)].name}`").alias(f.name)
        if folded(f.name) in incoming
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in existing.fields
    ]
    return df.select(*kept, *[F.col(f"`{c}`") for c in df.columns if folded(c) not in known])


#: Formats whose files are the table: an overwrite has no transaction.
PLAIN_FORMATS = {"parquet", "orc", "avro", "csv", "json"}


def write_bronze(
    df: DataFrame,
    target: Target,
    spec: TableSpec,
    metrics: Sequence[Column] = (),
    evolve: bool = True,
    staged: bool = True,
) -> dict[str, Any]:
    """Overwrite a bronze table; return the metrics observed during that write.

    * ``evolve`` keeps columns the table already has (``align_to_existing``).
    * A partitioned table is rebalanced on its partition columns first: small
      dates share a task and get one file each, and a date that holds much of
      the table (NULL, say) is split over several tasks.
    * The metrics sit after that shuffle, in the stage that writes the files.
      Spark counts each task of that stage once, also when an executor is lost
      and tasks run again.
    * The rows of a file are sorted by primary key, and the files tell by Bloom
      filters which keys they hold, so that a later search for keys skips most.
    * ``staged``: where a table of plain files is there already, the rows are
      written once, beside it, and then take its place (``swap_in``). A source that
      fails leaves the old rows, and ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    name = target.name(spec.name)
    exists = spark.catalog.tableExists(name)
    if evolve and exists:
        df = align_to_existing(df, spark.table(name).schema)
    df, observation = observed(laid_out(df, spec), spec.name, metrics)
    df = sorted_by_key(df, spec)
    if staged and exists and target.table_format in PLAIN_FORMATS:
        drop_versions(spark, target, spec.name)
        landed = version_name(spec.name)
        try:
            save(df, target, target.name(landed), spec)
            swap_in(spark, target, landed, spec)
        except BaseException:
            settle_versions(spark, target, spec.name)
            drop_versions(spark, target, spec.name, only=landed)
            raise
    else:
        save(df, target, name, spec)
    # Only after the write: before it has succeeded this call would wait for ever.
    return observation.get if observation else {}


def observed(
    df: DataFrame, table: str, metrics: Sequence[Column]
) -> tuple[DataFrame, Observation | None]:
    if not metrics:
        return df, None
    observation = Observation(f"{table}-{uuid.uuid4().hex}")
    return df.observe(observation, *metrics), observation


def laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows where they are written: partitions shared out by size, a bucket to a task."""
    if spec.bucket_by:
        return df.repartition(spec.buckets, *spec.bucket_by)
    return df.hint("rebalance", *spec.partition_by) if spec.partition_by else df


def sorted_by_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of each task in order of partition or bucket, then of primary key."""
    first = (*spec.partition_by, *spec.bucket_by)
    order = [c for c in dict.fromkeys([*first, *spec.primary_key]) if c in df.columns]
    return df.sortWithinPartitions(*order) if order else df


#: Types of keys that a Bloom filter can be asked for by a pushed comparison.
FILTERED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)


#: A filter is the smallest of ten sizes, each half of the next, that holds its
#: keys: from 4 KB, since most partitions are small, to 2 MB.
FILTER_SIZES = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(2 << 20),
}


def key_filters(df: DataFrame, target: Target, spec: TableSpec | None) -> dict[str, str]:
    """Writer options for a Bloom filter on each key, as large as its keys need.

    Foreign keys have one too, but not in tables of many partitions: there each
    filter costs a little for every file.
    """
    if spec is None or target.table_format != "parquet":
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    foreign = [] if spec.partition_by else [f.column for f in spec.foreign_keys]
    looked_up = dict.fromkeys([*spec.primary_key, *foreign])
    keys = [k for k in looked_up if isinstance(types.get(k), FILTERED_TYPES)]
    per_key = {"enabled": "true", "candidates.number": "10"}
    options = {f"parquet.bloom.filter.{o}#{k}": v for k in keys for o, v in per_key.items()}
    return options | FILTER_SIZES if keys else {}


def save(
    df: DataFrame,
    target: Target,
    name: str,
    spec: TableSpec | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a table. Where ``target`` says so, its partitions are found by listing folders."""
    writer = df.write.mode(mode).format(target.table_format)
    if spec and spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    if spec and spec.bucket_by:
        writer = writer.bucketBy(spec.buckets, *spec.bucket_by).sortBy(*spec.bucket_by)
    writer = writer.options(**key_filters(df, target, spec))
    with partitions_in_catalog(df.sparkSession, target.catalog_partitions):
        writer.saveAsTable(name)


@contextmanager
def partitions_in_catalog(spark: SparkSession, wanted: bool) -> Iterator[None]:
    """Whether tables created meanwhile have their partitions in the catalog."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(wanted).lower())
    try:
        yield
    finally:
        spark.conf.set(key, before)


def version_name(table: str) -> str:
    return f"{table}__version_{uuid.uuid4().hex}"


def described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says about a table: location, provider of partitions, and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows}


def partitions_tracked(spark: SparkSession, name: str) -> bool:
    """Whether the catalog keeps the folder of every partition."""
    return described(spark, name).get("Partition Provider") == "Catalog"


def swap_in(spark: SparkSession, target: Target, landed: str, spec: TableSpec) -> None:
    """Put the rows of table ``landed`` in the place of those of the table of ``spec``.

    The table is pointed at the folder of ``landed`` by one call of the catalog, so
    it is there all the time, with the old rows or with the new ones, and nothing
    is copied on any store. ``landed`` then names the old folder, which stays until
    the next overwrite (``drop_versions``): queries that read it can finish.

    A table whose partitions are in the catalog has a pointer for each of them, and
    one whose columns go or change their type, or whose number of buckets changes,
    needs another entry. These are renamed instead, and the table is absent for a
    moment.
    """
    name, new = target.name(spec.name), target.name(landed)
    if not spark.catalog.tableExists(name):
        rename(spark, target, landed, spec.name, bool(spec.partition_by))
        spark.catalog.refreshTable(name)
        return
    tracked = partitions_tracked(spark, name) or partitions_tracked(spark, new)
    layout = [described(spark, t).get("Num Buckets") for t in (name, new)]
    if tracked or layout[0] != layout[1] or not same_shape(spark.table(name), spark.table(new)):
        rename_in(spark, target, landed, spec)
        return
    old_folder = described(spark, name)["Location"]
    new_folder = described(spark, new)["Location"]
    # Should the driver stop after the next step, this tells which folder is the old one.
    spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('{REPLACES}' = {literal(old_folder)})")
    known = {c.lower() for c in spark.table(name).columns}
    added = [f for f in spark.table(new).schema.fields if f.name.lower() not in known]
    if added:  # the old rows have NULL there
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    point_to(spark, name, new_folder)
    point_to(spark, new, old_folder)


def same_shape(old: DataFrame, new: DataFrame) -> bool:
    """Whether ``new`` has all columns of ``old``, and those of the layout last."""
    types = {f.name.lower(): f.dataType for f in new.schema.fields}
    return all(types.get(f.name.lower()) == f.dataType for f in old.schema.fields)


#: Property of a landed table: folder of the rows that it replaces.
REPLACES = "bronzeflow.replaces"


def point_to(spark: SparkSession, name: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {literal(folder)}")
    spark.catalog.refreshTable(name)


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def versions(spark: SparkSession, target: Target, table: str) -> list[str]:
    """Tables beside ``table`` that hold other versions of its rows."""
    rows = spark.sql(f"SHOW TABLES IN {target.namespace} LIKE '{table}__version_*'").collect()
    return [r.tableName for r in rows]


def settle_versions(spark: SparkSession, target: Target, table: str) -> None:
    """Finish a swap that stopped half way: no other table may point at the live folder."""
    name = target.name(table)
    if not spark.catalog.tableExists(name):
        return
    live = described(spark, name)["Location"]
    for version in versions(spark, target, table):
        other = target.name(version)
        if described(spark, other)["Location"] == live:
            properties = spark.sql(f"SHOW TBLPROPERTIES {other}").collect()
            point_to(spark, other, {r.key: r.value for r in properties}[REPLACES])


def drop_versions(spark: SparkSession, target: Target, table: str, only: str | None = None) -> None:
    """Remove versions that are not live, with their folders; ``only`` one of them."""
    settle_versions(spark, target, table)
    for version in versions(spark, target, table):
        if only in (None, version):
            spark.sql(f"DROP TABLE IF EXISTS {target.name(version)}")


def rename_in(spark: SparkSession, target: Target, landed: str, spec: TableSpec) -> None:
    """Put table ``landed`` in the place of the table of ``spec``, by renaming.

    The old table is dropped last; ``restore_previous`` brings it back if the
    driver died in between.
    """
    table, previous = spec.name, target.name(f"{spec.name}__previous")
    parts = bool(spec.partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    rename(spark, target, table, f"{table}__previous", parts)
    rename(spark, target, landed, table, parts)
    spark.catalog.refreshTable(target.name(table))
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def restore_previous(spark: SparkSession, target: Target, table: str) -> bool:
    """Undo a renaming that stopped half way, finish a swap that did. True if a table was renamed back."""
    settle_versions(spark, target, table)
    name, previous = target.name(table), target.name(f"{table}__previous")
    if spark.catalog.tableExists(name) or not spark.catalog.tableExists(previous):
        return False
    parts = any(c.isPartition for c in spark.catalog.listColumns(previous))
    rename(spark, target, f"{table}__previous", table, parts)
    return True


def rename(spark: SparkSession, target: Target, old: str, new: str, parts: bool) -> None:
    """Rename a table; ``parts`` tells that it has partitions.

    A catalog may keep the folders that partitions had before. They are told anew
    at once: dropped with the table, they might be those of its successor.
    """
    spark.sql(f"ALTER TABLE {target.name(old)} RENAME TO {target.name_in_catalog(new)}")
    if parts and partitions_tracked(spark, target.name(new)):
        spark.sql(f"MSCK REPAIR TABLE {target.name(new)} SYNC PARTITIONS")


def verify_load(
    spark: SparkSession, target: Target, table: str, expected: int | None
) -> DataFrame:
    """``(table, written, read_back, ok)``: count of the table against ``expected``."""
    counted = spark.table(target.name(table)).agg(F.count(F.lit(1)).alias("read_back"))
    written = F.lit(expected).cast("bigint")
    return counted.select(
        F.lit(table).alias("table"),
        written.alias("written"),
        "read_back",
        F.coalesce(F.col("read_back") == written, F.lit(False)).alias("ok"),
    )


def append_if_empty(df: DataFrame, target: Target, spec: TableSpec) -> bool:
    """Seed a table once. True if rows were appended, False if it had some.

    The table gets the layout of its contract; columns of an empty table that is
    there already stay.
    """
    spark = df.sparkSession
    name = target.name(spec.name)
    exists = spark.catalog.tableExists(name)
    if exists and not spark.table(name).isEmpty():
        return False
    if exists:
        old = spark.table(name).schema
        df = align_to_existing(df, old)
        if len(df.columns) > len(old):  # new columns: an append cannot add them
            write_bronze(df, target, spec)
            return True
    save(sorted_by_key(laid_out(df, spec), spec), target, name, spec, mode="append")
    return True
