"""What the operators of this subpackage share: tables, words, scratch tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.session import scratch_path

#: White space between words: a word is a run of ``[^\x20\x09-\x0D]``.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read back: cuts the lineage.

    A lost executor then costs the running stage only, and whatever was not
    deterministic (row order, salts) is frozen.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text that is not null."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x20\x09-\x0D]+")
    )


def count_words(text: Column) -> Column:
    """Number of words: starts of words, found without building an array."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of the steps that are done.

    It does so when the driver's garbage is collected, which a driver with little
    to do may put off for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
