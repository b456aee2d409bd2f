"""Top-k, samples, schema listings and row-count inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``by``; ``tie`` settles equal values."""
    return df.orderBy(F.desc(by), *[F.asc_nulls_first(t) for t in tie]).limit(k)


def sample_rows(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows by key, to look at."""
    return df.orderBy(*[F.asc_nulls_first(k) for k in key]).limit(n)


def schema_listing(df: DataFrame) -> DataFrame:
    """``(position, column, type, nullable)`` of a DataFrame."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, as one UNION ALL."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("RecordCount")).select(
            F.lit(name).alias("TableName"), "RecordCount"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
