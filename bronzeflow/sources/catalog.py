"""Bronze tables as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bronzeflow.config import Target


def read_bronze(spark: SparkSession, target: Target, name: str) -> DataFrame:
    return spark.table(target.name(name))
