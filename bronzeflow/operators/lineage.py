"""Projection to the contract, and lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.config import RunContext
from bronzeflow.specs import TableSpec

# Lineage column names and the layer version.
STANDARD_LINEAGE = ("_extract_timestamp", "_source_system", "_batch_id")
CUSTOMERS_LINEAGE = (
    "extraction_timestamp",
    "source_system",
    "source_table",
    "bronze_layer_version",
)
BRONZE_LAYER_VERSION = "1.0"


def project(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """The contract's columns in its order.

    ``strict=False`` leaves out columns the source lacks, as the parquet
    stand-ins do.
    """
    columns = spec.columns if strict else [c for c in spec.columns if c in df.columns]
    return df.select(*columns)


def lineage_columns(spec: TableSpec) -> tuple[str, ...]:
    return CUSTOMERS_LINEAGE if spec.lineage == "customers" else STANDARD_LINEAGE


def add_lineage(df: DataFrame, spec: TableSpec, run: RunContext) -> DataFrame:
    ts, system = F.lit(run.ts), F.lit(run.source_system)
    if spec.lineage == "customers":
        values = (ts, system, F.lit(spec.source_table), F.lit(BRONZE_LAYER_VERSION))
    else:
        values = (ts, system, F.lit(run.batch_id(spec.batch_prefix)))
    return df.withColumns(dict(zip(lineage_columns(spec), values)))
