"""Silver and gold tables.

An extension: planned as a next step only, so the semantics are our own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.operators.incremental import latest_per_key
from bronzeflow.operators.lineage import lineage_columns
from bronzeflow.plans.views import lines_per_order
from bronzeflow.specs import TableSpec, spark_type

# Fixed value: the end of validity of a row that is still current, at Spark's precision.
OPEN_END = "9999-12-31 23:59:59.999999"


def silver(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Current, typed, trimmed rows of a bronze table, one per primary key.

    Rows without a key drop out. Of several rows of a key the one edited last
    stays, so without the column that tells this is an error.
    """
    types = dict(spec.fields)
    columns = [c for c in df.columns if c not in lineage_columns(spec)]
    if "ValidTo" in columns:
        df = df.where(F.col("ValidTo").isNull() | (F.col("ValidTo") >= F.lit(OPEN_END)))

    def clean(column: str):
        c = F.col(column)
        wanted = spark_type(types[column]) if column in types else None
        if isinstance(df.schema[column].dataType, T.StringType):
            c = F.nullif(F.trim(c), F.lit(""))
        # Keys keep their width: a source may hold more of them than fit an int.
        if wanted is not None and not isinstance(wanted, T.IntegerType):
            c = c.try_cast(wanted)
        return c.alias(column)

    rows = df.select(*[clean(c) for c in columns]).where(
        " AND ".join(f"{k} IS NOT NULL" for k in spec.primary_key)
    )
    if spec.edited_column not in columns:
        raise ValueError(f"{spec.name}: no column {spec.edited_column} to tell the last edit")
    return latest_per_key(rows, spec.primary_key, spec.edited_column)


def sales_per_order(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``(OrderID, OrderDate, orders, lines, revenue)`` of the dated orders.

    Lines fold per order before the join. Orders without an id match no line and
    take a branch of their own, a row for each.
    """
    dated = orders.where(F.col("OrderDate").isNotNull()).select("OrderID", "OrderDate")
    keyed = (
        dated.where(F.col("OrderID").isNotNull())
        .groupBy("OrderID", "OrderDate")
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(lines_per_order(lines), "OrderID", "left")
        .select(
            "OrderID",
            "OrderDate",
            F.col("copies").alias("orders"),
            (F.col("copies") * F.col("line_count")).alias("lines"),
            (F.col("copies") * F.col("line_value")).cast("decimal(38,2)").alias("revenue"),
        )
    )
    unkeyed = dated.where(F.col("OrderID").isNull()).select(
        "OrderID",
        "OrderDate",
        F.lit(1).cast("bigint").alias("orders"),
        F.lit(None).cast("bigint").alias("lines"),
        F.lit(None).cast("decimal(38,2)").alias("revenue"),
    )
    return keyed.unionByName(unkeyed)


def sales_by_date(sales: DataFrame) -> DataFrame:
    """Sums of orders, lines and revenue per order date."""
    return sales.groupBy("OrderDate").agg(
        F.sum("orders").alias("orders"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(38,2)").alias("revenue"),
    )


def daily_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders, lines and revenue per order date."""
    return sales_by_date(sales_per_order(orders, lines))


def category_revenue(lines: DataFrame, groups: DataFrame, junction: DataFrame) -> DataFrame:
    """Quantity and revenue per group name.

    An item in several groups counts in each, once however often the junction
    repeats the pair. Lines fold per item and the junction to its distinct pairs
    before they meet.
    """
    per_item = (
        lines.where(F.col("StockItemID").isNotNull())
        .groupBy("StockItemID")
        .agg(
            F.sum("Quantity").cast("bigint").alias("quantity"),
            F.sum(F.col("Quantity") * F.col("UnitPrice")).cast("decimal(38,2)").alias("revenue"),
        )
    )
    pairs = junction.select("StockItemID", "StockGroupID").distinct()
    per_group = (
        pairs.join(per_item, "StockItemID")
        .groupBy("StockGroupID")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        )
    )
    return (
        groups.select("StockGroupID", "StockGroupName")
        .join(per_group, "StockGroupID")
        .groupBy("StockGroupName")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        )
    )
