"""The per-customer order summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines_per_order(lines: DataFrame) -> DataFrame:
    """Line count and value of each order; lines without an order drop out."""
    return (
        lines.where(F.col("OrderID").isNotNull())
        .groupBy("OrderID")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("Quantity") * F.col("UnitPrice")).cast("decimal(38,2)").alias("line_value"),
        )
    )


def orders_per_customer(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Joined rows, their value and the last order date, per customer."""
    owned = orders.where(F.col("CustomerID").isNotNull())
    # Copies of an order fold here, before the join on the order id.
    keyed = (
        owned.where(F.col("OrderID").isNotNull())
        .groupBy("OrderID", "CustomerID")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("OrderDate").alias("last_date"))
    )
    with_lines = keyed.join(lines_per_order(lines), "OrderID", "left").select(
        "CustomerID",
        # An order without lines still is one row of the outer join.
        (F.col("copies") * F.coalesce("line_count", F.lit(1))).alias("joined_rows"),
        (F.col("copies") * F.col("line_value")).cast("decimal(38,2)").alias("value"),
        "last_date",
    )
    # Orders without an id match no line and count as no order, but they have a
    # date. They take this branch, so that NULL is never a join key.
    unkeyed = owned.where(F.col("OrderID").isNull()).select(
        "CustomerID",
        F.lit(0).cast("bigint").alias("joined_rows"),
        F.lit(None).cast("decimal(38,2)").alias("value"),
        F.col("OrderDate").alias("last_date"),
    )
    return (
        with_lines.unionByName(unkeyed)
        .groupBy("CustomerID")
        .agg(
            F.sum("joined_rows").alias("joined_rows"),
            F.sum("value").cast("decimal(38,2)").alias("value"),
            F.max("last_date").alias("LastOrderDate"),
        )
    )


def customer_order_summary(
    customers: DataFrame, orders: DataFrame, lines: DataFrame
) -> DataFrame:
    """One row per (CustomerID, CustomerName).

    ``TotalOrders`` counts the rows of customers left join orders left join
    lines: an order counts once per line, and a duplicated customer row doubles
    everything. That fan-out is computed instead of produced: lines fold per
    order, orders per customer, duplicated customers into a multiplier. Each
    fold has a map-side part, so a key that holds a large share of the rows
    costs the shuffle one row per task.
    """
    people = customers.groupBy("CustomerID", "CustomerName").agg(
        F.count(F.lit(1)).alias("copies")
    )
    per_customer = orders_per_customer(orders, lines)
    with_orders = people.where(F.col("CustomerID").isNotNull()).join(
        per_customer, "CustomerID", "left"
    )
    # Customers without an id have no orders; they stay out of the join.
    without_id = people.where(F.col("CustomerID").isNull())
    return with_orders.unionByName(without_id, allowMissingColumns=True).select(
        "CustomerID",
        "CustomerName",
        F.coalesce(F.col("copies") * F.col("joined_rows"), F.lit(0)).alias("TotalOrders"),
        F.coalesce(F.col("copies") * F.col("value"), F.lit(0))
        .cast("decimal(38,2)")
        .alias("TotalValue"),
        "LastOrderDate",
    )


def summary_by_value(summary: DataFrame) -> DataFrame:
    """The summary, most valuable customers first; ties by id, then name."""
    return summary.orderBy(
        F.desc("TotalValue"), F.asc_nulls_first("CustomerID"), F.asc_nulls_first("CustomerName")
    )
