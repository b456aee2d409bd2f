"""Data-quality checks and statistics.

Every per-row rule and every statistic of a table is one aggregate expression,
so all of them come out of a single pass: ``df.agg`` over a table, or
``df.observe`` while it is written (see ``sinks.write_bronze``).

Duplicates, orphans and distinct counts need a shuffle and run on the written
tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.functions.expressions import exact_avg, inventory_value
from bronzeflow.specs import SPECS


@dataclass(frozen=True)
class Rule:
    """A row that satisfies ``predicate`` counts as a finding."""

    metric: str
    predicate: str
    severity: str = "warning"


RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (Rule("null_names", "CustomerName IS NULL", "info"),),
    "orders": (Rule("null_order_id", "OrderID IS NULL"),),
    "order_lines": (
        Rule("null_order_line_id", "OrderLineID IS NULL"),
        Rule("null_order_id", "OrderID IS NULL"),
    ),
    "stock_items": (
        Rule("null_stock_item_id", "StockItemID IS NULL"),
        Rule("null_name", "StockItemName IS NULL"),
        Rule("price_not_positive", "UnitPrice <= 0", "info"),
    ),
    "stock_item_holdings": (
        Rule("negative_stock", "QuantityOnHand < 0", "info"),
        Rule("zero_stock", "QuantityOnHand = 0", "info"),
        Rule("below_reorder", "QuantityOnHand < ReorderLevel", "info"),
    ),
    "stock_groups": (),
    "stock_item_stock_groups": (),
}


def total_rows() -> Column:
    return F.count(F.lit(1)).alias("total")


def rule_metrics(table: str) -> list[Column]:
    return [F.count_if(F.expr(r.predicate)).alias(r.metric) for r in RULES[table]]


def statistics(table: str) -> list[Column]:
    """The figures reported with a table's load, besides its checks."""
    if table == "order_lines":
        return [
            F.sum("Quantity").cast("bigint").alias("total_quantity"),
            exact_avg("UnitPrice", 2).alias("avg_unit_price"),
        ]
    if table == "stock_items":
        return [
            exact_avg("UnitPrice", 4).alias("avg_unit_price"),
            F.max("UnitPrice").alias("max_unit_price"),
            F.count_if(F.col("IsChillerStock")).alias("chiller_items"),
        ]
    if table == "stock_item_holdings":
        return [inventory_value().alias("inventory_value")]
    return []


def load_metrics(table: str) -> list[Column]:
    """All one-pass metrics of a table: for ``df.agg`` and for ``df.observe``."""
    return [total_rows(), *rule_metrics(table), *statistics(table)]


def count_where(df: DataFrame, predicates: Mapping[str, str | Column]) -> DataFrame:
    """Rows that satisfy each predicate, all in one pass; NULL does not count."""
    return df.agg(
        *[
            F.count_if(F.expr(p) if isinstance(p, str) else p).alias(metric)
            for metric, p in predicates.items()
        ]
    )


def unpivot_row(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry of ``rows``."""
    structs = [F.struct(*[c.alias(k) for k, c in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def check_report(df: DataFrame, table: str) -> DataFrame:
    """``(table, check, severity, failed, total)``, a row per rule of the table."""
    if not RULES[table]:
        raise ValueError(f"no row rules for {table}")
    return unpivot_row(
        df.agg(total_rows(), *rule_metrics(table)),
        [
            {
                "table": F.lit(table),
                "check": F.lit(r.metric),
                "severity": F.lit(r.severity),
                "failed": F.col(r.metric),
                "total": F.col("total"),
            }
            for r in RULES[table]
        ],
    )


def dq_customers(df: DataFrame) -> DataFrame:
    """Total, null names, and the number of ids that occur more than once.

    One scan: the counts per id hold everything, and partial aggregation folds
    a frequent id before the shuffle.
    """
    per_id = df.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("CustomerName").isNull()).alias("unnamed"),
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum("unnamed"), F.lit(0)).cast("bigint").alias("null_names"),
        F.count_if(F.col("n") > 1).alias("duplicate_ids"),
    )


def dq_orders(df: DataFrame) -> DataFrame:
    return df.agg(total_rows(), *rule_metrics("orders"))


def dq_order_lines(df: DataFrame) -> DataFrame:
    return df.agg(total_rows(), *rule_metrics("order_lines"))


def stats_order_lines(df: DataFrame) -> DataFrame:
    return df.agg(*statistics("order_lines"))


def dq_stock_items(df: DataFrame) -> DataFrame:
    return df.agg(total_rows(), *rule_metrics("stock_items"))


def stats_stock_items(df: DataFrame) -> DataFrame:
    return df.agg(*statistics("stock_items"))


def dq_holdings(df: DataFrame) -> DataFrame:
    return df.agg(
        total_rows(), *rule_metrics("stock_item_holdings"), *statistics("stock_item_holdings")
    )


def group_names(df: DataFrame) -> DataFrame:
    return df.select("StockGroupName").distinct()


def distinct_with_null(column: str) -> Column:
    """Distinct values of a column, NULL being one of them."""
    c = F.col(column)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def distinct_non_null(column: str) -> Column:
    """Distinct values of a column, NULL left out, as SQL counts them."""
    return F.count_distinct(F.col(column))


def stats_item_groups(df: DataFrame) -> DataFrame:
    return df.agg(
        distinct_with_null("StockItemID").alias("items"),
        distinct_with_null("StockGroupID").alias("groups"),
    )


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL is a key too."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_violations(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """``(table, column, n)``: NULLs in columns that may not hold any, in one pass."""
    counts = count_where(df, {c: F.col(c).isNull() for c in columns})
    return unpivot_row(
        counts, [{"table": F.lit(table), "column": F.lit(c), "n": F.col(c)} for c in columns]
    )


def declared_null_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``null_violations`` of several tables, by the NOT NULL columns of their specs."""
    parts = [null_violations(df, name, SPECS[name].not_null) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def orphan_rows(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Child rows whose key is set but has no parent.

    Both sides go into the join as they are: a large, uneven child is then split
    at run time (adaptive skew join), and a parent of small known size is
    broadcast by the planner.
    """
    keys = parent.select(F.col(parent_key).alias("__parent_key"))
    present = child.where(F.col(child_key).isNotNull())
    return present.join(keys, present[child_key] == keys["__parent_key"], "left_anti")
