"""Load reports and business figures over bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.functions.expressions import (
    count_with_pct,
    exact_avg,
    fixed,
    inventory_value,
    money,
    pct,
    thousands,
)
from bronzeflow.operators.listing import top_k
from bronzeflow.operators.quality import unpivot_row


def orders_quality(orders: DataFrame) -> DataFrame:
    """Orders with a customer and with a date: counts and percent, one scan."""
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("CustomerID").alias("with_customer"),
        F.count("OrderDate").alias("with_date"),
    ).select(
        "*",
        pct(F.col("with_customer"), F.col("orders")).alias("pct_customer"),
        pct(F.col("with_date"), F.col("orders")).alias("pct_date"),
    )


def lines_quality(lines: DataFrame) -> DataFrame:
    """Lines with a stock item and with a positive quantity, one scan."""
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("StockItemID").alias("with_stock"),
        F.count_if(F.col("Quantity") > 0).alias("positive"),
    ).select(
        "*",
        pct(F.col("with_stock"), F.col("lines")).alias("pct_stock"),
        pct(F.col("positive"), F.col("lines")).alias("pct_positive"),
    )


def orders_quality_report(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``(metric, value, pct, text)``: the orders summary, one scan per table."""

    def row(metric: str, count: str, percent: str | None = None) -> dict:
        share = F.col(percent) if percent else F.lit(None).cast("double")
        return {
            "metric": F.lit(metric),
            "value": F.col(count),
            "pct": share,
            "text": count_with_pct(F.col(count), share),
        }

    order_rows = unpivot_row(
        orders_quality(orders),
        [
            row("orders", "orders"),
            row("orders_with_customer", "with_customer", "pct_customer"),
            row("orders_with_date", "with_date", "pct_date"),
        ],
    )
    line_rows = unpivot_row(
        lines_quality(lines),
        [
            row("order_lines", "lines"),
            row("lines_with_stock_item", "with_stock", "pct_stock"),
            row("lines_with_positive_quantity", "positive", "pct_positive"),
        ],
    )
    return order_rows.unionByName(line_rows)


def price_statistics(items: DataFrame) -> DataFrame:
    """Average, range and sample deviation of the positive prices."""
    return items.where("UnitPrice > 0").agg(*price_figures("UnitPrice"))


def price_figures(price: str) -> list[Column]:
    return [
        exact_avg(price, 4).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.round(F.stddev_samp(price), 4).alias("price_stddev"),
    ]


def inventory_statistics(holdings: DataFrame) -> DataFrame:
    return holdings.agg(
        F.sum("QuantityOnHand").cast("bigint").alias("total_quantity"),
        F.round(F.avg("QuantityOnHand"), 4).alias("avg_quantity"),
        F.count_if(F.col("QuantityOnHand") == 0).alias("zero_stock_items"),
        F.count_if(F.col("QuantityOnHand") < F.col("ReorderLevel")).alias("below_reorder_items"),
        inventory_value().alias("inventory_value"),
    )


def category_sizes(groups: DataFrame, junction: DataFrame) -> DataFrame:
    """Distinct stock items per group name.

    The distinct count is planned in two steps, on (name, item) and then on
    name, so a group with most of the items is spread over all tasks.
    """
    return (
        groups.select("StockGroupID", "StockGroupName")
        .join(junction.select("StockGroupID", "StockItemID"), "StockGroupID")
        .groupBy("StockGroupName")
        .agg(F.count_distinct("StockItemID").alias("item_count"))
    )


def category_distribution(groups: DataFrame, junction: DataFrame, k: int = 5) -> DataFrame:
    """The k group names with most items; equal counts by name."""
    return top_k(category_sizes(groups, junction), "item_count", k, ["StockGroupName"])


COMPLETE_PARTS = ("name", "price", "brand", "size")


def completeness_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_items"),
        F.count("StockItemName").alias("items_with_name"),
        F.count_if(F.col("UnitPrice") > 0).alias("items_with_price"),
        F.count("Brand").alias("items_with_brand"),
        F.count("Size").alias("items_with_size"),
    ]


def completeness_shares() -> list[Column]:
    total = F.col("total_items")
    return [
        pct(F.col(f"items_with_{part}"), total).alias(f"pct_{part}") for part in COMPLETE_PARTS
    ]


def stock_completeness(items: DataFrame) -> DataFrame:
    """Items with a name, a positive price, a brand, a size: counts and percent."""
    return items.agg(*completeness_counts()).select("*", *completeness_shares())


def stock_report(items: DataFrame, holdings: DataFrame) -> DataFrame:
    """``(metric, text)``: price, completeness and inventory figures as printed.

    Each table is read once: what concerns positive prices only is NULL elsewhere.
    """
    positive = items.withColumn("price", F.when(F.col("UnitPrice") > 0, F.col("UnitPrice")))
    counts = positive.agg(*price_figures("price"), *completeness_counts()).select(
        "*", *completeness_shares()
    )
    about_items = unpivot_row(
        counts,
        [
            {"metric": F.lit("average_unit_price"), "text": money(F.col("avg_price"))},
            {
                "metric": F.lit("price_range"),
                "text": F.concat(
                    money(F.col("min_price")), F.lit(" - "), money(F.col("max_price"))
                ),
            },
            {"metric": F.lit("price_deviation"), "text": money(F.col("price_stddev"))},
            *[
                {
                    "metric": F.lit(f"items_with_{part}"),
                    "text": count_with_pct(F.col(f"items_with_{part}"), F.col(f"pct_{part}")),
                }
                for part in COMPLETE_PARTS
            ],
        ],
    )
    stock = unpivot_row(
        inventory_statistics(holdings),
        [
            {"metric": F.lit("total_quantity"), "text": thousands(F.col("total_quantity"))},
            {
                "metric": F.lit("average_quantity"),
                "text": F.when(F.col("avg_quantity").isNotNull(), fixed(F.col("avg_quantity"), 1)),
            },
            {"metric": F.lit("out_of_stock"), "text": thousands(F.col("zero_stock_items"))},
            {"metric": F.lit("below_reorder"), "text": thousands(F.col("below_reorder_items"))},
            {"metric": F.lit("inventory_value"), "text": money(F.col("inventory_value"))},
        ],
    )
    return about_items.unionByName(stock)
