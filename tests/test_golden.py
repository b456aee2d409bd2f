"""Answers worked out by hand from the seed rows."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from bronzeflow.functions.expressions import fixed
from bronzeflow.operators import quality
from bronzeflow.operators.listing import schema_listing, table_inventory
from bronzeflow.plans import reports, views
from tests import seed


def test_customer_order_summary(spark):
    df = views.summary_by_value(
        views.customer_order_summary(
            seed.customers(spark), seed.orders(spark), seed.order_lines(spark)
        )
    )
    rows = [(r.CustomerID, r.TotalOrders, r.TotalValue, r.LastOrderDate) for r in df.collect()]
    assert rows == [
        (3, 3, Decimal("1843.75"), date(2024, 1, 17)),
        (8, 2, Decimal("991.50"), date(2024, 1, 19)),
        (2, 2, Decimal("178.00"), date(2024, 1, 16)),
        (7, 2, Decimal("124.00"), date(2024, 1, 18)),
        (1, 3, Decimal("75.50"), date(2024, 1, 15)),
        (4, 0, Decimal(0), None),
        (5, 0, Decimal(0), None),
        (6, 0, Decimal(0), None),
    ]


def test_order_without_lines_counts_once(spark):
    no_lines = seed.order_lines(spark).where("OrderID <> 5")
    df = views.customer_order_summary(seed.customers(spark), seed.orders(spark), no_lines)
    row = df.where("CustomerID = 8").first()
    assert (row.TotalOrders, row.TotalValue, row.LastOrderDate) == (1, 0, date(2024, 1, 19))


def test_row_counts(spark):
    tables = {n: seed.BUILDERS[n](spark) for n in ("customers", "stock_items", "orders")}
    tables["order_lines"] = seed.order_lines(spark)
    assert {r.TableName: r.RecordCount for r in table_inventory(tables).collect()} == {
        "customers": 8,
        "stock_items": 10,
        "orders": 5,
        "order_lines": 12,
    }


def test_line_statistics(spark):
    assert tuple(quality.stats_order_lines(seed.order_lines(spark)).first()) == (296, 16.01)


def test_item_statistics(spark):
    items = seed.stock_items(spark)
    assert tuple(quality.stats_stock_items(items).first()) == (17.59, Decimal("41.00"), 0)
    stats = reports.price_statistics(items).first()
    assert (stats.avg_price, stats.min_price, stats.max_price) == (
        17.59,
        Decimal("3.70"),
        Decimal("41.00"),
    )
    assert round(stats.price_stddev, 2) == 11.99


def test_item_completeness(spark):
    row = reports.stock_completeness(seed.stock_items(spark)).first()
    assert tuple(row) == (10, 10, 10, 10, 10, 100.0, 100.0, 100.0, 100.0)


def test_checks_find_nothing(spark):
    assert tuple(quality.dq_customers(seed.customers(spark)).first()) == (8, 0, 0)
    assert tuple(quality.dq_orders(seed.orders(spark)).first()) == (5, 0)
    assert tuple(quality.dq_order_lines(seed.order_lines(spark)).first()) == (12, 0, 0)
    assert tuple(quality.dq_stock_items(seed.stock_items(spark)).first()) == (10, 0, 0, 0)
    nulls = quality.declared_null_violations({n: f(spark) for n, f in seed.BUILDERS.items()})
    assert {r.n for r in nulls.collect()} == {0}


def test_holdings(spark):
    holdings = seed.stock_item_holdings(spark)
    # 10 * 2.50 + 0 - 2 * 1.00 + 4 * 10.00
    assert tuple(quality.dq_holdings(holdings).first()) == (4, 1, 1, 3, Decimal("63.00"))
    assert tuple(reports.inventory_statistics(holdings).first()) == (
        12,
        3.0,
        1,
        3,
        Decimal("63.00"),
    )


def test_categories(spark):
    groups, junction = seed.stock_groups(spark), seed.stock_item_stock_groups(spark)
    top = reports.category_distribution(groups, junction).collect()
    assert [tuple(r) for r in top] == [("Wrap", 3), ("Freight", 2)]
    assert [tuple(r) for r in reports.category_distribution(groups, junction, 1).collect()] == [
        ("Wrap", 3)
    ]
    assert {r[0] for r in quality.group_names(groups).collect()} == {"Wrap", "Freight"}
    # items 1 2 3 5 6 9 and NULL; groups 1 2 and NULL
    assert tuple(quality.stats_item_groups(junction).first()) == (7, 3)


def test_ties_go_by_name(spark):
    groups = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "StockGroupID int, StockGroupName string")
    junction = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "StockItemID int, StockGroupID int")
    top = reports.category_distribution(groups, junction, 2).collect()
    assert [r.StockGroupName for r in top] == ["a", "b"]


def test_schema_listing(spark):
    rows = schema_listing(seed.stock_groups(spark)).collect()
    assert [tuple(r) for r in rows] == [
        (1, "StockGroupID", "int", True),
        (2, "StockGroupName", "string", True),
        (3, "LastEditedBy", "int", True),
        (4, "ValidFrom", "timestamp", True),
        (5, "ValidTo", "timestamp", True),
    ]


def test_report_text(spark):
    rows = {
        r.metric: (r.value, r.pct, r.text)
        for r in reports.orders_quality_report(
            seed.orders(spark), seed.order_lines(spark)
        ).collect()
    }
    assert rows["orders"] == (5, None, "5")
    assert rows["orders_with_date"] == (5, 100.0, "5 (100.0%)")
    assert rows["lines_with_positive_quantity"] == (12, 100.0, "12 (100.0%)")


def test_stock_report_text(spark):
    rows = dict(
        (r.metric, r.text)
        for r in reports.stock_report(
            seed.stock_items(spark), seed.stock_item_holdings(spark)
        ).collect()
    )
    assert rows["average_unit_price"] == "$17.59"
    assert rows["price_range"] == "$3.70 - $41.00"
    assert rows["price_deviation"] == "$11.99"
    assert rows["average_quantity"] == "3.0"
    assert rows["inventory_value"] == "$63.00"
    assert rows["items_with_brand"] == "10 (100.0%)"


def test_report_text_of_empty_tables(spark):
    rows = dict(
        (r.metric, r.text)
        for r in reports.stock_report(
            seed.table(spark, "stock_items", []), seed.table(spark, "stock_item_holdings", [])
        ).collect()
    )
    assert rows["average_unit_price"] is None
    assert rows["price_range"] is None
    assert rows["average_quantity"] is None
    assert rows["items_with_name"] == "0"


def test_fixed_text_rounds_like_printf(spark):
    values = [100.05, 0.15, 0.25, 0.35, 1234.5, -0.05, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(fixed(F.col("x"), 1)).collect()] == [
        "%.1f" % v for v in values
    ]
