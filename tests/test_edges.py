"""Empty tables, NULL keys, single rows, and properties that always hold."""

from datetime import date
from decimal import Decimal

import pytest

from bronzeflow.operators import profile, quality
from bronzeflow.operators.listing import sample_rows, top_k
from bronzeflow.plans import layers, reports, views
from bronzeflow.sources.fixtures import bronze_input
from bronzeflow.specs import SPECS
from tests import seed
from tests.compare import spark_rows

SF_DIR = "/root/testdata/sf0.001"


def empty(spark, name):
    return seed.table(spark, name, [])


@pytest.mark.parametrize("name", SPECS)
def test_metrics_of_an_empty_table(spark, name):
    row = empty(spark, name).agg(*quality.load_metrics(name)).first().asDict()
    assert row.pop("total") == 0
    assert set(row.values()) <= {0, None}


def test_reports_over_empty_tables(spark):
    assert tuple(reports.orders_quality(empty(spark, "orders")).first()) == (0, 0, 0, None, None)
    assert tuple(reports.price_statistics(empty(spark, "stock_items")).first()) == (None,) * 4
    assert tuple(quality.dq_customers(empty(spark, "customers")).first()) == (0, 0, 0)
    assert reports.stock_completeness(empty(spark, "stock_items")).first().pct_name is None
    assert (
        reports.category_distribution(
            empty(spark, "stock_groups"), empty(spark, "stock_item_stock_groups")
        ).count()
        == 0
    )
    summary = views.customer_order_summary(
        seed.customers(spark), empty(spark, "orders"), empty(spark, "order_lines")
    )
    assert {tuple(r)[2:] for r in summary.collect()} == {(0, Decimal(0), None)}


def test_one_row_has_no_deviation(spark):
    one = seed.stock_items(spark).where("StockItemID = 1")
    row = reports.price_statistics(one).first()
    assert (row.avg_price, row.price_stddev) == (3.7, None)


def test_null_and_duplicate_keys(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (None, None), (None, "b"), (2, None)],
        "CustomerID int, CustomerName string",
    )
    assert tuple(quality.dq_customers(df).first()) == (5, 2, 2)
    assert {tuple(r) for r in quality.duplicate_keys(df, ["CustomerID"]).collect()} == {
        (1, 2),
        (None, 2),
    }
    distinct = df.agg(
        quality.distinct_with_null("CustomerID").alias("a"),
        quality.distinct_non_null("CustomerID").alias("b"),
    )
    assert tuple(distinct.first()) == (3, 2)
    assert df.select("CustomerID").distinct().count() == 3


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x int")
    assert df.agg(quality.distinct_with_null("x")).first()[0] == 1
    assert [tuple(r) for r in profile.column_completeness(df).collect()] == [("x", 0, 0.0)]
    row = profile.column_profile(df).first()
    assert (row["rows"], row["nulls"], row["distinct"], row["min"], row["mean"]) == (
        2, 2, 0, None, None,
    )


def naive_summary(spark, customers, orders, lines):
    """The summary as one joins it by hand: the fan-out is really produced."""
    customers.createOrReplaceTempView("naive_c")
    orders.createOrReplaceTempView("naive_o")
    lines.createOrReplaceTempView("naive_l")
    return spark.sql(
        """SELECT c.CustomerID, c.CustomerName, count(o.OrderID) AS TotalOrders,
        CAST(coalesce(sum(l.Quantity * l.UnitPrice), 0) AS DECIMAL(38,2)) AS TotalValue,
        max(o.OrderDate) AS LastOrderDate
        FROM naive_c c LEFT JOIN naive_o o ON c.CustomerID = o.CustomerID
        LEFT JOIN naive_l l ON o.OrderID = l.OrderID GROUP BY c.CustomerID, c.CustomerName"""
    )


def test_summary_with_broken_keys(spark):
    """NULL and repeated ids everywhere give what the plain outer joins give."""
    customers = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None), (None, "x"), (None, None), (3, "c")],
        "CustomerID int, CustomerName string",
    )
    orders = spark.createDataFrame(
        [
            (10, 1, date(2024, 1, 1)),
            (10, 1, date(2024, 1, 2)),
            (10, 2, None),
            (11, 2, date(2024, 1, 3)),
            (None, 1, date(2024, 2, 1)),
            (None, 3, None),
            (12, None, date(2024, 3, 1)),
            (13, 9, date(2024, 3, 1)),
        ],
        "OrderID int, CustomerID int, OrderDate date",
    )
    lines = spark.createDataFrame(
        [
            (10, 2, Decimal("1.50")),
            (10, None, Decimal("1.00")),
            (12, 5, Decimal("9.99")),
            (None, 1, Decimal("1.00")),
            (99, 1, Decimal("1.00")),
        ],
        "OrderID int, Quantity int, UnitPrice decimal(18,2)",
    )
    got = views.customer_order_summary(customers, orders, lines)
    assert spark_rows(got) == spark_rows(naive_summary(spark, customers, orders, lines))


def test_summary_with_hot_keys(spark):
    """A third of all lines on one order, of all orders on one customer."""
    customers = bronze_input(spark, SF_DIR, "customers")
    orders = bronze_input(spark, SF_DIR, "orders").selectExpr(
        "OrderID",
        "CASE WHEN OrderID % 3 = 0 THEN 7 ELSE CustomerID END AS CustomerID",
        "OrderDate",
    )
    lines = bronze_input(spark, SF_DIR, "order_lines").selectExpr(
        "CASE WHEN OrderLineID % 3 = 0 THEN 9 ELSE OrderID END AS OrderID", "Quantity", "UnitPrice"
    )
    got = views.customer_order_summary(customers, orders, lines)
    assert spark_rows(got) == spark_rows(naive_summary(spark, customers, orders, lines))


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None), (4, 5)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "pk int")
    orphans = quality.orphan_rows(child, parent, "fk", "pk")
    assert orphans.columns == ["id", "fk"]
    assert sorted(r.id for r in orphans.collect()) == [2, 4]


@pytest.mark.parametrize("name", ["orders", "order_lines", "stock_items"])
def test_nulls_and_non_nulls_add_up(spark, name):
    df = bronze_input(spark, SF_DIR, name)
    total = df.count()
    complete = profile.column_completeness(df).collect()
    nulls = {
        r.column: r.n for r in quality.null_violations(df, name, df.columns).collect()
    }
    assert all(r.non_null + nulls[r.column] == total for r in complete)


def test_price_signs_and_nulls_add_up(spark):
    items = bronze_input(spark, SF_DIR, "stock_items")
    row = quality.count_where(
        items, {"pos": "UnitPrice > 0", "non_pos": "UnitPrice <= 0", "null": "UnitPrice IS NULL"}
    ).first()
    assert row.pos + row.non_pos + row["null"] == items.count()


def test_rules_partition_the_rows(spark):
    lines = bronze_input(spark, SF_DIR, "order_lines")
    rules = {"a": "Quantity > 0", "b": "StockItemID > 100 AND Quantity > 10"}
    for r in profile.business_rules(lines, rules).collect():
        assert r.passed + r.failed + r.unknown == lines.count()


def test_top_k_is_part_of_the_whole(spark):
    groups = bronze_input(spark, SF_DIR, "stock_groups")
    junction = bronze_input(spark, SF_DIR, "stock_item_stock_groups")
    sizes = {tuple(r) for r in reports.category_sizes(groups, junction).collect()}
    top = {tuple(r) for r in reports.category_distribution(groups, junction).collect()}
    assert top <= sizes
    assert min(n for _, n in top) >= max(n for _, n in sizes - top)


def test_sample_and_top_k_are_ordered(spark):
    df = spark.createDataFrame([(3, "c"), (None, "n"), (1, "a"), (2, "b")], "k int, v string")
    assert [r.v for r in sample_rows(df, ["k"], 2).collect()] == ["n", "a"]
    assert [r.v for r in top_k(df, "k", 2, ["v"]).collect()] == ["c", "b"]


def test_type_conformance_counts_what_does_not_fit(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("99999999999",)], "a string")
    row = profile.type_conformance(df, {"a": "int"}).first()
    assert tuple(row) == ("a", "int", "string", False, 2)


def test_profile_sketch_is_close(spark):
    lines = bronze_input(spark, SF_DIR, "order_lines")
    exact = profile.column_profile(lines, ["StockItemID"], "exact").first()["distinct"]
    approx = profile.column_profile(lines, ["StockItemID"]).first()["distinct"]
    assert abs(exact - approx) <= 0.1 * exact


def test_silver_keeps_the_current_typed_row(spark):
    rows = [
        {"StockGroupID": 1, "StockGroupName": " old ", "ValidFrom": date_time(1)},
        {"StockGroupID": 1, "StockGroupName": " new ", "ValidFrom": date_time(2)},
        {"StockGroupID": 2, "StockGroupName": "  ", "ValidFrom": date_time(1)},
        {"StockGroupID": None, "StockGroupName": "lost", "ValidFrom": date_time(1)},
        {
            "StockGroupID": 3,
            "StockGroupName": "ended",
            "ValidFrom": date_time(1),
            "ValidTo": date_time(2),
        },
    ]
    df = layers.silver(seed.table(spark, "stock_groups", rows), SPECS["stock_groups"])
    assert {(r.StockGroupID, r.StockGroupName) for r in df.collect()} == {(1, "new"), (2, None)}


def date_time(day):
    from datetime import datetime

    return datetime(2024, 1, day)
