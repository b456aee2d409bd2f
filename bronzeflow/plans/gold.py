"""Daily sales kept up to date by what an increment changes.

An extension: planned as a next step only, so the semantics are our own.

What the touched orders contributed before an increment is taken off the stored
sums, and what they contribute after it is added: nothing else of the bronze
tables is read, and of the gold table only the years that change.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.config import Target
from bronzeflow.operators.incremental import (
    any_of,
    drop_partitions,
    key_session,
    of_keys,
    overwrite_partitions,
    renamed_keys,
    same_key,
    upsert_table,
)
from bronzeflow.operators.sinks import save, write_bronze
from bronzeflow.plans.layers import daily_sales, sales_by_date, sales_per_order
from bronzeflow.specs import ORDER_LINES, ORDERS, TableSpec

DAILY_SALES = TableSpec(
    name="daily_sales",
    source_table="",
    ddl="""
        OrderDate date
        orders bigint
        lines bigint
        revenue decimal(38,2)
        SalesYear int
    """,
    primary_key=("OrderDate",),
    not_null=("OrderDate",),
    batch_prefix="daily_sales",
    partition_by=("SalesYear",),
)
MEASURES = ("orders", "lines", "revenue")
#: What a refresh keeps until its result is in place; the old contributions go last.
SIDE_TABLES = ("full", "change", "keys", "before")


def by_year(sales: DataFrame) -> DataFrame:
    return sales.select("OrderDate", *MEASURES, F.year("OrderDate").alias("SalesYear"))


def build_daily_sales(
    spark: SparkSession, target: Target, orders: TableSpec = ORDERS, lines: TableSpec = ORDER_LINES
) -> None:
    """The gold table from all of bronze: the first time, or to start anew."""
    for what in ("result", *SIDE_TABLES):
        for table in pending(spark, target, what):
            spark.sql(f"DROP TABLE IF EXISTS {target.name(table)}")
    tables = [spark.table(target.name(spec.name)) for spec in (orders, lines)]
    write_bronze(by_year(daily_sales(*tables)), target, DAILY_SALES)


def refresh_daily_sales(
    spark: SparkSession,
    target: Target,
    new_orders: DataFrame | None = None,
    new_lines: DataFrame | None = None,
    orders: TableSpec = ORDERS,
    lines: TableSpec = ORDER_LINES,
) -> None:
    """Upsert increments of orders and lines into bronze, and bring daily sales up to date.

    Dates, orders and lines may change in any way: an order may move to another
    date or lose its date, a line may move to another order. A date without
    orders goes.

    A run that stops anywhere is mended by running the same increments again. The
    old contributions of the touched orders are kept in a table from before the
    upsert until the sums are in place, so they are taken off once; and what the
    changed years shall hold is written before it replaces them, so doing that
    again changes nothing.
    """
    caller, spark = spark, key_session(spark)
    put_in_place(spark, target)
    order_key, line_key = orders.primary_key[0], lines.primary_key
    order_rows, line_rows = (target.name(spec.name) for spec in (orders, lines))

    keys = []
    if new_orders is not None:
        keys.append(new_orders.select(order_key))
    if new_lines is not None:
        keys.append(new_lines.select(order_key))
        old = of_rows(spark.table(line_rows), new_lines, line_key)
        keys.append(old.select(order_key))
    if not keys:
        return
    held = [spark.table(target.name(t)) for t in pending(spark, target, "before")]
    touched = reduce(DataFrame.union, keys).distinct()
    if held:  # a run stopped after its upsert may have begun: these contributions are old enough
        known = renamed_keys(reduce(DataFrame.unionByName, held), [order_key])
        touched = touched.join(known, same_key(touched, known, [order_key]), "left_anti")
    touched = spark.table(keep(spark, target, "keys", touched))
    first = contributions(spark, order_rows, line_rows, touched, order_key)
    held.append(spark.table(keep(spark, target, "before", first)))
    before = reduce(DataFrame.unionByName, held)

    for spec, rows in ((orders, new_orders), (lines, new_lines)):
        if rows is not None:
            upsert_table(spark, target, spec, rows, spec.edited_column)

    every_key = spark.table(keep(spark, target, "keys", before.select(order_key).distinct()))
    after = contributions(spark, order_rows, line_rows, every_key, order_key)
    signed = after.unionByName(before.withColumns({m: -F.col(m) for m in MEASURES}))
    change = by_year(sales_by_date(signed.where(F.col("OrderDate").isNotNull())))
    change = spark.table(keep(spark, target, "change", change))
    # As many rows as years are touched.
    years = change.select("SalesYear").distinct().collect()
    stored = spark.table(target.name(DAILY_SALES.name)).where(any_of(years, ["SalesYear"]))
    sums = by_year(sales_by_date(stored.select(*change.columns).unionByName(change)))
    keep(spark, target, "result", sums)
    put_in_place(spark, target)
    for table in (order_rows, line_rows, target.name(DAILY_SALES.name)):
        caller.catalog.refreshTable(table)


def of_rows(
    table: DataFrame, rows: DataFrame, keys: Sequence[str], listed: Column | None = None
) -> DataFrame:
    """Rows of ``table`` with a key of ``rows``; row groups without one are skipped.

    ``listed`` is the test of ``of_keys`` where it is known.
    """
    found = table.where(of_keys(rows, keys) if listed is None else listed)
    own = renamed_keys(rows, keys)
    return found.join(own, same_key(found, own, keys), "left_semi")


def contributions(
    spark: SparkSession, orders: str, lines: str, keys: DataFrame, key: str
) -> DataFrame:
    """``(OrderID, OrderDate, orders, lines, revenue)`` of these orders; keys without any stay."""
    listed = of_keys(keys, [key])
    sales = sales_per_order(
        *[of_rows(spark.table(name), keys, [key], listed) for name in (orders, lines)]
    )
    known = renamed_keys(keys, [key])
    return known.join(sales, same_key(sales, known, [key]), "left").select(
        F.col(f"__{key}").alias(key), "OrderDate", *MEASURES
    )


def pending(spark: SparkSession, target: Target, what: str) -> list[str]:
    rows = spark.sql(
        f"SHOW TABLES IN {target.namespace} LIKE '{DAILY_SALES.name}__{what}_*'"
    ).collect()
    return [r.tableName for r in rows]


def keep(spark: SparkSession, target: Target, what: str, rows: DataFrame) -> str:
    """A table that is there only when all of its rows are."""
    name = target.name(f"{DAILY_SALES.name}__{what}_{uuid.uuid4().hex}")
    save(rows, target, name)
    return name


def put_in_place(spark: SparkSession, target: Target) -> None:
    """Let the years of a written result replace those of the gold table, then clean up."""
    name, year = target.name(DAILY_SALES.name), DAILY_SALES.partition_by
    for result in pending(spark, target, "result"):
        rows = spark.table(target.name(result))
        years = rows.select(*year).distinct().collect()
        full = keep(spark, target, "full", rows.where("orders > 0"))
        overwrite_partitions(spark, full, name, DAILY_SALES)
        left = {r[0] for r in spark.table(full).select(*year).distinct().collect()}
        drop_partitions(spark, name, [r for r in years if r[0] not in left], year)
        # The result goes last: while it is there, contributions kept are done with.
        for what in SIDE_TABLES:
            for table in pending(spark, target, what):
                spark.sql(f"DROP TABLE IF EXISTS {target.name(table)}")
        spark.sql(f"DROP TABLE IF EXISTS {target.name(result)}")
