"""Every registered query: ``(spark, folder of parquet tables) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.config import PipelineConfig, RunContext, Target
from bronzeflow.operators import incremental, profile, profile_store, quality, quarantine
from bronzeflow.operators.lineage import add_lineage, lineage_columns, project
from bronzeflow.operators.listing import sample_rows, table_inventory
from bronzeflow.operators.sinks import (
    append_if_empty,
    ensure_namespace,
    verify_load,
    write_bronze,
)
from bronzeflow.plans import gold, layers, reports, views
from bronzeflow.plans.job import load_increment, load_table, run_bronze
from bronzeflow.session import job_session, scratch_path
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.sources.fixtures import (
    FixtureSource,
    OrderEdits,
    StoppingSource,
    bronze_input,
    read_fixture,
    sales_change,
    versioned_input,
)
from bronzeflow.specs import CUSTOMERS, ORDER_LINES, ORDERS, SPECS
from bronzeflow.streaming.append import append_stream, read_files
from bronzeflow.streaming.upsert import applied_batches, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

# Pinned, so that both sides of a comparison see the same run.
RUN = RunContext(datetime(2024, 1, 20, 2, 0, 0, tzinfo=timezone.utc), "sales_source")
YEARLY_ORDERS = replace(
    ORDERS, ddl=f"{ORDERS.ddl.rstrip()}\n        OrderYear int", partition_by=("OrderYear",)
)

# Orders in parts that some edits change, for the gold table.
SALES_ORDERS = replace(
    ORDERS, ddl=f"{ORDERS.ddl.rstrip()}\n        OrderPart int", partition_by=("OrderPart",)
)

ROW_COUNT_TABLES = ("customers", "suppliers", "stock_items", "orders", "order_lines")
STOCK_COUNT_TABLES = (
    "stock_items",
    "stock_item_holdings",
    "stock_groups",
    "stock_item_stock_groups",
)
NOT_NULL_TABLES = ("customers", "orders", "order_lines", "stock_items")
EXPECTED_TYPES = {
    "StockItemID": "bigint",
    "StockItemName": "string",
    "Brand": "int",
    "Size": "int",
    "UnitPrice": "decimal(18,2)",
    "IsChillerStock": "boolean",
    "Barcode": "string",
}
LINE_RULES = {
    "has_stock_item": "StockItemID IS NOT NULL",
    "positive_quantity": "Quantity > 0",
    "known_item_sold": "StockItemID > 0 AND Quantity > 0",
    "price_at_least_quantity": "UnitPrice >= Quantity",
}
PROFILED = ("StockItemID", "StockItemName", "Brand", "Size", "UnitPrice", "IsChillerStock")


def fresh_target(spark: SparkSession, **options: bool) -> Target:
    """A schema of its own in the shared folder, for queries that write."""
    run = uuid.uuid4().hex
    target = Target(f"bronze_{run}", location=scratch_path(spark, "bronze"), **options)
    ensure_namespace(spark, target)
    return target


def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A query of one bronze-shaped table."""
    return lambda spark, sf: operator(bronze_input(spark, sf, name))


def projection(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df = bronze_input(spark, sf, name)
        extra = [c for c in df.columns if c not in SPECS[name].columns]
        return df.select(*project(df, SPECS[name], strict=False).columns, *extra)

    return query


def lineage(name: str, key: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        spec = SPECS[name]
        df = add_lineage(bronze_input(spark, sf, name), spec, RUN)
        return df.select(key, *lineage_columns(spec))

    return query


def bronze_roundtrip_orders(spark: SparkSession, sf: str) -> DataFrame:
    target = fresh_target(spark)
    orders = bronze_input(job_session(spark), sf, "orders")
    write_bronze(add_lineage(orders, ORDERS, RUN), target, ORDERS)
    return read_bronze(spark, target, "orders").select(
        "OrderID", "CustomerID", "OrderDate", *lineage_columns(ORDERS)
    )


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A second load without OrderDate, with a new column, and one name in other case."""
    target, plain = fresh_target(spark), ORDERS.with_layout()
    write_bronze(bronze_input(spark, sf, "orders"), target, plain)
    new = read_fixture(spark, sf, "orders").selectExpr(
        "o_orderkey AS OrderID", "o_custkey AS customerid", "o_orderpriority AS Priority"
    )
    write_bronze(new, target, plain)
    return read_bronze(spark, target, "orders")


def load_and_verify(spark: SparkSession, sf: str) -> DataFrame:
    target = fresh_target(spark)
    lines = add_lineage(bronze_input(spark, sf, "order_lines"), ORDER_LINES, RUN)
    observed = write_bronze(lines, target, ORDER_LINES, quality.load_metrics("order_lines"))
    return verify_load(spark, target, "order_lines", observed["total"])


def seed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Seed customers twice; the second time must add nothing."""
    target = fresh_target(spark)
    customers = bronze_input(spark, sf, "customers")
    append_if_empty(customers, target, CUSTOMERS)
    written = read_bronze(spark, target, "customers").count()
    append_if_empty(customers, target, CUSTOMERS)
    return verify_load(spark, target, "customers", written)


def seed_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Seed orders by year: an absent table twice, then the emptied one twice."""
    target, orders = fresh_target(spark), incremental_rows(spark, sf, 0, "true")
    for _ in range(2):
        append_if_empty(orders, target, YEARLY_ORDERS)
    write_bronze(orders.where("false"), target, YEARLY_ORDERS)
    for _ in range(2):
        append_if_empty(orders, target, YEARLY_ORDERS)
    return read_bronze(spark, target, "orders").select("OrderID", "TotalPrice", "OrderYear")


def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Orders up to a mark, then two loads of what the source offers since.

    Among that are rows at the mark, without a time, edited later, edited before
    the mark (not offered), and some that move to another partition.
    """
    target = fresh_target(spark)
    load_table(spark, OrderEdits(sf, False), target, YEARLY_ORDERS, RUN, strict=False)
    for _ in range(2):
        load_increment(spark, OrderEdits(sf, True), target, YEARLY_ORDERS, RUN, strict=False)
    return read_bronze(spark, target, "orders").select(
        "OrderID", "CustomerID", "LastEditedWhen", "OrderYear"
    )


def bronze_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job; every metric observed while a table was written, and its rows read back."""
    cfg = PipelineConfig(
        schema_name=f"bronze_{uuid.uuid4().hex}", location=scratch_path(spark, "run")
    )
    result = run_bronze(spark, cfg, FixtureSource(sf), RUN, strict=False)
    if result.failed_reports:
        raise RuntimeError(f"reports failed: {result.failed_reports}")
    rows = [
        (table, metric, float(value))
        for table, metrics in result.metrics.items()
        for metric, value in metrics.items()
        if value is not None
    ]
    return spark.createDataFrame(rows, "table string, metric string, value double")


def shown(value: object) -> str | None:
    if value is None or isinstance(value, (int, str)):
        return None if value is None else str(value)
    return f"{float(value):.4f}"


#: Column that names the rows of a report; rows without one are numbered.
REPORT_ROWS = {
    "orders": "metric",
    "stock_counts": "TableName",
    "category_distribution": "StockGroupName",
}


def bronze_run_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Every figure of every report of the whole job."""
    cfg = PipelineConfig(
        schema_name=f"bronze_{uuid.uuid4().hex}", location=scratch_path(spark, "run")
    )
    result = run_bronze(spark, cfg, FixtureSource(sf), RUN, strict=False)
    if result.failed_reports:
        raise RuntimeError(f"reports failed: {result.failed_reports}")
    rows = [
        (report, row[REPORT_ROWS[report]] if report in REPORT_ROWS else str(n), metric, shown(value))
        for report, found in result.reports.items()
        for n, row in enumerate(found, 1)
        for metric, value in row.asDict().items()
        if metric not in (REPORT_ROWS.get(report), *lineage_columns(CUSTOMERS))
    ]
    return spark.createDataFrame(rows, "report string, row string, metric string, value string")


def bronze_run_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job, stopped at its second table and taken up again: metrics, and reads of the source."""
    cfg = PipelineConfig(
        schema_name=f"bronze_{uuid.uuid4().hex}", location=scratch_path(spark, "run")
    )
    source = StoppingSource(sf, "orders")
    try:
        run_bronze(spark, cfg, source, RUN, strict=False, run_id="daily")
    except ConnectionError:
        result = run_bronze(spark, cfg, source, RUN, strict=False, run_id="daily")
    rows = [
        (table, metric, float(value))
        for table, metrics in result.metrics.items()
        for metric, value in (metrics | {"source_reads": source.reads[table]}).items()
        if value is not None
    ]
    return spark.createDataFrame(rows, "table string, metric string, value double")


def overwrite_by_pointer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year, then in their place all of them a year later, with a column more."""
    target = fresh_target(spark, catalog_partitions=False)
    write_bronze(incremental_rows(spark, sf, 0, "true"), target, YEARLY_ORDERS)
    later = incremental_rows(spark, sf, 1, "OrderID % 3 <> 0").withColumn("Kind", F.lit("later"))
    write_bronze(later, target, YEARLY_ORDERS)
    return read_bronze(spark, target, "orders")


def gold_daily_sales_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales after two increments of orders, the second one with lines."""
    target = fresh_target(spark)
    write_bronze(sales_change(spark, sf, "orders_0"), target, SALES_ORDERS)
    write_bronze(sales_change(spark, sf, "lines_0"), target, ORDER_LINES)
    gold.build_daily_sales(spark, target, SALES_ORDERS)
    gold.refresh_daily_sales(
        spark, target, sales_change(spark, sf, "orders_1"), orders=SALES_ORDERS
    )
    gold.refresh_daily_sales(
        spark,
        target,
        sales_change(spark, sf, "orders_2"),
        sales_change(spark, sf, "lines_2"),
        SALES_ORDERS,
    )
    return read_bronze(spark, target, "daily_sales").drop("SalesYear")


#: More files than a folder has.
ALL_FILES = 2**31 - 1


def stream_upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Two looks at orders as files of a stream; its second batch fails once when it is in the table."""
    target, landing = fresh_target(spark), scratch_path(spark, "landing")
    checkpoint, failures = scratch_path(spark, "stream"), []

    def fail_once(_: SparkSession, batch_id: int) -> None:
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise ConnectionError("stopped")

    for second in (False, True):
        look = OrderEdits(sf, second).read(spark, YEARLY_ORDERS)
        look.write.mode("append").parquet(landing)
        for attempt in range(2):
            # All files of a look are one batch; one that is counted is not offered again.
            rows = read_files(spark, landing, look.schema, files_per_batch=ALL_FILES)
            query = upsert_stream(rows, target, YEARLY_ORDERS, checkpoint, then=fail_once)
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                if attempt or not failures:
                    raise
    counted = applied_batches(spark, target, YEARLY_ORDERS).agg(F.sum("rows").alias("streamed_rows"))
    streamed = counted.first()[0]
    spark.catalog.refreshTable(target.name("orders"))
    return read_bronze(spark, target, "orders").select(
        "OrderID",
        "CustomerID",
        "LastEditedWhen",
        "OrderYear",
        F.lit(streamed).cast("bigint").alias("streamed_rows"),
    )


#: Share by which the sketch of a column may miss its distinct values: four standard errors.
SKETCH_ERROR = 0.065


def profile_of_growing_table(spark: SparkSession, sf: str) -> DataFrame:
    """Profile of orders by year, kept up to date over two loads of different years."""
    target = fresh_target(spark)
    first = incremental_rows(spark, sf, 0, "LastEditedWhen < TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    write_bronze(first, target, YEARLY_ORDERS)
    profile_store.refresh_profile(spark, target, YEARLY_ORDERS)
    later = incremental_rows(spark, sf, 0, "LastEditedWhen >= TIMESTAMP_NTZ '1998-07-01 00:00:00'")
    incremental.upsert_table(spark, target, YEARLY_ORDERS, later, "TotalPrice")
    read = profile_store.refresh_profile(spark, target, YEARLY_ORDERS)
    # Tasks that fold all distinct values stay as many as the shuffle has, not one per core.
    spread = job_session(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    orders, counted = read_bronze(spread, target, "orders"), scratch_path(spark, "exact")
    exact = profile.column_profile(orders, ["OrderID", "TotalPrice"], distinct="exact")
    exact.select("column", F.col("distinct").alias("exact")).write.parquet(counted)
    found = profile_store.stored_profile(spark, target, YEARLY_ORDERS)
    near = F.abs(F.col("distinct") - F.col("exact")) <= SKETCH_ERROR * F.col("exact")
    return found.join(spark.read.parquet(counted), "column").select(
        "column",
        "rows",
        "nulls",
        "min",
        "max",
        "mean",
        "stddev",
        near.alias("distinct_is_near"),
        F.lit(read).cast("bigint").alias("partitions_read"),
    )


def quarantined_order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that meet all rules, and those that do not with the rules they break."""
    target = fresh_target(spark)
    lines = bronze_input(spark, sf, "order_lines")
    quarantine.write_checked(lines, target, ORDER_LINES, LINE_RULES)
    good = quarantine.passing(spark, target, ORDER_LINES).withColumn("broken", F.lit(""))
    bad = quarantine.quarantined(spark, target, ORDER_LINES)
    bad = bad.withColumn("broken", F.array_join(quarantine.BROKEN, ",")).drop(quarantine.BROKEN)
    return good.unionByName(bad)


def orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, every tenth customer id made dangling, against all customers."""
    dangling = bronze_input(spark, sf, "orders").withColumn(
        "CustomerID", F.expr("CASE WHEN CustomerID % 10 = 0 THEN -1 - CustomerID ELSE CustomerID END")
    )
    return quality.orphan_rows(
        dangling, bronze_input(spark, sf, "customers"), "CustomerID", "CustomerID"
    ).select("OrderID")


def orphan_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines, every tenth order id made dangling, against all orders."""
    dangling = bronze_input(spark, sf, "order_lines").withColumn(
        "OrderID", F.expr("CASE WHEN OrderID % 10 = 0 THEN -1 - OrderID ELSE OrderID END")
    )
    return (
        quality.orphan_rows(dangling, bronze_input(spark, sf, "orders"), "OrderID", "OrderID")
        .select("OrderLineID")
        .distinct()
    )


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return views.customer_order_summary(
        *[bronze_input(spark, sf, t) for t in ("customers", "orders", "order_lines")]
    )


BUCKETS = 16


def summary_of_bucketed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The order summary over orders and lines in buckets of the order id."""
    target = fresh_target(spark)
    for spec in (ORDERS, ORDER_LINES):
        rows = bronze_input(spark, sf, spec.name)
        write_bronze(rows, target, spec.bucketed(BUCKETS, "OrderID"))
    tables = [read_bronze(spark, target, t) for t in ("orders", "order_lines")]
    return views.customer_order_summary(bronze_input(spark, sf, "customers"), *tables)


def groups_and_junction(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return (
        bronze_input(spark, sf, "stock_groups"),
        bronze_input(spark, sf, "stock_item_stock_groups"),
    )


def inventory(*names: str) -> Query:
    return lambda spark, sf: table_inventory({n: bronze_input(spark, sf, n) for n in names})


def priced_orders(spark: SparkSession, sf: str, markup: str = "0") -> DataFrame:
    return read_fixture(spark, sf, "orders").selectExpr(
        "o_orderkey AS OrderID",
        f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) + {markup} AS DECIMAL(18,2)) AS TotalPrice",
        "o_orderdate AS LastEditedWhen",
    )


def incremental_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Orders before 2000, upserted with those from mid-1999 on at a new price."""
    base = (
        priced_orders(spark, sf)
        .where("LastEditedWhen < TIMESTAMP_NTZ '2000-01-01 00:00:00'")
        .withColumn("version", F.lit("base"))
    )
    incoming = (
        priced_orders(spark, sf, "1")
        .where("LastEditedWhen >= TIMESTAMP_NTZ '1999-07-01 00:00:00'")
        .withColumn("version", F.lit("incoming"))
    )
    return incremental.upsert(base, incoming, ["OrderID"], "LastEditedWhen").select(
        "OrderID", "TotalPrice", "version"
    )


def upsert_partitioned_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same orders by year of order, upserted in a partitioned table.

    Incoming rows move to the next year, so that keys change their partition.
    """
    target = fresh_target(spark)
    base = incremental_rows(spark, sf, 0, "LastEditedWhen < TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    write_bronze(base, target, YEARLY_ORDERS)
    incoming = incremental_rows(
        spark, sf, 1, "LastEditedWhen >= TIMESTAMP_NTZ '1999-07-01 00:00:00'"
    )
    incremental.upsert_table(spark, target, YEARLY_ORDERS, incoming, "TotalPrice")
    return read_bronze(spark, target, "orders").select("OrderID", "TotalPrice", "OrderYear")


def incremental_rows(spark: SparkSession, sf: str, shift: int, where: str) -> DataFrame:
    return (
        priced_orders(spark, sf, str(shift))
        .where(where)
        .selectExpr("OrderID", "TotalPrice", f"year(LastEditedWhen) + {shift} AS OrderYear")
    )


def silver(name: str) -> Query:
    (key,) = SPECS[name].primary_key
    return lambda spark, sf: layers.silver(versioned_input(spark, sf, name, key), SPECS[name])


def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    target = fresh_target(spark)
    schema = read_fixture(spark, sf, "events").schema
    rows = read_files(spark, sf, schema, "events.parquet")
    append_stream(
        rows, target, "events", "events", RUN, scratch_path(spark, "stream")
    ).awaitTermination()
    return read_bronze(spark, target, "events")


QUERIES: dict[str, Query] = {
    **{f"project_{name}": projection(name) for name in SPECS},
    "lineage_standard": lineage("orders", "OrderID"),
    "lineage_customers": lineage("customers", "CustomerID"),
    "bronze_roundtrip_orders": bronze_roundtrip_orders,
    "schema_evolution": schema_evolution,
    "verify_load": load_and_verify,
    "append_if_empty": seed_twice,
    "append_if_empty_orders": seed_partitioned,
    "incremental_load": incremental_load,
    "bronze_run": bronze_run,
    "bronze_run_reports": bronze_run_reports,
    "bronze_run_resumed": bronze_run_resumed,
    "overwrite_by_pointer": overwrite_by_pointer,
    "dup_customer_ids": over(
        "customers", lambda df: quality.duplicate_keys(df, CUSTOMERS.primary_key)
    ),
    "duplicate_order_lines": over(
        "order_lines", lambda df: quality.duplicate_keys(df, ORDER_LINES.primary_key)
    ),
    "dq_customers": over("customers", quality.dq_customers),
    "dq_orders": over("orders", quality.dq_orders),
    "dq_order_lines": over("order_lines", quality.dq_order_lines),
    "check_report_stock_items": over(
        "stock_items", lambda df: quality.check_report(df, "stock_items")
    ),
    "orders_quality": over("orders", reports.orders_quality),
    "lines_quality": over("order_lines", reports.lines_quality),
    "orders_quality_report": lambda spark, sf: reports.orders_quality_report(
        bronze_input(spark, sf, "orders"), bronze_input(spark, sf, "order_lines")
    ),
    "stock_report": lambda spark, sf: reports.stock_report(
        bronze_input(spark, sf, "stock_items"), bronze_input(spark, sf, "stock_item_holdings")
    ),
    "lines_stats": over("order_lines", quality.stats_order_lines),
    "dq_stock_items": over("stock_items", quality.dq_stock_items),
    "stats_stock_items": over("stock_items", quality.stats_stock_items),
    "price_statistics": over("stock_items", reports.price_statistics),
    "inventory_statistics": over("stock_item_holdings", reports.inventory_statistics),
    "dq_holdings": over("stock_item_holdings", quality.dq_holdings),
    "stock_completeness": over("stock_items", reports.stock_completeness),
    "category_distribution": lambda spark, sf: reports.category_distribution(
        *groups_and_junction(spark, sf)
    ),
    "group_names": over("stock_groups", quality.group_names),
    "item_group_stats": over("stock_item_stock_groups", quality.stats_item_groups),
    "distinct_with_null": over(
        "order_lines", lambda df: df.agg(quality.distinct_with_null("StockItemID").alias("n"))
    ),
    "distinct_non_null": over(
        "order_lines", lambda df: df.agg(quality.distinct_non_null("StockItemID").alias("n"))
    ),
    "customer_order_summary": summary,
    "customer_order_summary_sorted": lambda spark, sf: views.summary_by_value(summary(spark, sf)),
    "summary_of_bucketed_tables": summary_of_bucketed_tables,
    "table_inventory": inventory(*ROW_COUNT_TABLES),
    "stock_table_inventory": inventory(*STOCK_COUNT_TABLES),
    "orphan_orders": orphan_orders,
    "orphan_lines": orphan_lines,
    "sample_rows": over("customers", lambda df: sample_rows(df, ["CustomerID", "CustomerName"])),
    "null_violations": lambda spark, sf: quality.declared_null_violations(
        {t: bronze_input(spark, sf, t) for t in NOT_NULL_TABLES}
    ),
    "type_conformance": over(
        "stock_items", lambda df: profile.type_conformance(df, EXPECTED_TYPES)
    ),
    "business_rules": over("order_lines", lambda df: profile.business_rules(df, LINE_RULES)),
    "column_profile": over(
        "stock_items", lambda df: profile.column_profile(df, PROFILED, distinct="exact")
    ),
    "column_completeness": over("stock_items", profile.column_completeness),
    "incremental_upsert": incremental_upsert,
    "upsert_partitioned_table": upsert_partitioned_table,
    "silver_customers": silver("customers"),
    "silver_orders": silver("orders"),
    "silver_stock_items": silver("stock_items"),
    "gold_daily_sales": lambda spark, sf: layers.daily_sales(
        bronze_input(spark, sf, "orders"), bronze_input(spark, sf, "order_lines")
    ),
    "gold_category_revenue": lambda spark, sf: layers.category_revenue(
        bronze_input(spark, sf, "order_lines"), *groups_and_junction(spark, sf)
    ),
    "gold_daily_sales_incremental": gold_daily_sales_incremental,
    "profile_of_growing_table": profile_of_growing_table,
    "quarantined_order_lines": quarantined_order_lines,
    "stream_events": stream_events,
    "stream_upsert_orders": stream_upsert_orders,
}
