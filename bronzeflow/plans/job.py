"""The whole bronze run."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from bronzeflow.config import PipelineConfig, RunContext, Target
from bronzeflow.operators import quality
from bronzeflow.operators.incremental import high_water_mark, newer_than, upsert_table
from bronzeflow.operators.lineage import add_lineage, project
from bronzeflow.operators.listing import sample_rows, table_inventory
from bronzeflow.operators.sinks import (
    ensure_namespace,
    restore_previous,
    verify_load,
    write_bronze,
)
from bronzeflow.plans import reports
from bronzeflow.plans.ledger import Ledger
from bronzeflow.session import job_session
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.sources.jdbc import JdbcSource
from bronzeflow.specs import CUSTOMERS, SPECS, TableSpec, spark_type

log = logging.getLogger(__name__)

SALES_TABLES = ("orders", "order_lines")
STOCK_TABLES = (
    "stock_items",
    "stock_item_holdings",
    "stock_groups",
    "stock_item_stock_groups",
)


class Source(Protocol):
    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame: ...


@dataclass
class BronzeRun:
    """Metrics of each load, and the small result tables of each report."""

    metrics: dict[str, dict[str, Any]] = field(default_factory=dict)
    reports: dict[str, list[Row]] = field(default_factory=dict)
    failed_reports: dict[str, str] = field(default_factory=dict)


def load_table(
    spark: SparkSession,
    source: Source,
    target: Target,
    spec: TableSpec,
    run: RunContext,
    strict: bool = True,
    staged: bool = True,
) -> dict[str, Any]:
    """Read a source table once, write it to bronze, return what was measured."""
    restore_previous(spark, target, spec.name)
    rows = project(without_missing_options(source.read(spark, spec), spec), spec, strict)
    metrics = write_bronze(
        add_lineage(rows, spec, run),
        target,
        spec,
        quality.load_metrics(spec.name),
        staged=staged,
    )
    for rule in quality.RULES[spec.name]:
        if metrics[rule.metric]:
            level = logging.WARNING if rule.severity == "warning" else logging.INFO
            log.log(level, "%s: %s = %d", spec.name, rule.metric, metrics[rule.metric])
    return metrics


def load_increment(
    spark: SparkSession,
    source: Source,
    target: Target,
    spec: TableSpec,
    run: RunContext,
    strict: bool = True,
) -> None:
    """Bring over rows edited since the last load and upsert them by key.

    The mark is one value, put into a plain comparison: a relational source
    evaluates it itself, a partitioned file source prunes by it.
    """
    mark = high_water_mark(read_bronze(spark, target, spec.name), spec.edited_column)
    # A source that can, puts the mark into its own query and splits what is left.
    read = getattr(source, "read_since", None)
    offered = read(spark, spec, mark) if read else source.read(spark, spec)
    edited = newer_than(
        without_missing_options(offered, spec), spec.edited_column, mark
    )
    rows = add_lineage(project(edited, spec, strict), spec, run)
    upsert_table(spark, target, spec, rows, spec.edited_column)


def without_missing_options(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Optional columns that the source lacks come in as NULL."""
    missing = [c for c in spec.optional if c not in df.columns]
    types = dict(spec.fields)
    return df.withColumns({c: F.lit(None).cast(spark_type(types[c])) for c in missing})


def run_reports(
    spark: SparkSession, target: Target, result: BronzeRun, sample_size: int = 5
) -> None:
    """Fill in the reports over bronze. One that fails is logged, not raised.

    The report of group names is their number; the names themselves, as many as
    there are, are ``quality.group_names`` of the bronze table. ``sample_size``
    is the number of customers that the sample shows.
    """

    def table(name: str) -> DataFrame:
        return read_bronze(spark, target, name)

    plans = {
        "customers_sample": lambda: sample_rows(
            table("customers"), [*CUSTOMERS.primary_key, "CustomerName"], sample_size
        ),
        "customers": lambda: quality.dq_customers(table("customers")),
        "orders": lambda: reports.orders_quality_report(table("orders"), table("order_lines")),
        "stock_counts": lambda: table_inventory({t: table(t) for t in STOCK_TABLES}),
        "price_statistics": lambda: reports.price_statistics(table("stock_items")),
        "inventory_statistics": lambda: reports.inventory_statistics(
            table("stock_item_holdings")
        ),
        "category_distribution": lambda: reports.category_distribution(
            table("stock_groups"), table("stock_item_stock_groups")
        ),
        "group_names": lambda: quality.group_names(table("stock_groups")).agg(
            F.count(F.lit(1)).alias("names")
        ),
        "item_groups": lambda: quality.stats_item_groups(table("stock_item_stock_groups")),
        "stock_completeness": lambda: reports.stock_completeness(table("stock_items")),
    }
    for name, plan in plans.items():
        try:
            # Each report has a bounded number of rows, whatever the tables hold.
            result.reports[name] = plan().collect()
        except Exception as error:
            log.exception("report %s failed", name)
            result.failed_reports[name] = str(error)


def run_bronze(
    spark: SparkSession,
    cfg: PipelineConfig,
    source: Source | None = None,
    run: RunContext | None = None,
    strict: bool = True,
    run_id: str | None = None,
) -> BronzeRun:
    """Customers first; then orders with their lines beside the stock tables.

    An extraction that fails ends the run. Reports come last and do not.

    With a ``run_id`` the run keeps a ledger of the tables it has loaded. Called
    again with the same id after it stopped, it passes over these tables, returns
    their metrics as they were, and loads the others. A table is in the ledger
    once it was written and read back.
    """
    caller = spark
    spark = job_session(
        spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{cfg.file_mb}MB"}
    )
    source = source or JdbcSource.from_config(cfg)
    run = run or RunContext.now(cfg.source_system)
    target, result = cfg.target, BronzeRun()
    ensure_namespace(spark, target)
    ledger = Ledger(spark, target, run_id) if run_id else None
    done = ledger.done() if ledger else {}

    def load(*names: str) -> None:
        for name in names:
            if name in done:
                result.metrics[name] = done[name]
                continue
            metrics = load_table(
                spark, source, target, SPECS[name], run, strict, cfg.staged_writes
            )
            check = verify_load(spark, target, name, metrics["total"]).first()
            if not check["ok"]:
                log.warning("%s: wrote %s rows, read %s", name, *check[1:3])
            # The caller's session may have listed the files of the last run.
            caller.catalog.refreshTable(target.name(name))
            result.metrics[name] = metrics | {"read_back": check["read_back"]}
            if ledger:
                ledger.record(name, result.metrics[name])

    load("customers")
    with ThreadPoolExecutor(max_workers=2) as pool:
        branches = [
            pool.submit(inheritable_thread_target(spark)(load), *names)
            for names in (SALES_TABLES, STOCK_TABLES)
        ]
    for branch in branches:
        branch.result()
    run_reports(spark, target, result, cfg.sample_size)
    return result
