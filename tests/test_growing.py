"""What follows an increment: gold sums, stored profiles, streams, quarantine, resumed runs."""

import uuid
from dataclasses import replace
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from bronzeflow.config import PipelineConfig, RunContext
from bronzeflow.operators import profile, profile_store, quarantine
from bronzeflow.operators.incremental import upsert_table
from bronzeflow.operators.sinks import write_bronze
from bronzeflow.plans import gold, job, layers
from bronzeflow.plans.ledger import Ledger
from bronzeflow.session import scratch_path
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.specs import SPECS
from bronzeflow.streaming.append import read_files
from bronzeflow.streaming.upsert import applied_batches, upsert_stream
from tests import seed
from tests.compare import spark_rows, table_names

RUN = RunContext(datetime(2024, 1, 20, 2, 0, tzinfo=timezone.utc))
# Few partitions, since every one is a folder to be written.
ORDERS = SPECS["orders"].with_layout("CustomerID")
PLAIN = SPECS["orders"].with_layout()
LINES, GROUPS = SPECS["order_lines"], SPECS["stock_groups"]


def orders(spark, *rows):
    return seed.table(
        spark,
        "orders",
        [
            {"OrderID": i, "CustomerID": 1, "OrderDate": d, "LastEditedWhen": datetime(2024, 2, e)}
            for i, d, e in rows
        ],
    )


def lines(spark, *rows):
    return seed.table(
        spark,
        "order_lines",
        [
            {"OrderLineID": i, "OrderID": o, "Quantity": q, "UnitPrice": Decimal(2), "LastEditedWhen": datetime(2024, 2, e)}
            for i, o, q, e in rows
        ],
    )


@pytest.fixture
def sales(spark, target):
    first, second = date(2023, 12, 31), date(2024, 1, 1)
    write_bronze(orders(spark, (1, first, 1), (2, second, 1), (3, None, 1), (4, second, 1)), target, PLAIN)
    write_bronze(lines(spark, (1, 1, 1, 1), (2, 1, 2, 1), (3, 2, 4, 1), (4, 3, 8, 1), (5, 9, 16, 1)), target, LINES)
    gold.build_daily_sales(spark, target, PLAIN)
    return target


def same_as_anew(spark, target):
    tables = [read_bronze(spark, target, n) for n in ("orders", "order_lines")]
    wanted = spark_rows(layers.daily_sales(*tables))
    assert spark_rows(read_bronze(spark, target, "daily_sales").drop("SalesYear")) == wanted
    return wanted


#: Orders move to a date that is new, lose the only one of a year, get one; lines move.
CHANGES = [
    (
        lambda spark: orders(spark, (1, date(2025, 5, 5), 2), (3, date(2024, 1, 1), 2), (7, date(2024, 1, 2), 2)),
        lambda spark: None,
    ),
    (
        lambda spark: orders(spark, (2, None, 3)),
        lambda spark: lines(spark, (3, 1, 5, 3), (6, 7, 32, 3), (5, 4, 16, 3)),
    ),
    (lambda spark: None, lambda spark: lines(spark, (1, None, 1, 4), (4, 4, 8, 4))),
]


def test_gold_follows_increments(spark, sales):
    same_as_anew(spark, sales)
    seen = []
    for n, (new_orders, new_lines) in enumerate(CHANGES):
        for _ in range(1 + (n == 1)):  # the same increment again changes nothing
            gold.refresh_daily_sales(spark, sales, new_orders(spark), new_lines(spark), PLAIN)
            seen.append(same_as_anew(spark, sales))
    assert len({str(s) for s in seen}) == len(CHANGES)
    assert table_names(spark, sales) <= {"orders", "order_lines", "daily_sales", *versions(spark, sales)}


def versions(spark, target):
    return {t for t in table_names(spark, target) if "__version_" in t}


@pytest.mark.parametrize(
    ("step", "done"),
    [
        ("upsert_table", True),
        ("put_in_place", False),
        ("drop_partitions", True),
    ],
)
def test_gold_after_a_stop(spark, sales, monkeypatch, step, done):
    """The driver dies before or after a step; the increments are given again."""
    new_orders, new_lines = CHANGES[1]
    gold.refresh_daily_sales(spark, sales, CHANGES[0][0](spark), orders=PLAIN)
    kept, calls = getattr(gold, step), []

    def stopping(*args, **options):
        calls.append(step)
        # The first call of put_in_place only cleans up.
        if len(calls) == (2 if step == "put_in_place" else 1):
            if done:
                kept(*args, **options)
            raise KeyboardInterrupt
        return kept(*args, **options)

    monkeypatch.setattr(gold, step, stopping)
    with pytest.raises(KeyboardInterrupt):
        gold.refresh_daily_sales(spark, sales, new_orders(spark), new_lines(spark), PLAIN)
    monkeypatch.undo()
    gold.refresh_daily_sales(spark, sales, new_orders(spark), new_lines(spark), PLAIN)
    same_as_anew(spark, sales)


def test_gold_reads_touched_years_only(spark, sales, monkeypatch):
    plans, kept = [], gold.keep

    def watched(spark, target, what, rows):
        if what == "result":
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return kept(spark, target, what, rows)

    monkeypatch.setattr(gold, "keep", watched)
    gold.refresh_daily_sales(spark, sales, orders(spark, (4, date(2024, 3, 3), 2)), orders=PLAIN)
    assert "PartitionFilters: [SalesYear" in plans[0] or "PartitionFilters: [isnotnull(SalesYear" in plans[0]
    same_as_anew(spark, sales)


def test_profile_reads_changed_partitions_only(spark, target):
    spec = ORDERS.with_layout("CustomerID")
    rows = seed.table(spark, "orders", [{"OrderID": i, "CustomerID": i % 4 or None, "LastEditedBy": i * 10**9 % 7919} for i in range(200)])
    write_bronze(rows.where("CustomerID IS NULL OR CustomerID < 3"), target, spec)
    assert profile_store.refresh_profile(spark, target, spec) == 3
    assert profile_store.refresh_profile(spark, target, spec) == 0
    upsert_table(spark, target, spec, rows.where("CustomerID = 3 OR OrderID = 1"), "LastEditedBy")
    assert profile_store.refresh_profile(spark, target, spec) == 2
    table = read_bronze(spark, target, "orders")
    columns = [c for c in table.columns if c not in ("CustomerID",)]
    exact = profile.column_profile(table, columns, distinct="exact")
    assert spark_rows(profile_store.stored_profile(spark, target, spec)) == spark_rows(exact)
    # Rows leave a partition: it goes, and so does its state.
    moved = rows.where("CustomerID = 3").withColumn("CustomerID", F.lit(1)).withColumn("LastEditedBy", F.lit(10**9))
    upsert_table(spark, target, spec, moved.select(rows.columns), "LastEditedBy")
    assert profile_store.refresh_profile(spark, target, spec) == 1
    assert profile_store.stored_profile(spark, target, spec).first()["rows"] == 200
    assert read_bronze(spark, target, "orders__profile").count() == 3


def test_profile_of_tables_without_partitions_rows_or_values(spark, target):
    write_bronze(seed.stock_groups(spark), target, GROUPS)
    assert profile_store.refresh_profile(spark, target, GROUPS) == 1
    assert profile_store.refresh_profile(spark, target, GROUPS) == 0
    exact = profile.column_profile(read_bronze(spark, target, "stock_groups"), distinct="exact")
    assert spark_rows(profile_store.stored_profile(spark, target, GROUPS)) == spark_rows(exact)
    assert profile_store.refresh_profile(spark, target, GROUPS, ["StockGroupName"]) == 1
    assert profile_store.stored_profile(spark, target, GROUPS).count() == 1
    for spec in (GROUPS, replace(GROUPS, partition_by=("LastEditedBy",))):
        write_bronze(seed.table(spark, "stock_groups", []), target, replace(spec, name=f"empty{len(spec.partition_by)}"))
        empty = replace(spec, name=f"empty{len(spec.partition_by)}")
        profile_store.refresh_profile(spark, target, empty, ["StockGroupName"])
        found = profile_store.stored_profile(spark, target, empty).collect()
        assert [r["rows"] for r in found] in ([], [0])


def test_large_means_do_not_cancel(spark):
    df = spark.range(1000).selectExpr("id % 3 AS part", "CAST(1e9 + id % 7 AS DOUBLE) AS x")
    found = profile_store.merged(profile_store.states(df, ["part"], ["x"]), ["x"]).first()
    exact = profile.column_profile(df, ["x"]).first()
    assert (found["mean"], found["stddev"]) == (exact["mean"], exact["stddev"])


@pytest.mark.parametrize("before_ledger", [True, False])
def test_a_batch_that_runs_twice_counts_once(spark, target, tmp_path, monkeypatch, before_ledger):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    for n in range(3):
        rows = orders(spark, (n, date(2024, 1, 1 + n), 1), (n + 1, date(2024, 2, 1), 2 + n))
        rows.coalesce(1).write.mode("append").parquet(landing)
    from bronzeflow.streaming import upsert

    calls, kept = [], upsert.save

    def stopping(rows, target, name, *args, **options):
        calls.append(name)
        if before_ledger and len(calls) == 2:
            raise ConnectionError("stopped")
        kept(rows, target, name, *args, **options)
        if not before_ledger and len(calls) == 2:
            raise ConnectionError("stopped")

    monkeypatch.setattr(upsert, "save", stopping)

    def run():
        stream = read_files(spark, landing, rows.schema, files_per_batch=1)
        upsert_stream(stream, target, ORDERS, checkpoint).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    run()
    ledger = applied_batches(spark, target, ORDERS).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows) for r in ledger] == [(0, 2), (1, 2), (2, 2)]
    spark.catalog.refreshTable(target.name("orders"))
    found = {(r.OrderID, r.OrderDate) for r in read_bronze(spark, target, "orders").collect()}
    assert found == {(0, date(2024, 1, 1)), *((n, date(2024, 2, 1)) for n in (1, 2, 3))}


RULES = {"named": "StockGroupName IS NOT NULL", "small": "StockGroupID < 3", "known": "LastEditedBy > 0"}


@pytest.mark.parametrize("unknown_passes", [False, True])
def test_quarantine_parts_rows_and_counts_them(spark, target, unknown_passes):
    df = spark.createDataFrame(
        [(1, "a", 1), (2, None, 1), (3, None, 0), (None, "b", None), (2, "c", 5), (2, "c", 5)],
        "StockGroupID int, StockGroupName string, LastEditedBy int",
    )
    counts = quarantine.write_checked(df, target, GROUPS, RULES, unknown_passes)
    good = quarantine.passing(spark, target, GROUPS)
    bad = quarantine.quarantined(spark, target, GROUPS)
    assert spark_rows(good.unionByName(bad.drop("_broken_rules"))) == spark_rows(df)
    broken = {(r.StockGroupID, r.StockGroupName): r["_broken_rules"] for r in bad.collect()}
    wanted = {(2, None): ["named"], (3, None): ["named", "small", "known"], (None, "b"): ["small", "known"]}
    if unknown_passes:
        del wanted[(None, "b")]
    assert broken == wanted
    assert counts["total"] == 6 and counts["passed"] == good.count() == 6 - len(broken)
    assert counts["broken_named"] == 2
    assert "PartitionFilters: [isnotnull(_passed" in good._jdf.queryExecution().toString()


def test_quarantine_of_nothing_and_of_clashing_names(spark, target):
    empty = seed.stock_groups(spark).where("false")
    counts = quarantine.write_checked(empty, target, GROUPS, RULES)
    assert set(counts.values()) == {0}
    assert quarantine.passing(spark, target, GROUPS).count() == 0
    assert quarantine.write_checked(seed.stock_groups(spark), target, GROUPS, {})["passed"] == 2
    with pytest.raises(ValueError, match="_passed"):
        quarantine.write_checked(empty.withColumn("_PASSED", F.lit(1)), target, GROUPS, RULES)


@pytest.fixture
def cfg(spark):
    return PipelineConfig(
        schema_name=f"run_{uuid.uuid4().hex}", location=scratch_path(spark, "test-run")
    )


class Stopping(seed.SeedSource):
    """Reading the lines fails the first time."""

    def read(self, spark, spec):
        rows = super().read(spark, spec)
        if spec.name == "order_lines" and self.reads.count("order_lines") == 1:
            raise ConnectionError("connection lost")
        return rows


def test_a_stopped_run_is_taken_up(spark, cfg):
    source, small = Stopping(), replace(cfg, catalog_partitions=False)
    with pytest.raises(ConnectionError):
        job.run_bronze(spark, small, source, RUN, run_id="a")
    assert "order_lines" not in Ledger(spark, small.target, "a").done()
    result = job.run_bronze(spark, small, source, RUN, run_id="a")
    assert sorted(source.reads) == sorted([*SPECS, "order_lines"])
    plain = job.run_bronze(spark, small, source, RUN)
    assert result.metrics == plain.metrics
    kinds = [{k: type(v) for k, v in m.items()} for m in (result.metrics["stock_items"], plain.metrics["stock_items"])]
    assert kinds[0] == kinds[1]
    assert len(source.reads) == 2 * len(SPECS) + 1


def test_ledger_keeps_values_of_every_kind(spark, target):
    ledger = Ledger(spark, target, "a'b")
    metrics = {"i": 3, "f": 0.1, "d": Decimal("1.20"), "n": None, "b": True, "t": datetime(2024, 1, 2, 3), "s": "x'y"}
    ledger.record("orders", metrics)
    Ledger(spark, target, "other").record("orders", {"i": 4})
    assert Ledger(spark, target, "a'b").done() == {"orders": metrics}
