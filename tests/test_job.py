"""The whole run, its error policy, and its cost in source reads."""

import uuid
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from bronzeflow.config import PipelineConfig, RunContext, Target
from bronzeflow.plans import job, layers, reports
from bronzeflow.session import job_session, runs_on_one_machine, scratch_path, shared_folder
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.specs import SPECS
from tests import seed

RUN = RunContext(datetime(2024, 1, 20, 2, 0, tzinfo=timezone.utc))


@pytest.fixture
def cfg(spark):
    return PipelineConfig(
        schema_name=f"run_{uuid.uuid4().hex}", location=scratch_path(spark, "test-run")
    )


def test_run_loads_and_reports(spark, cfg):
    source = seed.SeedSource()
    result = job.run_bronze(spark, cfg, source, RUN)
    assert source.reads[0] == "customers"
    assert sorted(source.reads) == sorted(SPECS)
    assert result.metrics["order_lines"] == {
        "total": 12,
        "null_order_line_id": 0,
        "null_order_id": 0,
        "total_quantity": 296,
        "avg_unit_price": 16.01,
        "read_back": 12,
    }
    assert result.failed_reports == {}
    assert [tuple(r) for r in result.reports["category_distribution"]] == [
        ("Wrap", 3),
        ("Freight", 2),
    ]
    assert [r.CustomerID for r in result.reports["customers_sample"]] == [1, 2, 3, 4, 5]
    assert [r.names for r in result.reports["group_names"]] == [2]
    for name, spec in SPECS.items():
        table = read_bronze(spark, cfg.target, name)
        assert table.count() == result.metrics[name]["total"]
        assert set(spec.columns) < set(table.columns)


def test_second_run_replaces_the_first(spark, cfg):
    job.run_bronze(spark, cfg, seed.SeedSource(), RUN)
    assert read_bronze(spark, cfg.target, "orders").count() == 5
    later = RunContext(datetime(2024, 1, 21, 2, 0, tzinfo=timezone.utc))
    job.run_bronze(spark, cfg, seed.SeedSource(), later)
    batches = read_bronze(spark, cfg.target, "orders").select("_batch_id").distinct().collect()
    assert [b[0] for b in batches] == ["orders_20240121_020000"]


def test_failed_customers_stop_everything(spark, cfg):
    source = seed.SeedSource(broken=["customers"])
    with pytest.raises(ConnectionError):
        job.run_bronze(spark, cfg, source, RUN)
    assert source.reads == ["customers"]


def test_failed_orders_fail_the_run_but_not_the_stock_tables(spark, cfg):
    source = seed.SeedSource(broken=["orders"])
    with pytest.raises(ConnectionError):
        job.run_bronze(spark, cfg, source, RUN)
    assert "order_lines" not in source.reads
    assert read_bronze(spark, cfg.target, "stock_item_stock_groups").count() == 8


def test_failed_report_does_not_fail_the_run(spark, cfg, monkeypatch):
    def broken(*_):
        raise RuntimeError("no report")

    monkeypatch.setattr(reports, "price_statistics", broken)
    result = job.run_bronze(spark, cfg, seed.SeedSource(), RUN)
    assert result.failed_reports == {"price_statistics": "no report"}
    assert "stock_completeness" in result.reports


def test_findings_are_logged_by_severity(spark, cfg, caplog):
    class NullIds(seed.SeedSource):
        def read(self, spark, spec):
            df = super().read(spark, spec)
            if spec.name == "order_lines":
                df = df.selectExpr("* EXCEPT (OrderID)", "CAST(NULL AS INT) AS OrderID")
            return df

    with caplog.at_level("INFO"):
        job.run_bronze(spark, cfg, NullIds(), RUN)
    levels = {r.getMessage(): r.levelname for r in caplog.records}
    assert levels["order_lines: null_order_id = 12"] == "WARNING"
    assert levels["stock_item_holdings: zero_stock = 1"] == "INFO"


def test_each_source_row_is_read_once(spark, cfg):
    """Metrics, write and checks together pull every source row a single time."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    class Counting(seed.SeedSource):
        def read(self, spark, spec):
            df = super().read(spark, spec)
            return df.mapInArrow(counted, df.schema)

    result = job.run_bronze(spark, cfg, Counting(), RUN)
    assert seen.value == sum(m["total"] for m in result.metrics.values())


def test_increment_brings_over_later_edits(spark, cfg):
    job.run_bronze(spark, cfg, seed.SeedSource(), RUN)
    edited = seed.EDITED + timedelta(days=1)

    class Later(seed.SeedSource):
        """All orders, of which one is edited and one is new."""

        def read(self, spark, spec):
            changed = [
                {"OrderID": i, "CustomerID": 4, "OrderDate": date(2024, 1, d), "LastEditedWhen": e}
                for i, d, e in ((2, 25, edited), (6, 16, edited), (1, 30, seed.EDITED))
            ]
            return super().read(spark, spec).where("OrderID > 2").unionByName(
                seed.table(spark, "orders", changed)
            )

    later = RunContext(datetime(2024, 1, 21, 2, 0, tzinfo=timezone.utc))
    for _ in range(2):
        job.load_increment(spark, Later(), cfg.target, SPECS["orders"], later)
        rows = read_bronze(spark, cfg.target, "orders").collect()
        assert {(r.OrderID, r.OrderDate.day, r._batch_id[-15:]) for r in rows} == {
            (1, 30, "20240121_020000"),  # edited at the mark itself
            (2, 25, "20240121_020000"),
            (3, 17, "20240121_020000"),
            (4, 18, "20240121_020000"),
            (5, 19, "20240121_020000"),
            (6, 16, "20240121_020000"),
        }
        assert len(rows) == 6


def test_run_keeps_old_rows_when_a_source_fails(spark, cfg):
    job.run_bronze(spark, cfg, seed.SeedSource(), RUN)

    class Failing(seed.SeedSource):
        def read(self, spark, spec):
            df = super().read(spark, spec)
            if spec.name in ("orders", "stock_groups"):
                df = df.withColumn("LastEditedBy", F.raise_error(F.lit("gone")).cast("int"))
            return df

    with pytest.raises(Exception, match="gone"):
        job.run_bronze(spark, cfg, Failing(), RUN)
    assert read_bronze(spark, cfg.target, "orders").count() == 5
    assert read_bronze(spark, cfg.target, "stock_groups").count() == 2


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert scratch_path(spark, "x").startswith(named)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_all_group_names_count(spark, cfg):
    names = [{"StockGroupID": i, "StockGroupName": f"g{i}"} for i in range(30)]

    class Many(seed.SeedSource):
        def read(self, spark, spec):
            if spec.name == "stock_groups":
                return seed.table(spark, "stock_groups", names)
            return super().read(spark, spec)

    result = job.run_bronze(spark, replace(cfg, sample_size=2), Many(), RUN)
    assert [r.names for r in result.reports["group_names"]] == [30]
    assert len(result.reports["customers_sample"]) == 2


def test_source_may_lack_an_optional_column(spark, cfg):
    class NoPhoto(seed.SeedSource):
        def read(self, spark, spec):
            return super().read(spark, spec).drop("Photo")

    job.run_bronze(spark, cfg, NoPhoto(), RUN)
    back = read_bronze(spark, cfg.target, "stock_items")
    assert dict(back.dtypes)["Photo"] == "binary" and back.count() > 0


def test_job_session_is_as_the_caller_has_it(spark, target):
    caller = spark.newSession()
    caller.conf.set("spark.sql.ansi.enabled", "false")
    caller.conf.set("spark.sql.autoBroadcastJoinThreshold", "12345")
    caller.catalog.setCurrentDatabase(target.schema)
    session = job_session(caller, **{"spark.sql.shuffle.partitions": "3"})
    assert session.conf.get("spark.sql.ansi.enabled") == "false"
    assert session.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert session.catalog.currentDatabase() == target.schema
    assert session.catalog.currentCatalog() == caller.catalog.currentCatalog()


@pytest.mark.parametrize(
    ("master", "alone"),
    [("local", True), ("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False)],
)
def test_only_one_machine_may_use_a_folder_of_its_own(master, alone):
    assert runs_on_one_machine(master) == alone


def test_silver_needs_the_edit_time(spark):
    with pytest.raises(ValueError, match="LastEditedWhen"):
        layers.silver(seed.orders(spark).drop("LastEditedWhen"), SPECS["orders"])


def test_parameters_have_the_types_of_their_defaults():
    cfg = PipelineConfig.from_mapping({"jdbc_partitions": "7", "staged_writes": "false"})
    assert (cfg.jdbc_partitions, cfg.staged_writes) == (7, False)
    with pytest.raises(ValueError, match="true or false"):
        PipelineConfig.from_mapping({"jdbc_encrypt": "maybe"})


def test_parameters():
    cfg = PipelineConfig.from_mapping({"schema_name": "landing"})
    assert cfg.target == Target("landing", "spark_catalog")
    assert cfg.target.name("orders") == "`spark_catalog`.`landing`.`orders`"
    with pytest.raises(ValueError, match="schema"):
        PipelineConfig.from_mapping({"schema": "typo"})


def test_the_query_of_the_run_fails_with_a_report(spark, monkeypatch):
    from bronzeflow.plans.job import BronzeRun
    from bronzeflow.registry import queries

    run = BronzeRun(metrics={"orders": {"total": 1}}, failed_reports={"customers": "no table"})
    monkeypatch.setattr(queries, "run_bronze", lambda *args, **options: run)
    with pytest.raises(RuntimeError, match="customers"):
        queries.bronze_run(spark, "unused")
