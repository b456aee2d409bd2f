"""Managed tables: overwrite, evolution, metrics, verification, swap."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from bronzeflow.config import RunContext
from bronzeflow.operators import quality, sinks
from bronzeflow.operators.lineage import CUSTOMERS_LINEAGE, STANDARD_LINEAGE, add_lineage, project
from bronzeflow.session import job_session
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.specs import SPECS
from tests import seed
from tests.compare import spark_rows, table_names

RUN = RunContext(datetime(2024, 1, 20, 2, 0, tzinfo=timezone.utc), "shop")
GROUPS = SPECS["stock_groups"]


def test_overwrite_replaces_all_rows(spark, target):
    groups = seed.stock_groups(spark)
    sinks.write_bronze(groups, target, GROUPS)
    sinks.write_bronze(groups.where("StockGroupID = 1"), target, GROUPS)
    assert read_bronze(spark, target, "stock_groups").count() == 1


def test_lineage_profiles(spark):
    orders = add_lineage(seed.orders(spark), SPECS["orders"], RUN)
    assert orders.columns[-3:] == list(STANDARD_LINEAGE)
    row = orders.first()
    assert (row["_source_system"], row["_batch_id"]) == ("shop", "orders_20240120_020000")
    assert row["_extract_timestamp"] == datetime(2024, 1, 20, 2, 0)
    customers = add_lineage(seed.customers(spark), SPECS["customers"], RUN)
    assert customers.columns[-4:] == list(CUSTOMERS_LINEAGE)
    row = customers.first()
    assert (row["source_table"], row["bronze_layer_version"]) == ("Sales.Customers", "1.0")


def test_projection_is_the_contract(spark):
    widened = seed.orders(spark).withColumn("extra", F.lit(1)).select("extra", "*")
    assert project(widened, SPECS["orders"]).columns == SPECS["orders"].columns
    with pytest.raises(Exception, match="Comments"):
        project(widened.drop("Comments"), SPECS["orders"]).columns  # noqa: B018
    assert "Comments" not in project(widened.drop("Comments"), SPECS["orders"], False).columns


def test_partitioned_write_keeps_null_dates(spark, target):
    orders = seed.orders(spark).withColumn(
        "OrderDate", F.when(F.col("OrderID") > 1, F.col("OrderDate"))
    )
    metrics = sinks.write_bronze(orders, target, SPECS["orders"], quality.load_metrics("orders"))
    back = read_bronze(spark, target, "orders")
    assert metrics == {"total": 5, "null_order_id": 0}
    assert back.columns[-1] == "OrderDate"
    assert spark_rows(back) == spark_rows(orders)
    # each date in one file
    files = back.select("OrderDate", F.input_file_name().alias("f")).distinct()
    assert files.count() == 5
    plan = back.where(F.col("OrderDate") == date(2024, 1, 17))
    assert plan.count() == 1
    assert "PartitionFilters: [isnotnull(OrderDate" in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", SPECS)
def test_observed_metrics_equal_a_second_pass(spark, target, name):
    df = seed.BUILDERS[name](spark)
    metrics = sinks.write_bronze(df, target, SPECS[name], quality.load_metrics(name))
    back = read_bronze(spark, target, name)
    assert metrics == back.agg(*quality.load_metrics(name)).first().asDict()


@pytest.mark.parametrize("name", ["orders", "stock_groups"])
def test_empty_input_writes_an_empty_table(spark, target, name):
    df = seed.table(spark, name, [])
    metrics = sinks.write_bronze(df, target, SPECS[name], quality.load_metrics(name))
    assert metrics["total"] == 0
    assert read_bronze(spark, target, name).count() == 0
    assert sinks.verify_load(spark, target, name, 0).first()["ok"]


def test_evolution_keeps_and_adds_columns(spark, target):
    sinks.write_bronze(seed.stock_groups(spark), target, GROUPS)
    changed = seed.stock_groups(spark).drop("LastEditedBy").withColumn("Color", F.lit("red"))
    sinks.write_bronze(changed, target, GROUPS)
    back = read_bronze(spark, target, "stock_groups")
    assert back.columns == GROUPS.columns + ["Color"]
    assert {(r.LastEditedBy, r.Color) for r in back.collect()} == {(None, "red")}


def test_evolution_rejects_another_type(spark, target):
    sinks.write_bronze(seed.stock_groups(spark), target, GROUPS)
    changed = seed.stock_groups(spark).withColumn("StockGroupName", F.lit(1))
    with pytest.raises(ValueError, match="StockGroupName: string -> int"):
        sinks.write_bronze(changed, target, GROUPS)
    assert read_bronze(spark, target, "stock_groups").count() == 2


def test_staged_write_may_read_its_own_table(spark, target):
    sinks.write_bronze(seed.stock_groups(spark), target, GROUPS)
    own = read_bronze(spark, target, "stock_groups").where("StockGroupID = 2")
    with pytest.raises(Exception, match="UNSUPPORTED_OVERWRITE"):
        sinks.write_bronze(own, target, GROUPS, staged=False)
    sinks.write_bronze(own, target, GROUPS)
    assert [r.StockGroupID for r in read_bronze(spark, target, "stock_groups").collect()] == [2]


@pytest.mark.parametrize("name", ["stock_groups", "orders"])
def test_half_done_swap_is_restored(spark, target, name):
    rows = seed.BUILDERS[name](spark)
    sinks.write_bronze(rows, target, SPECS[name])
    parts = bool(SPECS[name].partition_by)
    sinks.rename(spark, target, name, f"{name}__previous", parts)
    assert sinks.restore_previous(spark, target, name)
    assert spark_rows(read_bronze(spark, target, name)) == spark_rows(rows)
    assert not sinks.restore_previous(spark, target, name)


def test_verify_tells_a_mismatch(spark, target):
    sinks.write_bronze(seed.stock_groups(spark), target, GROUPS)
    assert tuple(sinks.verify_load(spark, target, "stock_groups", 3).first()) == (
        "stock_groups",
        3,
        2,
        False,
    )
    assert not sinks.verify_load(spark, target, "stock_groups", None).first()["ok"]


def test_seed_only_when_empty(spark, target):
    groups = seed.stock_groups(spark)
    assert sinks.append_if_empty(groups, target, GROUPS)
    assert not sinks.append_if_empty(groups, target, GROUPS)
    assert read_bronze(spark, target, "stock_groups").count() == 2
    sinks.write_bronze(groups.where("false"), target, GROUPS)
    assert sinks.append_if_empty(groups.withColumn("Color", F.lit("red")), target, GROUPS)
    back = read_bronze(spark, target, "stock_groups")
    assert back.count() == 2 and back.columns[-1] == "Color"


@pytest.mark.parametrize("there", [False, True])
def test_seed_of_a_partitioned_table(spark, target, there):
    orders, spec = seed.orders(spark), SPECS["orders"]
    if there:
        sinks.write_bronze(orders.where("false"), target, spec)
    assert sinks.append_if_empty(orders, target, spec)
    assert not sinks.append_if_empty(orders, target, spec)
    assert spark_rows(read_bronze(spark, target, "orders")) == spark_rows(orders)
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {target.name('orders')}").collect()}
    assert "OrderDate=2024-01-15" in parts


def test_evolution_knows_names_in_other_case(spark, target):
    sinks.write_bronze(seed.stock_groups(spark), target, GROUPS)
    lower = seed.stock_groups(spark).withColumnRenamed("StockGroupID", "stockgroupid")
    sinks.write_bronze(lower, target, GROUPS)
    back = read_bronze(spark, target, "stock_groups")
    assert back.columns == GROUPS.columns
    assert {r.StockGroupID for r in back.collect()} == {1, 2}
    twice = lower.select("*", F.lit(1).alias("StockGroupID"))
    with pytest.raises(ValueError, match="twice"):
        sinks.write_bronze(twice, target, GROUPS)


def test_evolution_without_the_partition_column(spark, target):
    sinks.write_bronze(seed.orders(spark), target, SPECS["orders"])
    sinks.write_bronze(seed.orders(spark).drop("OrderDate"), target, SPECS["orders"])
    back = read_bronze(spark, target, "orders").collect()
    assert {r.OrderDate for r in back} == {None} and len(back) == 5


def test_namespace_can_be_selected(spark, target):
    session = spark.newSession()
    sinks.ensure_namespace(session, target, use=True)
    assert session.catalog.currentDatabase() == target.schema
    assert spark.catalog.currentDatabase() == "default"


def test_staged_write_of_a_partitioned_table(spark, target):
    orders, spec = seed.orders(spark), SPECS["orders"]
    sinks.write_bronze(orders, target, spec)
    own = read_bronze(spark, target, "orders").where("OrderID > 2")
    metrics = sinks.write_bronze(own, target, spec, quality.load_metrics("orders"))
    assert metrics["total"] == 3
    back = read_bronze(spark, target, "orders")
    assert spark_rows(back) == spark_rows(orders.where("OrderID > 2"))
    assert table_names(spark, target) == {"orders"}


@pytest.mark.parametrize("name", ["stock_groups", "orders"])
def test_failing_source_leaves_the_old_rows(spark, target, name):
    rows, spec = seed.BUILDERS[name](spark), SPECS[name]
    sinks.write_bronze(rows, target, spec)
    failing = rows.withColumn("LastEditedBy", F.raise_error(F.lit("gone")).cast("int"))
    with pytest.raises(Exception, match="gone"):
        sinks.write_bronze(failing, target, spec, quality.load_metrics(name))
    assert spark_rows(read_bronze(spark, target, name)) == spark_rows(rows)
    assert table_names(spark, target) == {name}


@pytest.mark.parametrize("name", ["stock_groups", "orders"])
def test_rows_are_written_once(spark, target, name):
    rows, spec = seed.BUILDERS[name](spark), SPECS[name]
    sinks.write_bronze(rows, target, spec)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    # After the rebalance there is one stage more only if the rows are read again.
    sinks.write_bronze(rows.mapInArrow(counted, rows.schema), target, spec)
    assert seen.value == rows.count()
    assert spark_rows(read_bronze(spark, target, name)) == spark_rows(rows)


def test_a_date_with_most_rows_is_split(spark, target):
    """Half of the rows have no date; several tasks write them."""
    session = job_session(
        spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    )
    rows = session.range(0, 200_000, 1, 8).selectExpr(
        "CAST(id AS INT) AS OrderID",
        "uuid() AS Comments",
        "CASE WHEN id % 2 = 0 THEN date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) END"
        " AS OrderDate",
    )
    sinks.write_bronze(rows, target, SPECS["orders"])
    files = (
        read_bronze(spark, target, "orders")
        .select("OrderDate", F.input_file_name().alias("file"))
        .groupBy("OrderDate")
        .agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"))
        .collect()
    )
    counts = {r.OrderDate: (r.files, r.n) for r in files}
    assert counts.pop(None)[0] > 3
    assert sum(n for _, n in counts.values()) == 100_000
