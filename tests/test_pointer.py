"""Overwrites by pointer: readers, stops at every step, keys that prune scans."""

import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from bronzeflow.config import Target
from bronzeflow.operators import incremental, sinks
from bronzeflow.session import scratch_path
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.specs import SPECS
from tests import seed
from tests.compare import spark_rows, table_names

GROUPS = SPECS["stock_groups"]
ORDERS = SPECS["orders"].with_layout("OrderDate")


@pytest.fixture
def listed(spark, target):
    """A target whose partitions are found by listing folders."""
    t = Target(f"{target.schema}_l", location=scratch_path(spark, "test"), catalog_partitions=False)
    sinks.ensure_namespace(spark, t)
    return t


def rows_of(spark, name):
    return seed.BUILDERS[name](spark)


def numbered(spark, version, n=400):
    return spark.range(n).selectExpr(
        "CAST(id AS INT) AS StockGroupID", f"'v{version}' AS StockGroupName"
    )


@pytest.mark.parametrize("parts", [(), ("StockGroupName",)])
def test_readers_see_old_or_new_rows(spark, listed, parts):
    """A reader in a session of its own never misses the table and never sees a mixture."""
    spec = replace(GROUPS, partition_by=parts)
    sinks.write_bronze(numbered(spark, 0), listed, spec)
    seen, failures, stop = [], [], threading.Event()

    def read():
        session = spark.newSession()
        while not stop.is_set():
            try:
                session.catalog.refreshTable(listed.name("stock_groups"))
                found = read_bronze(session, listed, "stock_groups").groupBy("StockGroupName").count().collect()
                seen.append({tuple(r) for r in found})
            except Exception as error:
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for version in range(1, 4):
            sinks.write_bronze(numbered(spark, version), listed, spec)
    finally:
        stop.set()
        reader.join()
    assert failures == []
    assert all(len(s) == 1 and next(iter(s))[1] == 400 for s in seen)
    assert {next(iter(s))[0] for s in seen} <= {"v0", "v1", "v2", "v3"}
    assert spark_rows(read_bronze(spark, listed, "stock_groups").select("StockGroupID", "StockGroupName")) == spark_rows(numbered(spark, 3))


@pytest.mark.parametrize("name", ["stock_groups", "orders"])
@pytest.mark.parametrize("step", range(4))
def test_a_stop_at_every_step_leaves_a_readable_table(spark, listed, monkeypatch, name, step):
    """The driver dies before the n-th call that changes the catalog."""
    spec, old = SPECS[name], rows_of(spark, name)
    sinks.write_bronze(old, listed, spec)
    new = old.withColumn("Extra", F.lit(1))
    landed = sinks.version_name(name)
    sinks.save(new, listed, listed.name(landed), spec)
    calls, sql = [], type(spark).sql

    def stopping(session, text, *args, **options):
        if text.startswith("ALTER"):
            calls.append(text)
            if len(calls) == step + 1:
                raise KeyboardInterrupt
        return sql(session, text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", stopping)
    with pytest.raises(KeyboardInterrupt):
        sinks.swap_in(spark, listed, landed, spec)
    monkeypatch.undo()
    spark.catalog.refreshTable(listed.name(name))
    back = read_bronze(spark, listed, name)
    has_new = step == 3  # all but the last call were done
    wanted = new if has_new else old
    assert spark_rows(back.select(*wanted.columns)) == spark_rows(wanted)
    # The next run mends what is left, and takes no live folder away.
    sinks.restore_previous(spark, listed, name)
    sinks.drop_versions(spark, listed, name)
    spark.catalog.refreshTable(listed.name(name))
    assert spark_rows(read_bronze(spark, listed, name).select(*wanted.columns)) == spark_rows(wanted)
    assert table_names(spark, listed) == {name}
    sinks.write_bronze(new, listed, spec)
    assert spark_rows(read_bronze(spark, listed, name)) == spark_rows(new)


def test_old_version_stays_until_the_next_overwrite(spark, listed):
    for version in range(3):
        sinks.write_bronze(numbered(spark, version), listed, GROUPS)
        assert len(sinks.versions(spark, listed, "stock_groups")) == min(version, 1)
    (old,) = sinks.versions(spark, listed, "stock_groups")
    assert spark_rows(spark.table(listed.name(old))) == spark_rows(numbered(spark, 1))


def test_a_failed_overwrite_leaves_no_version(spark, listed):
    sinks.write_bronze(numbered(spark, 0), listed, GROUPS)
    failing = numbered(spark, 1).withColumn("StockGroupName", F.raise_error(F.lit("gone")).cast("string"))
    with pytest.raises(Exception, match="gone"):
        sinks.write_bronze(failing, listed, GROUPS)
    assert table_names(spark, listed) == {"stock_groups"}


def test_upsert_where_partitions_are_listed(spark, listed):
    """Partitions that empty, the one of NULL among them, are emptied by writing no rows."""
    rows = [(1, "a", None), (2, "b", "x"), (3, "c", "y"), (4, "d", "it's")]
    df = spark.createDataFrame(rows, "StockGroupID int, StockGroupName string, LastEditedBy string")
    spec = replace(GROUPS, partition_by=("LastEditedBy",), edited_column="StockGroupName")
    sinks.write_bronze(df, listed, spec)
    incoming = spark.createDataFrame([(1, "z", "x"), (3, "z", "x"), (4, "z", "y")], df.schema)
    for _ in range(2):
        incremental.upsert_table(spark, listed, spec, incoming, "StockGroupName")
        found = {tuple(r) for r in read_bronze(spark, listed, "stock_groups").collect()}
        assert found == {(1, "z", "x"), (2, "b", "x"), (3, "z", "x"), (4, "z", "y")}
    assert table_names(spark, listed) == {"stock_groups"}


def scanned_rows(df):
    """Rows that came out of the scan, before the filter."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().get("numOutputRows").get().value()


@pytest.mark.parametrize("kind", ["INT", "BIGINT", "STRING"])
def test_keys_of_an_increment_skip_row_groups(spark, target, kind):
    """Every file spans all keys; the few that hold one of the increment are read."""
    rows = spark.range(0, 100_000, 1, 4).selectExpr(
        f"CAST(id * 7919 % 100000 AS {kind}) AS OrderID", "CAST(id DIV 2500 AS INT) AS OrderPart"
    )
    spec = replace(SPECS["orders"], partition_by=("OrderPart",), foreign_keys=())
    sinks.write_bronze(rows, target, spec)
    session = incremental.key_session(spark)
    keys = rows.where("OrderPart IN (3, 17)").groupBy("OrderPart").agg(F.min("OrderID").alias("OrderID"))
    listed = incremental.of_keys(keys, ["OrderID"])
    found = session.table(target.name("orders")).where(listed).select("OrderID", "OrderPart")
    assert {r.OrderPart for r in found.collect()} == {3, 17}
    assert 2 <= scanned_rows(found) <= 10_000
    everything = session.table(target.name("orders")).where("OrderID IS NOT NULL").select("OrderID")
    assert scanned_rows(everything) == 100_000


def test_the_filter_of_an_upsert_lists_its_keys(spark, target, monkeypatch):
    sinks.write_bronze(seed.orders(spark), target, SPECS["orders"])
    plans, winners = [], incremental.same_key

    def watched(left, right, keys):
        plans.append(left._jdf.queryExecution().optimizedPlan().toString())
        return winners(left, right, keys)

    monkeypatch.setattr(incremental, "same_key", watched)
    incoming = seed.orders(spark).where("OrderID = 2")
    incremental.upsert_table(spark, target, SPECS["orders"], incoming, "LastEditedWhen")
    assert any("(OrderID#" in p and "= 2" in p for p in plans)


def test_keys_as_list_or_range(spark):
    df = spark.createDataFrame([(i, i % 3 or None) for i in range(30)], "a int, b int")
    for most in (100, 5):
        test = incremental.of_keys(df.where("a BETWEEN 10 AND 20"), ["a", "b"], most)
        assert {r.a for r in df.where(test).collect()} == set(range(10, 21))
    nothing = incremental.of_keys(df.where("false"), ["a"], 5)
    assert df.where(nothing).count() == 0
    assert df.where(incremental.of_keys(df.where("false"), ["a"], -1)).count() == 0
    texts = spark.createDataFrame([("it's \\ odd",), ("x",)], "k string")
    assert texts.where(incremental.of_keys(texts.where("k != 'x'"), ["k"])).count() == 1


def test_small_files_stay_small(spark, target, tmp_path):
    """The filter is as large as its keys need, not as large as it may be."""
    sinks.write_bronze(seed.orders(spark), target, SPECS["orders"])
    files = read_bronze(spark, target, "orders").select("_metadata.file_size").distinct().collect()
    assert max(r[0] for r in files) < 60_000
