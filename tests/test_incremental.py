"""Upserts, high-water marks and the streaming append."""

import re
import shutil
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bronzeflow.config import RunContext
from bronzeflow.operators import incremental
from bronzeflow.operators.sinks import write_bronze
from bronzeflow.sources.catalog import read_bronze
from bronzeflow.specs import SPECS
from bronzeflow.streaming.append import append_stream, read_files
from tests import seed
from tests.compare import table_names

ORDERS = SPECS["orders"]
RUN = RunContext(datetime(2024, 1, 20, 2, 0))


def edits(spark, rows):
    return spark.createDataFrame(rows, "k int, edited int, v string")


def order_rows(spark, rows):
    return seed.table(
        spark,
        "orders",
        [
            {"OrderID": i, "CustomerID": c, "OrderDate": d, "LastEditedWhen": datetime(2024, 2, e)}
            for i, c, d, e in rows
        ],
    )


def test_latest_per_key(spark):
    df = edits(spark, [(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 1, "d"), (None, 1, "e")])
    rows = {tuple(r) for r in incremental.latest_per_key(df, ["k"], "edited").collect()}
    assert rows == {(1, 2, "b"), (2, 1, "d"), (None, 1, "e")}


def test_upsert_takes_incoming_and_keeps_the_rest(spark):
    base = edits(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    incoming = edits(spark, [(2, 1, "B1"), (2, 2, "B2"), (3, 1, "C"), (None, 2, "N")])
    rows = {tuple(r) for r in incremental.upsert(base, incoming, ["k"], "edited").collect()}
    assert rows == {(1, 1, "a"), (2, 2, "B2"), (3, 1, "C"), (None, 2, "N")}


def test_newest_edit_wins_and_ties_take_incoming(spark):
    base = edits(spark, [(1, 5, "a"), (2, 5, "b"), (3, None, "c"), (4, 5, "d"), (5, 5, "e")])
    incoming = edits(
        spark, [(1, 4, "old"), (2, 5, "tie"), (3, None, "tie"), (4, None, "none"), (5, 4, "x"), (5, 6, "y")]
    )
    rows = {tuple(r) for r in incremental.upsert(base, incoming, ["k"], "edited").collect()}
    assert rows == {(1, 5, "a"), (2, 5, "tie"), (3, None, "tie"), (4, 5, "d"), (5, 6, "y")}


@pytest.mark.parametrize("keys_stay", [False, True])
def test_upsert_reads_touched_partitions_only(spark, target, monkeypatch, keys_stay):
    spec = replace(SPECS["stock_groups"], partition_by=("StockGroupName",))
    rows = [{"StockGroupID": i, "StockGroupName": n} for i, n in enumerate("abc")]
    quoted = {"StockGroupID": 3, "StockGroupName": "it's \\ odd"}
    write_bronze(seed.table(spark, "stock_groups", [*rows, quoted]), target, spec)
    plans = []
    kept = incremental.not_beaten

    def watched(base, *rest):
        plans.append(base._jdf.queryExecution().executedPlan().toString())
        return kept(base, *rest)

    monkeypatch.setattr(incremental, "not_beaten", watched)
    moved = {"StockGroupID": 3, "StockGroupName": "a"}
    incoming = seed.table(spark, "stock_groups", [rows[1], rows[1] if keys_stay else moved])
    incremental.upsert_table(spark, target, spec, incoming, "ValidFrom", keys_stay)
    (filters,) = re.findall(r"PartitionFilters: (\[[^\n]*?\]), Pushed", plans[-1])
    assert "StockGroupName" in filters
    back = read_bronze(spark, target, "stock_groups").collect()
    names = {r.StockGroupID: r.StockGroupName for r in back}
    assert names == {0: "a", 1: "b", 2: "c", 3: quoted["StockGroupName"] if keys_stay else "a"}
    assert table_names(spark, target) == {"stock_groups"}


def test_a_failed_upsert_leaves_no_side_tables(spark, target):
    write_bronze(seed.orders(spark), target, ORDERS)
    failing = seed.orders(spark).withColumn("CustomerID", F.raise_error(F.lit("gone")).cast("int"))
    with pytest.raises(Exception, match="gone"):
        incremental.upsert_table(spark, target, ORDERS, failing, "LastEditedWhen")
    assert table_names(spark, target) == {"orders"}
    assert read_bronze(spark, target, "orders").count() == 5


def test_partition_literals_are_escaped():
    assert incremental.partition_literal("it's \\ odd") == "'it\\'s \\\\ odd'"
    assert incremental.partition_literal(None) == "NULL"


def test_high_water_mark(spark):
    orders = seed.orders(spark)
    mark = incremental.high_water_mark(orders, "LastEditedWhen")
    assert mark == seed.EDITED
    # Rows at the mark come again, and so do rows without a time.
    assert incremental.newer_than(orders, "LastEditedWhen", mark).count() == 5
    later = mark + timedelta(microseconds=1)
    assert incremental.newer_than(orders, "LastEditedWhen", later).count() == 0
    unknown = orders.withColumn("LastEditedWhen", F.lit(None).cast("timestamp"))
    assert incremental.newer_than(unknown, "LastEditedWhen", later).count() == 5
    assert incremental.high_water_mark(orders.where("false"), "LastEditedWhen") is None
    assert incremental.newer_than(orders, "LastEditedWhen", None).count() == 5


def test_upsert_of_a_plain_table(spark, target):
    spec = SPECS["stock_groups"]
    write_bronze(seed.stock_groups(spark), target, spec)
    incoming = seed.table(
        spark,
        "stock_groups",
        [{"StockGroupID": 2, "StockGroupName": "Air"}, {"StockGroupID": 3, "StockGroupName": "Sea"}],
    )
    for _ in range(2):
        incremental.upsert_table(spark, target, spec, incoming, "ValidFrom")
        rows = {(r[0], r[1]) for r in read_bronze(spark, target, "stock_groups").collect()}
        assert rows == {(1, "Wrap"), (2, "Air"), (3, "Sea")}


def test_upsert_of_a_partitioned_table_moves_rows(spark, target):
    write_bronze(seed.orders(spark), target, ORDERS)
    untouched = (
        read_bronze(spark, target, "orders")
        .where("OrderID = 1")
        .select(F.input_file_name())
        .first()[0]
    )
    incoming = order_rows(
        spark,
        [
            (2, 2, date(2024, 1, 17), 1),  # leaves its date empty
            (3, 3, None, 1),  # loses its date
            (6, 8, date(2024, 1, 19), 1),  # joins another order
        ],
    )
    wanted = {
        (1, date(2024, 1, 15)),
        (2, date(2024, 1, 17)),
        (3, None),
        (4, date(2024, 1, 18)),
        (5, date(2024, 1, 19)),
        (6, date(2024, 1, 19)),
    }
    for _ in range(2):
        incremental.upsert_table(spark, target, ORDERS, incoming, "LastEditedWhen")
        back = read_bronze(spark, target, "orders")
        assert {(r.OrderID, r.OrderDate) for r in back.collect()} == wanted
        assert back.count() == 6
    partitions = {r[0] for r in spark.sql(f"SHOW PARTITIONS {target.name('orders')}").collect()}
    assert "OrderDate=2024-01-16" not in partitions
    assert back.where("OrderID = 1").select(F.input_file_name()).first()[0] == untouched
    assert table_names(spark, target) == {"orders"}


def test_null_date_partition_can_empty(spark, target):
    write_bronze(order_rows(spark, [(1, 1, None, 1), (2, 1, date(2024, 1, 1), 1)]), target, ORDERS)
    incoming = order_rows(spark, [(1, 1, date(2024, 1, 1), 2)])
    incremental.upsert_table(spark, target, ORDERS, incoming, "LastEditedWhen")
    rows = read_bronze(spark, target, "orders").collect()
    assert sorted((r.OrderID, r.OrderDate) for r in rows) == [
        (1, date(2024, 1, 1)),
        (2, date(2024, 1, 1)),
    ]


def test_stream_appends_each_file_once(spark, target, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    seed.stock_groups(spark).select("StockGroupID", "StockGroupName").coalesce(1).write.parquet(
        landing
    )
    schema = spark.read.parquet(landing).schema

    def run():
        rows = read_files(spark, landing, schema)
        append_stream(rows, target, "groups", "groups", RUN, checkpoint).awaitTermination()
        return read_bronze(spark, target, "groups")

    assert run().count() == 2
    assert run().count() == 2
    (first,) = (tmp_path / "landing").glob("*.parquet")
    shutil.copy(first, first.with_name("part-later.parquet"))
    back = run()
    assert back.count() == 4
    assert back.select("_batch_id").distinct().first()[0] == "groups_20240120_020000"
