"""What must not grow with the tables: plans of the queries that are run on large ones."""

from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from bronzeflow.operators import profile
from bronzeflow.operators.incremental import of_keys
from bronzeflow.registry import queries
from bronzeflow.registry.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_an_exact_profile_are_dealt_out_before_they_are_expanded(spark):
    rows = [(i % 5 if i % 3 else None, f"t{i % 4}", float(i % 2), float("nan")) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, t string, x double, nan double")
    found = profile.column_profile(df, distinct="exact")
    text = plan(found)
    assert text.index("Expand") < text.index("RepartitionByExpression")
    shares = profile.dealt_out(df.selectExpr("1 AS same")).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in shares.collect()) < 40
    assert [(r["column"], r["rows"], r["nulls"], r["distinct"], r["min"], r["max"]) for r in found.collect()] == [
        ("k", 60, 20, 5, "0", "4"),
        ("t", 60, 0, 4, "t0", "t3"),
        ("x", 60, 0, 2, "0.0", "1.0"),
        ("nan", 60, 0, 1, "NaN", "NaN"),
    ]


def test_exact_profile_of_a_column_named_twice_and_of_no_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r["distinct"] for r in profile.column_profile(df, ["k", "k"], "exact").collect()] == [2, 2]
    empty = profile.column_profile(df.where("false"), distinct="exact").first()
    assert (empty["rows"], empty["distinct"], empty["min"]) == (0, 0, None)


def test_looks_of_a_stream_land_in_as_many_files_as_they_are_read_in(spark, tmp_path, monkeypatch):
    rows = [(i, i % 7, "O", 1.5, datetime(1998 + i % 3, 1, 1), "1") for i in range(400)]
    columns = (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    )
    orders = spark.createDataFrame(rows, columns).repartition(4)
    orders.write.option("maxRecordsPerFile", 100).parquet(f"{tmp_path}/orders.parquet")
    folders = []

    def own_path(session, purpose):
        folders.append(f"{tmp_path}/{purpose}")
        return folders[-1]

    monkeypatch.setattr(queries, "scratch_path", own_path)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    found = QUERIES["stream_upsert_orders"](session, str(tmp_path)).collect()
    assert len(found) == 400
    early = [r for r in rows if r[0] % 50 and r[4] <= datetime(1999, 6, 30)]
    assert {r["streamed_rows"] for r in found} == {len(early) + 400}
    landed = list(Path(tmp_path, "landing").glob("*.parquet"))
    assert len(landed) > 2


def test_keys_are_listed_or_given_as_a_range(spark):
    rows = spark.range(5000).selectExpr("CAST(id % 4000 AS INT) AS k")
    few = str(of_keys(rows.where("k < 50"), ["k"], most=50))
    assert "IN" in few.upper() and "BETWEEN" not in few.upper()
    many = of_keys(rows, ["k"], most=50)
    assert spark.range(10_000).select(F.col("id").alias("k")).where(many).count() == 4000


def test_distinct_values_of_a_growing_table_stay_spread(spark, monkeypatch):
    seen, exact = [], profile.column_profile

    def noted(df, *args, **options):
        seen.append(df.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.enabled"))
        return exact(df, *args, **options)

    monkeypatch.setattr(profile, "column_profile", noted)
    found = QUERIES["profile_of_growing_table"](spark, "/root/testdata/sf0.001")
    assert {r["column"]: r["distinct_is_near"] for r in found.collect()} == {"OrderID": True, "TotalPrice": True}
    assert seen == ["false"]
