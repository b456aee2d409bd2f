import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bronzeflow.llm import sharding
from bronzeflow.llm.queries import op5_sharding

SF_DIR = "/root/testdata/sf0.01"


def checked(rows, n_shards):
    """Totals per shard; slots must run from 0 without gaps."""
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n_shards))
    totals = Counter()
    for r in rows:
        totals[r.shard] += r["size"]
    return totals


def near_equal(totals, rows, n_shards):
    mean = sum(r["size"] for r in rows) / n_shards
    most = max(r["size"] for r in rows)
    return all(abs(totals[s] - mean) <= most for s in range(n_shards))


def test_query(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op5_sharding(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(docs))
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(docs[r.doc_id]) + 16, zlib.crc32(docs[r.doc_id]))
        assert (r.law, r.grown_shard) == ("bytes", None)
    assert near_equal(checked(rows, 40), rows, 40)
    assert rows and sorted(rows) == sorted(op5_sharding(spark, SF_DIR).collect())


@pytest.mark.parametrize("small", [0, 1000])
def test_hot_group_is_divided(spark, small):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 1000, "the same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
        F.lit(9).alias("size"),
    )
    same = spark.createDataFrame([(None, None, 9)] * 700, "doc_id long, text string, size int")
    rows = sharding.assign_shards(df.unionByName(same), 8, small=small).collect()
    assert len(rows) == 3700
    totals = checked(rows, 8)
    assert near_equal(totals, rows, 8)
    assert len({r.shard for r in rows if r.doc_id is None}) >= 1
    crc = zlib.crc32(b"the same text")
    hot = {r.shard for r in rows if r.text_crc32 == crc}
    assert len(hot) > 1 and max(hot) - min(hot) == len(hot) - 1  # side by side


def test_columns_are_carried(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, None)], "doc_id long, text string, range string")
    got = sharding.assign_shards(df, 3, carry=["text", "range"])
    assert got.columns[-2:] == ["text", "range"]
    assert {(r.doc_id, r.text, r["range"], r["size"]) for r in got.collect()} == {(1, "a", "x", 17), (2, None, None, 16)}


def test_empty_table(spark):
    assert sharding.assign_shards(spark.createDataFrame([], "doc_id long, text string"), 4).count() == 0
