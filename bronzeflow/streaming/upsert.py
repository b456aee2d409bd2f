"""Stream into an upsert, each batch counted once.

An extension: planned as a next step only, so the semantics are our own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bronzeflow.config import Target
from bronzeflow.operators.incremental import latest_per_key, upsert_table
from bronzeflow.operators.sinks import save, write_bronze
from bronzeflow.specs import TableSpec

LEDGER_SCHEMA = "stream string, batch_id long, rows long"


def ledger_name(target: Target, spec: TableSpec) -> str:
    return target.name(f"{spec.name}__batches")


def applied_batches(spark: SparkSession, target: Target, spec: TableSpec) -> DataFrame:
    """``(stream, batch_id, rows)`` of the batches that are in the table."""
    name = ledger_name(target, spec)
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def upsert_stream(
    rows: DataFrame,
    target: Target,
    spec: TableSpec,
    checkpoint: str,
    stream: str = "default",
    then: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Upsert what is there by primary key, a batch at a time, then stop.

    A batch is written to the ledger after it is in the table. If the stream
    stops before that, the batch runs again, and the upsert takes its rows again
    without harm; if it stops after that, the batch is passed over. So every row
    is in the table and counted once, wherever the stream was stopped. ``stream``
    names the ledger's entries; streams with checkpoints of their own need names
    of their own. ``then`` is called when a batch is in the table, before it
    counts: it may run twice for a batch, too.
    """
    order_by = spec.edited_column

    def once(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = applied_batches(spark, target, spec)
        if not done.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        counted = Observation(f"{spec.name}-{uuid.uuid4().hex}")
        seen = batch.observe(counted, F.count(F.lit(1)).alias("rows"))
        if spark.catalog.tableExists(target.name(spec.name)):
            upsert_table(spark, target, spec, seen, order_by)
        else:
            write_bronze(latest_per_key(seen, spec.primary_key, order_by), target, spec)
        if then:
            then(spark, batch_id)
        entry = spark.createDataFrame([(stream, batch_id, counted.get["rows"])], LEDGER_SCHEMA)
        save(entry.coalesce(1), target, ledger_name(target, spec), mode="append")

    return (
        rows.writeStream.foreachBatch(once)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
