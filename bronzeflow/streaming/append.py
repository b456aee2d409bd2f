"""Bronze append as a stream of files.

An extension: planned as a next step only, so the semantics are our own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bronzeflow.config import RunContext, Target


def read_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Files of a folder as a stream; new ones join as they arrive."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .parquet(folder)
    )


def append_stream(
    rows: DataFrame, target: Target, table: str, prefix: str, run: RunContext, checkpoint: str
) -> StreamingQuery:
    """Append what is there, with lineage columns, then stop.

    Nothing is held between batches. Checkpoint and file sink together append
    each input file once, also when the query is started again after a failure.
    """
    bronze = rows.withColumns(
        {
            "_extract_timestamp": F.lit(run.ts),
            "_source_system": F.lit(run.source_system),
            "_batch_id": F.lit(run.batch_id(prefix)),
        }
    )
    return (
        bronze.writeStream.format(target.table_format)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .toTable(target.name(table))
    )
