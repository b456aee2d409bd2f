"""What a run has loaded so far, kept in a table, so that it can be taken up again."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from threading import Lock
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bronzeflow.config import Target
from bronzeflow.operators.sinks import save

SCHEMA = "run string, table string, step string, metric string, kind string, value string"
LOADED = "loaded"

_READERS = {
    "int": int,
    "float": float,
    "Decimal": Decimal,
    "bool": lambda text: text == "True",
    "date": date.fromisoformat,
    "datetime": datetime.fromisoformat,
    "str": str,
    "NoneType": lambda text: None,
}


class Ledger:
    """Entries ``(run, table, step, metric, kind, value)``, a few for each table of a run.

    An entry is written after the step is done: a run that stops in between does
    the step again. Tables of one run may be loaded side by side; their entries
    are written one after another. Two drivers must not share a run.
    """

    def __init__(self, spark: SparkSession, target: Target, run: str) -> None:
        self.spark, self.target, self.run = spark, target, run
        self.name = target.name("run_ledger")
        self.lock = Lock()
        if not spark.catalog.tableExists(self.name):
            save(spark.createDataFrame([], SCHEMA), target, self.name)

    def done(self) -> dict[str, dict[str, Any]]:
        """Metrics of the tables that this run has loaded."""
        self.spark.catalog.refreshTable(self.name)
        own = (F.col("run") == self.run) & (F.col("step") == LOADED)
        found: dict[str, dict[str, Any]] = {}
        for r in self.spark.table(self.name).where(own).collect():
            found.setdefault(r.table, {})[r.metric] = _READERS[r.kind](r.value)
        return found

    def record(self, table: str, metrics: dict[str, Any]) -> None:
        rows = [
            (self.run, table, LOADED, metric, type(value).__name__, str(value))
            for metric, value in metrics.items()
        ]
        with self.lock:
            entries = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
            save(entries, self.target, self.name, mode="append")
