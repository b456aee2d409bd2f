"""Session for tests and local benchmarks, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "bronzeflow", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # On one machine, a listing task costs more than the folder it lists.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A session for a job that writes: everything as the caller has it, then ``conf``.

    Settings changed at run time, the current catalog and the current schema come
    along; static settings are shared by all sessions anyway.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.get(key, None) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    # Many small folders are listed by a few tasks per core, not by one task each.
    listing = min(10_000, 4 * spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing))
    for key, value in conf.items():
        session.conf.set(key, value)
    return session


def runs_on_one_machine(master: str) -> bool:
    """Whether driver and executors are one process, so that they share every folder."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session on one machine may do without the setting (a test, say); it
    gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not (folder := spark.sparkContext.getCheckpointDir()):
        if not runs_on_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="bronzeflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/bronzeflow/{purpose}-{uuid.uuid4().hex}"
