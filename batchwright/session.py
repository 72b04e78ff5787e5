"""Session-level settings the library relies on.

The library never creates a session for library calls: callers pass theirs.
Scratch data (staged change sets, JDBC staging) goes under the shared folder
named by ``spark.checkpoint.dir``; a private temporary folder is used only
when that setting is absent, as in local tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from . import fs


def work_dir(spark: SparkSession) -> str:
    """Shared scratch root for this application.

    Reads the checkpoint folder from the session; only when none is set
    (local runs) a fresh temporary folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = configured or tempfile.mkdtemp(prefix="batchwright-ckpt-")
        sc.setCheckpointDir(base)
        current = sc.getCheckpointDir()
    return current.rstrip("/") + "/batchwright"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under :func:`work_dir` (never reused)."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    fs.mkdirs(spark, path)
    return path


@contextmanager
def shuffle_files_cleaned(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a job's query go when the query ends, not when the driver
    happens to collect garbage.  For queries that write their result: no later one reads the files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(app: str = "batchwright", cores: int = 8, shuffle_partitions: int = 8, event_log: str | None = None) -> SparkSession:
    """Session for tests, the bench and the query entry points.

    ``event_log`` (a folder) turns on Spark's event log there, the source of
    stage and task times (the web UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="batchwright-wh-"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={tempfile.mkdtemp(prefix='batchwright-derby-')}")
    )
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
