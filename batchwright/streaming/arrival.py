"""New batch folders picked up by Structured Streaming.

The batch loop is idempotent (already loaded batches are skipped), so the
stream only has to notice that part files arrived.  A ``binaryFile`` stream
over ``<root>/batch*/*`` lists new ``part*`` files (their content is never
read: only ``path`` is selected); a micro-batch that saw any new file runs
:func:`replay`, which decides per batch folder what is left to load.  The stream's
checkpoint records which files were seen, so a restart does not redo work and
a batch folder is handed over exactly once.

Writers should make a batch folder visible whole (write elsewhere, then
rename), as the loop loads whatever part files a table folder holds.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.stamps import BATCH_PREFIX
from ..operators.scd2 import STRICT
from ..plans.pipeline import BatchReport, replay
from ..session import work_dir
from ..sources.delimited import PART_GLOB
from ..specs import Registry


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Streaming DataFrame of ``batch`` folder names of newly seen part files."""
    root = root.rstrip("/")
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", PART_GLOB)
        .option("recursiveFileLookup", "true")
        .load(f"{root}/{BATCH_PREFIX}*/*")
    )
    pattern = ".*/" + re.escape(root.rsplit("/", 1)[-1]) + r"/(batch[^/]*)/"
    return files.select(F.regexp_extract("path", pattern, 1).alias("batch"))


def watch(
    spark: SparkSession,
    store,
    registry: Registry,
    root: str,
    fact_table: str,
    mode: str = STRICT,
    checkpoint: str | None = None,
    once: bool = True,
    interval: str = "1 minute",
    sep: str = "|",
    reports: list[BatchReport] | None = None,
) -> StreamingQuery:
    """Start the stream.  ``once`` processes what is there and stops
    (``availableNow``); otherwise it polls every ``interval``."""
    if not checkpoint:
        raise ValueError("watch needs a checkpoint folder that outlives the application")

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        if df.select("batch").distinct().limit(1).count() == 0:
            return
        out = replay(spark, store, registry, root, fact_table, mode=mode, sep=sep)
        if reports is not None:
            reports.extend(out)

    writer = arrivals(spark, root).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
