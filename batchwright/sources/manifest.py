"""Batch discovery: ``<root>/batch_<date>/<table>/part-*``.

Three forms of the same manifest:

* :func:`manifest` lists folders through Hadoop's FileSystem on the driver.
  It touches metadata only (one entry per batch and table) and is what the
  control loop uses.
* :func:`manifest_scan` lists every file in a Spark scan, their contents pruned;
  the listing of many folders is itself a distributed job.  The loop uses it
  where a landing area holds more files than a driver should walk through.
* :func:`manifest_frame` is a Spark scan over every part file of every batch
  that counts records per batch and table from ``_metadata.file_path``; the
  work is spread over the cluster and grows with the data.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..functions.stamps import BATCH_PREFIX, BatchNameError, batch_date_col, parse_batch_date, token_of
from .delimited import PART_GLOB


@dataclass(frozen=True)
class BatchEntry:
    batch: str
    batch_date: dt.date
    table: str
    path: str
    n_parts: int


def list_batches(spark: SparkSession, root: str, same_day: bool = True) -> list[str]:
    """Child folders of ``root`` whose names start with ``batch``, in load order:
    by date, then by the rest of the name.

    Every name must carry a readable date; otherwise this raises before
    anything is loaded, as do two names of one batch and, unless ``same_day``,
    two batches of one day.
    """
    names = [e.name for e in fs.ls(spark, root) if e.is_dir and e.name.startswith(BATCH_PREFIX)]
    known = token_of if same_day else (lambda d: d.isoformat())
    names.sort(key=lambda n: token_of(parse_batch_date(n)))
    for a, b in zip(names, names[1:]):
        if known(parse_batch_date(a)) == known(parse_batch_date(b)):
            # commits could not tell them apart, so the second one would never load
            raise BatchNameError(f"{a!r} and {b!r} are the same batch to this store")
    return names


def _count_parts(spark: SparkSession, folder: str) -> int:
    direct = sum(1 for e in fs.glob(spark, f"{folder}/{PART_GLOB}") if not e.is_dir)
    # deeper down (in folders of any name, also ``part*``) one file is enough to
    # know that there is something to load
    return direct or int(fs.any_file(spark, folder, PART_GLOB))


def batch_entries(spark: SparkSession, root: str, batch: str) -> list[BatchEntry]:
    """One entry per table folder of ``batch`` (``n_parts`` 0 when empty)."""
    bdate = parse_batch_date(batch)
    out = []
    for e in fs.ls(spark, f"{root.rstrip('/')}/{batch}"):
        if not e.is_dir or e.name.startswith(("_", ".")):
            continue
        out.append(BatchEntry(batch, bdate, e.name, e.path, _count_parts(spark, e.path)))
    return out


def manifest(spark: SparkSession, root: str) -> list[BatchEntry]:
    """All batches in date order, each with its table folders by name."""
    return [entry for b in list_batches(spark, root) for entry in batch_entries(spark, root, b)]


def entries_for(entries: list[BatchEntry], batch: str) -> list[BatchEntry]:
    """The ``(table, path)`` entries of one batch."""
    return [e for e in entries if e.batch == batch]


def _located(root: str, path: Column) -> list[Column]:
    """``batch, table_name`` of a decoded file path: the batch folder is the one
    right below the root, wherever the root is."""
    pattern = ".*/" + re.escape(root.rstrip("/").rsplit("/", 1)[-1]) + r"/(batch[^/]*)/([^/]+)/"
    return [F.regexp_extract(path, pattern, 1).alias("batch"), F.regexp_extract(path, pattern, 2).alias("table_name")]


def manifest_scan(spark: SparkSession, root: str) -> DataFrame:
    """``batch, batch_date, table_name, n_parts, bytes, newest`` of every table folder
    that holds part files, at any depth and in folders of any name.

    One scan of file metadata: paths, lengths and times are columns of the
    ``binaryFile`` source, whose content is not read.  Hidden files and folders
    (``_``, ``.``) are no input."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", PART_GLOB)
        .option("recursiveFileLookup", "true")
        .load(f"{root.rstrip('/')}/{BATCH_PREFIX}*/*")
    )
    found = files.select(*_located(root, F.col("path")), "length", "modificationTime")
    return (
        found.groupBy("batch", "table_name")
        .agg(F.count(F.lit(1)).alias("n_parts"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))
        .select("batch", batch_date_col("batch").alias("batch_date"), "table_name", "n_parts", "bytes", "newest")
    )


def manifest_frame(spark: SparkSession, root: str, sep: str = "|") -> DataFrame:
    """Records per batch and table, computed by one distributed scan.

    Columns: ``batch, batch_date, table_name, n_records``.  Blank lines are
    not records (the CSV reader skips them, as the loads do).
    """
    scan = (
        spark.read.schema("_c0 string")
        .option("sep", sep)
        .option("header", "false")
        .option("pathGlobFilter", PART_GLOB)
        .option("recursiveFileLookup", "true")
        .csv(f"{root.rstrip('/')}/{BATCH_PREFIX}*/*")
    )
    # URL-encoded, but for the plus sign, which stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return (
        scan.select(*_located(root, path)).groupBy("batch", "table_name")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .select("batch", batch_date_col("batch").alias("batch_date"), "table_name", "n_records")
    )
