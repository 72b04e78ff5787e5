"""A store whose tables are laid out in Spark partitions, so a load touches few of them.

SCD tables are bucketed by a hash of the key::

    <root>/<table>/seq=<n>/kind=open/_bucket=<k>/...      open versions of bucket k, written by commit n
    <root>/<table>/seq=<n>/kind=closed/end_date=<d>/...   versions that commit n closed

A commit records, beside what :class:`LakeStore` records, which ``seq`` holds each
bucket.  A strict merge reads the buckets its source's keys fall into and writes
those that changed; the others stay where they are.  Every open row carries the
digest of its change columns, so change detection reads keys and digests only.

Appended tables are partitioned by ``batched_at`` (and by batch, as a day may have
several) and written by Spark's dynamic partition overwrite: a batch replaces its
own rows and no others::

    <root>/<table>/rows/batched_at=<d>/_batch=<name>/...

Readers see the batches that are recorded.  A retry of a recorded batch replaces its
rows in place, so readers of that one batch should wait for it.

Full and truncate loads, and compat merges (which may reopen any row and so rewrite
whole tables), are those of :class:`LakeStore`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, IntegerType, StringType, StructField, StructType

from .. import fs
from ..functions.stamps import token_of
from ..specs import BATCHED_AT, END_DATE
from .lake import APPEND, SCD, SEQ, Commit, LakeStore, Pending

BUCKET, DIGEST, KIND, BATCH = "_bucket", "_digest", "kind", "_batch"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(F.col("`" + key.replace("`", "``") + "`")), F.lit(buckets))


class PartitionedStore(LakeStore):
    """``buckets``: of a table's open set, kept for the table's life.  Choose it so
    that a bucket is a few hundred MB; it also bounds what a commit records."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, retain_versions: int | None = None):
        super().__init__(spark, root, retain_versions)
        if buckets < 1:
            raise ValueError("buckets must be at least 1")
        self.buckets = buckets

    # -------------------------------------------------------------- reads
    def _part(self, commit: Commit, paths: list[str], added: list[StructField]) -> DataFrame:
        base = self.table_path(commit.table)
        fields = [f for f in commit.schema.fields if f.name != END_DATE] + added
        parts = [StructField(SEQ, IntegerType()), StructField(KIND, StringType())]
        reader = self.spark.read.schema(StructType(fields + parts)).option("basePath", base)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], StructType(fields))

    def open_rows(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Open versions of a bucketed table with ``_bucket`` and ``_digest``, of some ``buckets`` only."""
        head = self._require(table)
        base, wanted = self.table_path(table), range(len(head.open_seqs)) if buckets is None else buckets
        paths = [f"{base}/{SEQ}={head.open_seqs[k]}/{KIND}=open/{BUCKET}={k}" for k in sorted(wanted) if head.open_seqs[k]]
        df = self._part(head, paths, [StructField(DIGEST, BinaryType()), StructField(BUCKET, IntegerType())])
        return df.withColumn(END_DATE, F.lit(None).cast("date")).select(*head.schema.fieldNames(), BUCKET, DIGEST)

    def read_open(self, table: str) -> DataFrame:
        head = self._require(table)
        if not head.open_seqs:
            return super().read_open(table)
        return self.open_rows(table).select(*head.schema.fieldNames())

    def _closed(self, head: Commit) -> DataFrame:
        # the first of a table's commits opened its rows and closed none
        paths = [f"{self.table_path(head.table)}/{SEQ}={k}/{KIND}=closed" for k in head.seqs[1:]]
        return self._part(head, paths, [StructField(END_DATE, DateType())]).select(*head.schema.fieldNames())

    def read(self, table: str) -> DataFrame:
        head = self._require(table)
        if head.open_seqs:
            return self._closed(head).unionByName(self.read_open(table))
        if head.kind == APPEND:
            schema = StructType([*head.schema.fields, StructField(BATCH, StringType())])
            rows = self.spark.read.schema(schema).parquet(f"{self.table_path(table)}/rows")
            return rows.where(F.col(BATCH).isin(sorted(set(map(token_of, head.dates))))).select(*head.schema.fieldNames())
        return super().read(table)

    def read_closed(self, table: str) -> DataFrame:
        head = self._require(table)
        return self._closed(head) if head.open_seqs else super().read_closed(table)

    # ------------------------------------------------------------- writes
    def stage(self, table: str, df: DataFrame, kind: str, batch_date: dt.date | None, keep_history: bool = False) -> Pending:
        if kind != APPEND:
            return super().stage(table, df, kind, batch_date, keep_history)
        seq, head = self._claim(table)
        path = f"{self.table_path(table)}/rows"
        named = df.withColumn(BATCH, F.lit(token_of(batch_date)))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCHED_AT, BATCH).parquet(path)
        return Pending(table, seq, kind, batch_date, path, df.schema, head.version if head else 0)

    def stage_open(self, table: str, rows: DataFrame, batch_date: dt.date, touched: Sequence[int] | None, closed: DataFrame | None = None) -> Pending:
        """Write the whole new content of the ``touched`` buckets (None: of all, a
        first load) and the versions closed.  ``rows`` has ``_bucket`` and ``_digest``."""
        seq, head = self._claim(table)
        path = f"{self.table_path(table)}/{SEQ}={seq}"
        before = head.open_seqs if head and touched is not None else (0,) * self.buckets
        schema = rows.drop(BUCKET, DIGEST).schema
        rows.drop(END_DATE).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{KIND}=open")
        if closed is not None:
            folder = f"{path}/{KIND}=closed/{END_DATE}={batch_date.isoformat()}"
            closed.drop(END_DATE, BUCKET, DIGEST).write.mode("overwrite").parquet(folder)
        if touched is None:  # buckets without a row have no folder
            touched = [int(e.name.split("=")[1]) for e in fs.ls(self.spark, f"{path}/{KIND}=open") if e.name.startswith(f"{BUCKET}=")]
        now = tuple(seq if k in set(touched) else s for k, s in enumerate(before))
        return Pending(table, seq, SCD, batch_date, path, schema, head.version if head else 0, now)

    def stage_nothing(self, table: str, batch_date: dt.date) -> Pending:
        """A commit that only records its batch: no row is read or written."""
        head = self._require(table)
        return Pending(table, head.seq, SCD, batch_date, "", head.schema, head.version, head.open_seqs)

    def vacuum(self, table: str, retain: int = 1) -> list[str]:
        """As :meth:`LakeStore.vacuum`; of bucketed tables, the open buckets that the
        newest ``retain`` versions do not read.  Appended rows are all read."""
        head = self.head(table)
        if head is None or head.kind == APPEND:
            return []
        if not head.open_seqs:
            return super().vacuum(table, retain)
        records = self._records(table)
        kept = [Commit.from_json(fs.read_text(self.spark, p)) for _, p in records[-retain:]]
        if not all(c.open_seqs for c in kept):
            return []
        live = {(s, k) for c in kept for k, s in enumerate(c.open_seqs)}
        removed = []
        for e in fs.ls(self.spark, self.table_path(table)):
            if not e.name.startswith(f"{SEQ}="):
                continue
            seq = int(e.name.split("=")[1])
            for b in fs.ls(self.spark, f"{e.path}/{KIND}=open") if seq <= head.seq else []:
                if b.name.startswith(f"{BUCKET}=") and (seq, int(b.name.split("=")[1])) not in live:
                    fs.delete(self.spark, b.path)
                    removed.append(b.path)
        return removed


def with_layout(df: DataFrame, key: str, buckets: int, digest: Column) -> DataFrame:
    return df.withColumns({BUCKET: bucket_of(key, buckets), DIGEST: digest})


def aligned(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Shuffled by key into a multiple of ``buckets`` partitions, so each holds rows
    of one bucket (Spark deals rows by the same hash) and writes one file."""
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(buckets * -(-parallel // buckets), F.col("`" + key.replace("`", "``") + "`"))

