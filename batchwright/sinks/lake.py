"""Versioned Parquet tables with commit records (the default target).

Layout of one table::

    <root>/<table>/seq=<n>/...                 data written by commit n
    <root>/<table>/_claims/<n>                 taken by the attempt that writes seq=<n>
    <root>/<table>/_commits/<version>.json     commit record, written last

A commit's data folder is written first and the record after it, so a crash
leaves at most an unreferenced folder; readers only follow records.  Every
attempt claims a ``seq`` of its own, so writers never share a folder, and a
version's record is created without overwriting, so of several writers on one
version exactly one wins and the others raise.  Three kinds of commit:

* ``snapshot``: ``seq=<n>`` holds the whole table (full and truncate loads).
* ``append``: ``seq=<n>`` holds the rows added by one batch; the table is
  every published ``seq`` of the newest record.
* ``scd``: ``seq=<n>`` is partitioned by ``end_date``.  Its NULL partition is
  the complete set of open versions; its dated partition holds the versions
  closed by this commit.  The table is the newest open set plus the closed
  partitions of every published ``seq``.  A strict merge therefore rewrites
  only the open versions; closed history is written once and never again.

Nothing is overwritten in place: a table derived from itself is written to a
new ``seq`` folder and published by its record.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .. import fs
from ..functions.stamps import parse_batch_date, token_of
from ..specs import END_DATE

SNAPSHOT = "snapshot"
APPEND = "append"
SCD = "scd"
SEQ = "seq"


@dataclass(frozen=True)
class Commit:
    table: str
    seq: int
    kind: str
    batch_date: dt.date | None
    schema: StructType
    version: int
    #: data folders that make up the table, oldest first
    seqs: tuple[int, ...]
    #: batches of this and all earlier versions (dates that know their batch)
    dates: tuple[dt.date, ...] = ()
    metrics: dict = field(default_factory=dict)
    #: of a bucketed table, the data folder that holds each bucket's open rows (0: none)
    open_seqs: tuple[int, ...] = ()

    @property
    def read_from(self) -> int:
        return self.seqs[0]

    def to_json(self) -> str:
        return json.dumps(
            {
                "table": self.table,
                "seq": self.seq,
                "kind": self.kind,
                "batch_date": token_of(self.batch_date) if self.batch_date else None,
                "version": self.version,
                "seqs": list(self.seqs),
                "dates": [token_of(d) for d in self.dates],
                "schema": json.loads(self.schema.json()),
                "metrics": self.metrics,
                **({"open_seqs": list(self.open_seqs)} if self.open_seqs else {}),
            },
            sort_keys=True,
        )

    @staticmethod
    def from_json(text: str) -> Commit:
        d = json.loads(text)
        return Commit(
            table=d["table"],
            seq=int(d["seq"]),
            kind=d["kind"],
            batch_date=parse_batch_date(d["batch_date"]) if d["batch_date"] else None,
            schema=StructType.fromJson(d["schema"]),
            version=int(d["version"]),
            seqs=tuple(d["seqs"]),
            dates=tuple(parse_batch_date(x) for x in d["dates"]),
            metrics=d.get("metrics", {}),
            open_seqs=tuple(d.get("open_seqs", ())),
        )


@dataclass(frozen=True)
class Pending:
    """Data written for a commit that is not published yet."""

    table: str
    seq: int
    kind: str
    batch_date: dt.date | None
    path: str
    schema: StructType
    #: version that the data was made from (0: none)
    base: int = 0
    #: of a bucketed table, the folder of each bucket after this commit
    open_seqs: tuple[int, ...] = ()


class LakeStore:
    """Tables under one root folder (a shared file system or object store)."""

    def __init__(self, spark: SparkSession, root: str, retain_versions: int | None = None, compression: str | None = None):
        """``retain_versions`` (off by default, so every version stays
        readable) vacuums after each publish whatever the newest N versions
        do not read.  A strict SCD merge writes a whole new open set, so
        without it each batch keeps one more copy of the open set.  Use
        N >= 2 when readers may still be on the previous version.
        ``compression`` is the Parquet codec of the data; the session's by default."""
        if retain_versions is not None and retain_versions < 1:
            raise ValueError("retain_versions must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.retain_versions = retain_versions
        self.compression = compression

    # ----------------------------------------------------------- metadata
    def table_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _commit_dir(self, table: str) -> str:
        return f"{self.table_path(table)}/_commits"

    def _records(self, table: str) -> list[tuple[int, str]]:
        found = fs.ls(self.spark, self._commit_dir(table))
        return sorted((int(e.name[:-5]), e.path) for e in found if e.name.endswith(".json") and e.name[:-5].isdigit())

    def _record_path(self, table: str, version: int) -> str:
        return f"{self._commit_dir(table)}/{version:010d}.json"

    def _claim(self, table: str) -> tuple[int, Commit | None]:
        """A ``seq`` that no other attempt has or gets, and the head it builds on."""
        folder = f"{self.table_path(table)}/_claims"
        while True:
            head = self.head(table)
            taken = [int(e.name) for e in fs.ls(self.spark, folder) if e.name.isdigit()]
            seq = 1 + max([head.seq if head else 0, *taken])
            if fs.create_new(self.spark, f"{folder}/{seq:010d}", ""):
                return seq, head

    def head(self, table: str) -> Commit | None:
        records = self._records(table)
        if not records:
            return None
        return Commit.from_json(fs.read_text(self.spark, records[-1][1]))

    def exists(self, table: str) -> bool:
        return bool(self._records(table))

    def tables(self) -> list[str]:
        return [e.name for e in fs.ls(self.spark, self.root) if e.is_dir and self.exists(e.name)]

    def batch_dates(self, table: str) -> list[dt.date]:
        head = self.head(table)
        return [d for _, d in sorted({token_of(d): d for d in head.dates}.items())] if head else []

    def has_batch(self, table: str, batch_date: dt.date) -> bool:
        return token_of(batch_date) in map(token_of, self.batch_dates(table))

    def batch_mark(self, table: str) -> dt.date | None:
        """Newest batch committed to ``table`` (from records, no scan)."""
        dates = self.batch_dates(table)
        return dates[-1] if dates else None

    # -------------------------------------------------------------- reads
    def _scan(self, head: Commit, seqs: list[int]) -> DataFrame:
        base = self.table_path(head.table)
        schema = StructType(list(head.schema.fields) + [StructField(SEQ, IntegerType())])
        paths = [f"{base}/{SEQ}={k}" for k in seqs]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def read(self, table: str) -> DataFrame:
        """The table as of its newest commit."""
        head = self._require(table)
        cols = head.schema.fieldNames()
        if head.kind == SNAPSHOT:
            return self._scan(head, [head.seq]).select(*cols)
        df = self._scan(head, list(head.seqs))
        if head.kind == SCD:
            df = df.where((F.col(SEQ) == head.seq) | F.col(END_DATE).isNotNull())
        return df.select(*cols)

    def read_open(self, table: str) -> DataFrame:
        """Open versions (``end_date IS NULL``) of an SCD table: one folder."""
        head = self._require(table)
        if head.kind != SCD:
            return self.read(table).where(F.col(END_DATE).isNull())
        return self._scan(head, [head.seq]).where(F.col(END_DATE).isNull()).select(*head.schema.fieldNames())

    def read_closed(self, table: str) -> DataFrame:
        head = self._require(table)
        return self.read(table).where(F.col(END_DATE).isNotNull())

    def _require(self, table: str) -> Commit:
        head = self.head(table)
        if head is None:
            raise FileNotFoundError(f"table {table!r} has no commit under {self.root}")
        return head

    # ------------------------------------------------------------- writes
    def stage(self, table: str, df: DataFrame, kind: str, batch_date: dt.date | None, keep_history: bool = False) -> Pending:
        """Write ``df`` as the data of the next commit (not yet visible)."""
        seq, head = self._claim(table)
        path = f"{self.table_path(table)}/{SEQ}={seq}"
        if "_op" in df.columns:  # merge bookkeeping, not data
            df = df.drop("_op")
        writer = df.write.mode("overwrite")
        if self.compression:
            writer = writer.option("compression", self.compression)
        if kind == SCD:
            writer = writer.partitionBy(END_DATE)
        writer.parquet(path)
        return Pending(table, seq, kind, batch_date, path, df.schema, head.version if head else 0)

    def publish(self, pending: Pending, keep_history: bool = False, metrics: dict | None = None) -> Commit:
        """Make staged data the table's newest version.

        ``keep_history`` (append and strict SCD) keeps reading the earlier
        commits from the current ``read_from``; otherwise the new commit
        replaces everything before it.  Raises when another writer has
        published since the data was staged.
        """
        head, version = self.head(pending.table), pending.base + 1
        stale = f"{pending.table}: staged on version {pending.base}, which is no longer the newest"
        if (head.version if head else 0) != pending.base:
            raise RuntimeError(stale)
        commit = Commit(
            pending.table,
            pending.seq,
            pending.kind,
            pending.batch_date,
            pending.schema,
            version,
            (*(head.seqs if head and keep_history else ()), *([pending.seq] if pending.path else [])),
            (*(head.dates if head else ()), *([pending.batch_date] if pending.batch_date else [])),
            metrics or {},
            pending.open_seqs,
        )
        if not fs.create_new(self.spark, self._record_path(pending.table, version), commit.to_json()):
            raise RuntimeError(stale)
        if self.retain_versions is not None:
            self.vacuum(pending.table, self.retain_versions)
        return commit

    def discard(self, pending: Pending) -> None:
        fs.delete(self.spark, pending.path)

    def vacuum(self, table: str, retain: int = 1) -> list[str]:
        """Delete data no longer read by the newest ``retain`` versions."""
        head = self.head(table)
        if head is None:
            return []
        records = self._records(table)
        kept = [Commit.from_json(fs.read_text(self.spark, p)) for _, p in records[-retain:]]
        keep_from, floor = kept[0].seq, min(c.read_from for c in kept)
        removed = []
        for e in fs.ls(self.spark, self.table_path(table)):
            if not e.name.startswith(f"{SEQ}="):
                continue
            k = int(e.name.split("=", 1)[1])
            if k < floor:
                fs.delete(self.spark, e.path)
                removed.append(e.path)
            elif head.kind == SCD and k < keep_from:
                open_part = f"{e.path}/{END_DATE}=__HIVE_DEFAULT_PARTITION__"
                if fs.exists(self.spark, open_part):
                    fs.delete(self.spark, open_part)
                    removed.append(open_part)
        return removed
