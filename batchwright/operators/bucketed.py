"""Strict SCD2 merge of bucketed tables: only what a batch touches is read and written.

1. The source is collapsed to one row a key, combined map-side, and staged once
   with its bucket and the digest of its change columns.  A key that occurs twice
   fails here: no join ever holds more than one row of a key.
2. Probe: keys and digests of the source against those of the open rows, in the
   source's buckets.  What has no equal is a change, and is staged.
3. The buckets of the changes are written anew: their other rows as they are, the
   changes as open versions; the versions that the changes replace are closed.

A batch without changes writes no row.  The joins of 2 and 3 stream the open rows
against a broadcast where a measured bound allows it; beyond it both sides are
shuffled by key, the open rows into partitions that hold one bucket each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import fs
from ..functions.digest import row_digest
from ..functions.stamps import date_lit, with_scd_columns
from ..session import scratch_dir
from ..sinks.partitioned import BUCKET, DIGEST, PartitionedStore, aligned, with_layout
from ..specs import END_DATE, TableSpec
from . import scd2


def applies(store, spec: TableSpec) -> bool:
    """Whether ``spec``'s table is, or will be, a bucketed one (strict mode)."""
    if not isinstance(store, PartitionedStore):
        return False
    head = store.head(spec.target)
    return head is None or bool(head.open_seqs)


def _laid_out(store: PartitionedStore, spec: TableSpec, df: DataFrame, buckets: int) -> DataFrame:
    return with_layout(df, spec.primary_key, buckets, row_digest(df.schema, spec.change_columns))


def first_load(store: PartitionedStore, spec: TableSpec, source: DataFrame, bdate: dt.date) -> dict:
    """All rows as open versions, NULL keys included; a key twice is an error."""
    src = source.select(*spec.columns)
    df = with_scd_columns(src, bdate)
    df = df.union(scd2.duplicate_key_guard(src, spec.primary_key, df.schema))
    rows = aligned(_laid_out(store, spec, df, store.buckets), spec.primary_key, store.buckets)
    obs = Observation(f"{spec.target}-open")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"), scd2.null_key_count(rows, spec.primary_key).alias("null_keys"))
    pending = store.stage_open(spec.target, rows, bdate, None)
    metrics = {k: int(v or 0) for k, v in obs.get.items()}
    store.publish(pending, metrics=metrics)
    return metrics


def probe(staged: DataFrame, current: DataFrame, key: str, small: bool) -> DataFrame:
    """Staged source rows without an open version of the same key and digest.

    ``small``: keys and digests of the source are under the broadcast bound.  The
    open rows then stream past them and only equal keys, at most the source's, come
    back; otherwise both sides are shuffled, two columns of the open one."""
    current = current.select(key, DIGEST)
    if small:
        same = current.join(F.broadcast(staged.select(key, DIGEST)), [key, DIGEST], "left_semi").select(key)
        return staged.join(F.broadcast(same), key, "left_anti").select(*staged.columns)
    return staged.join(current.hint("merge"), [key, DIGEST], "left_anti").select(*staged.columns)


def merged(current: DataFrame, changed: DataFrame, key: str, batch_date: dt.date, buckets: int, small: bool) -> tuple[DataFrame, DataFrame]:
    """``(open rows after the batch, versions it closes)`` of the touched buckets."""
    keys = changed.select(key)
    if small:
        keys, held = F.broadcast(keys), current
    else:
        keys, held = keys.hint("merge"), aligned(current, key, buckets)
    opened = with_scd_columns(changed, batch_date).select(*current.columns)
    opened = opened.repartition(F.col(BUCKET)) if small else aligned(opened, key, buckets)
    kept = held.join(keys, key, "left_anti").select(*current.columns)
    closed = current.join(keys, key, "left_semi").withColumn(END_DATE, date_lit(batch_date))
    return kept.unionByName(opened), closed


def _distinct_buckets(df: DataFrame) -> list[int]:
    return [r[0] for r in df.select(BUCKET).distinct().collect()]  # at most the table's buckets


def _staged(df: DataFrame, path: str, name: str, *metrics) -> tuple[DataFrame, dict]:
    obs = Observation(name)
    df.observe(obs, *metrics).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), {k: int(v or 0) for k, v in obs.get.items()}


def merge(store: PartitionedStore, spec: TableSpec, source: DataFrame, bdate: dt.date) -> dict:
    """One batch; metrics ``inserted, closed, null_keys, buckets_read, buckets_written``."""
    key, target = spec.primary_key, spec.target
    head = store._require(target)
    buckets = len(head.open_seqs)
    scratch = scratch_dir(store.spark, f"merge-{target}")
    try:
        one = scd2.one_row_per_key(source.select(*spec.columns), key, count="_rows")
        rows, counted = _staged(
            _laid_out(store, spec, one, buckets),
            f"{scratch}/source",
            f"{target}-source",
            F.sum(F.when(F.col(key).isNull(), F.col("_rows"))).alias("null_keys"),
        )
        rows = rows.where(F.col(key).isNotNull()).drop("_rows")
        asked = _distinct_buckets(rows)
        small = scd2.fits_broadcast(rows.select(key, DIGEST))
        changes = probe(rows, store.open_rows(target, asked), key, small)
        changes, found = _staged(changes, f"{scratch}/changes", f"{target}-changes", F.count(F.lit(1)).alias("inserted"))
        metrics = {**found, "closed": 0, "null_keys": counted["null_keys"], "buckets_read": len(asked), "buckets_written": 0}
        if not found["inserted"]:
            store.publish(store.stage_nothing(target, bdate), keep_history=True, metrics=metrics)
            return metrics
        touched = _distinct_buckets(changes)
        current = store.open_rows(target, touched)
        rows, closed = merged(current, changes, key, bdate, buckets, scd2.fits_broadcast(changes.select(key)))
        obs = Observation(f"{target}-closed")
        pending = store.stage_open(target, rows, bdate, touched, closed.observe(obs, F.count(F.lit(1)).alias("closed")))
        metrics |= {"closed": int(obs.get["closed"] or 0), "buckets_written": len(touched)}
        store.publish(pending, keep_history=True, metrics=metrics)
        return metrics
    finally:
        fs.delete(store.spark, scratch)  # read only by this merge
