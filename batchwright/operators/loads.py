"""Load strategies: one table, one batch, one commit.

Every function computes the table's new content as a DataFrame, stages it in
the store and publishes it.  Row counts come from ``DataFrame.observe`` on
the write itself, so no strategy scans its input twice for a report.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.stamps import parse_batch_date, with_batch_stamp, with_scd_columns
from .. import fs
from ..session import scratch_dir
from ..specs import APPEND, FULL, SCD, TRUNCATE, TableSpec
from . import bucketed, scd2
from ..sinks import lake


@dataclass
class LoadResult:
    table: str
    strategy: str
    action: str
    batch_date: dt.date | None
    metrics: dict = field(default_factory=dict)
    seconds: float | None = None


def _observed(df: DataFrame, name: str, *metrics) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


def _publish(store, spec: TableSpec, df: DataFrame, kind: str, bdate, keep_history: bool, metrics_cols) -> dict:
    df, obs = _observed(df, f"{spec.target}-{kind}", *metrics_cols)
    pending = store.stage(spec.target, df, kind, bdate, keep_history=keep_history)
    metrics = {k: (int(v) if v is not None else 0) for k, v in obs.get.items()}
    store.publish(pending, keep_history=keep_history, metrics=metrics)
    return metrics


def _rows():
    return F.count(F.lit(1)).alias("rows")


def full_load(store, spec: TableSpec, source: DataFrame) -> LoadResult:
    """One-time load: the file as it is, replacing the target."""
    m = _publish(store, spec, source.select(*spec.columns), lake.SNAPSHOT, None, False, [_rows()])
    return LoadResult(spec.target, FULL, "full_load", None, m)


def first_load(store, spec: TableSpec, source: DataFrame, batch: str | dt.date, mode: str = scd2.STRICT) -> LoadResult:
    """First batch of a table: open SCD versions, or batch-stamped rows.

    In strict mode an SCD table starts with at most one version per key: a
    key twice in the first batch fails the load, as it would in a merge."""
    bdate = parse_batch_date(batch)
    src = source.select(*spec.columns)
    if spec.load == SCD and mode == scd2.STRICT and bucketed.applies(store, spec):
        m = bucketed.first_load(store, spec, src, bdate)
    elif spec.load == SCD:
        df = with_scd_columns(src, bdate)
        if mode == scd2.STRICT:
            df = df.union(scd2.duplicate_key_guard(src, spec.primary_key, df.schema))
        m = _publish(store, spec, df, lake.SCD, bdate, False, [_rows(), scd2.null_key_count(df, spec.primary_key).alias("null_keys")])
    elif spec.load == APPEND:
        m = _publish(store, spec, with_batch_stamp(src, bdate), lake.APPEND, bdate, False, [_rows()])
    else:
        m = _publish(store, spec, with_batch_stamp(src, bdate), lake.SNAPSHOT, bdate, False, [_rows()])
    return LoadResult(spec.target, spec.load, "first_load", bdate, m)


def truncate_load(store, spec: TableSpec, source: DataFrame, batch: str | dt.date) -> LoadResult:
    """Replace every row with the batch's rows, stamped with the batch date."""
    bdate = parse_batch_date(batch)
    df = with_batch_stamp(source.select(*spec.columns), bdate)
    m = _publish(store, spec, df, lake.SNAPSHOT, bdate, False, [_rows()])
    return LoadResult(spec.target, TRUNCATE, "truncate_load", bdate, m)


def append_load(store, spec: TableSpec, source: DataFrame, batch: str | dt.date) -> LoadResult:
    """Add the batch's rows, stamped; a rerun of the batch replaces them."""
    bdate = parse_batch_date(batch)
    df = with_batch_stamp(source.select(*spec.columns), bdate)
    m = _publish(store, spec, df, lake.APPEND, bdate, store.exists(spec.target), [_rows()])
    return LoadResult(spec.target, APPEND, "append", bdate, m)


def scd_load(store, spec: TableSpec, source: DataFrame, batch: str | dt.date, mode: str = scd2.STRICT) -> LoadResult:
    """SCD2 merge of one batch; one that changes nothing is recorded with the same rows."""
    bdate = parse_batch_date(batch)
    key, cols = spec.primary_key, list(spec.change_columns)
    src = source.select(*spec.columns)
    if mode == scd2.STRICT and bucketed.applies(store, spec):
        m = bucketed.merge(store, spec, src, bdate)
        return LoadResult(spec.target, SCD, "scd2_strict" if m["inserted"] else "no_change", bdate, m)
    if mode == scd2.STRICT:
        changes = scd2.scd2_strict_changes(src, store.read_open(spec.target), key, cols, bdate, keep_null_keys=True)
        changes, obs = _observed(
            changes,
            f"{spec.target}-scd",
            F.count_if(F.col(scd2.OP) == scd2.OP_INSERT).alias("inserted"),
            F.count_if(F.col(scd2.OP) == scd2.OP_CLOSE).alias("closed"),
            F.count_if(F.col(scd2.OP) == scd2.OP_KEEP).alias("kept"),
            F.count_if(F.col(scd2.OP) == scd2.OP_NULL_KEY).alias("null_keys"),
        )
        # ``_op`` stays: a store may publish only the delta (close / insert)
        changes = changes.where(F.col(scd2.OP) != scd2.OP_NULL_KEY)
        pending = store.stage(spec.target, changes, lake.SCD, bdate, keep_history=True)
        m = {k: int(v or 0) for k, v in obs.get.items()}
        if m["inserted"] == 0:
            # the same rows under the new batch's date, so a rerun knows this batch
            store.publish(pending, keep_history=True, metrics=m)
            return LoadResult(spec.target, SCD, "no_change", bdate, m)
        store.publish(pending, keep_history=True, metrics=m)
        return LoadResult(spec.target, SCD, "scd2_strict", bdate, m)

    # compat: stage the changed rows once; they decide the no-op and feed the
    # merge, so the join that finds them is not planned twice.
    target = store.read(spec.target)
    changed = scd2.changed_rows(src, target, key, cols, scd2.COMPAT)
    # NULL-key rows ride along to be counted in the same write, then dropped
    tagged = changed.withColumn("_null_key", F.lit(False)).unionByName(
        src.where(F.col(key).isNull()).withColumn("_null_key", F.lit(True))
    )
    tagged, nobs = _observed(
        tagged,
        f"{spec.target}-changed",
        F.count_if(F.col("_null_key")).alias("null_keys"),
        F.count_if(~F.col("_null_key")).alias("changed"),
    )
    scratch = scratch_dir(store.spark, f"changed-{spec.target}")
    try:
        path = f"{scratch}/rows"
        tagged.where(~F.col("_null_key")).drop("_null_key").write.mode("overwrite").parquet(path)
        counts = {k: int(v or 0) for k, v in nobs.get.items()}
        null_keys = counts["null_keys"]
        if counts["changed"] == 0:  # counted by the staging write: no extra job
            _publish(store, spec, target, lake.SCD, bdate, False, [_rows()])  # records the batch
            return LoadResult(spec.target, SCD, "no_change", bdate, {"inserted": 0, "null_keys": null_keys})
        staged = store.spark.read.schema(changed.schema).parquet(path)
        out = scd2.scd2_compat(src, target, key, cols, bdate, changed=staged, changed_count=counts["changed"])
        m = _publish(
            store,
            spec,
            out,
            lake.SCD,
            bdate,
            False,
            [_rows(), F.count_if(F.col("end_date").isNotNull()).alias("closed"), F.count_if(F.col("start_date") == F.lit(bdate)).alias("inserted")],
        )
    finally:
        fs.delete(store.spark, scratch)  # the staged change set lives only for this load
    m["null_keys"] = null_keys
    return LoadResult(spec.target, SCD, "scd2_compat", bdate, m)


def incremental_load(store, spec: TableSpec, source: DataFrame, batch: str | dt.date, mode: str = scd2.STRICT) -> LoadResult:
    """The table's own strategy for a batch after its first one."""
    if spec.load == SCD:
        return scd_load(store, spec, source, batch, mode)
    if spec.load == TRUNCATE:
        return truncate_load(store, spec, source, batch)
    if spec.load == APPEND:
        return append_load(store, spec, source, batch)
    if spec.load == FULL:
        return truncate_load(store, spec, source, batch)
    raise ValueError(f"{spec.name}: unknown strategy {spec.load!r}")
