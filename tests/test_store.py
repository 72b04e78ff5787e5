"""Versioned Parquet store: commits, layouts, staging, vacuum."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from batchwright.plans.catalog import view_sql
from batchwright.sinks import LakeStore
from batchwright.sinks.lake import APPEND, SCD, SNAPSHOT

D1, D2, D3 = dt.date(2022, 11, 1), dt.date(2022, 11, 2), dt.date(2022, 11, 3)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_snapshot_versions(spark, ws):
    store = LakeStore(spark, ws)
    a = spark.createDataFrame([(1, "a")], "k int, s string")
    b = spark.createDataFrame([(2, "b"), (3, "c")], "k int, s string")
    store.publish(store.stage("t", a, SNAPSHOT, D1))
    store.publish(store.stage("t", b, SNAPSHOT, D2))
    assert _rows(store.read("t")) == [(2, "b"), (3, "c")]
    assert store.batch_mark("t") == D2 and store.has_batch("t", D1)
    assert store.tables() == ["t"]


def test_uncommitted_data_is_invisible_and_overwritten(spark, ws):
    store = LakeStore(spark, ws)
    a = spark.createDataFrame([(1,)], "k int")
    store.publish(store.stage("t", a, SNAPSHOT, D1))
    store.stage("t", spark.createDataFrame([(9,)], "k int"), SNAPSHOT, D2)  # crash before publish
    assert _rows(store.read("t")) == [(1,)]
    p = store.stage("t", spark.createDataFrame([(2,)], "k int"), SNAPSHOT, D2)  # retry
    store.publish(p)
    assert _rows(store.read("t")) == [(2,)]


def test_stale_publish_rejected(spark, ws):
    store = LakeStore(spark, ws)
    df = spark.createDataFrame([(1,)], "k int")
    p1 = store.stage("t", df, SNAPSHOT, D1)
    p2 = store.stage("t", df, SNAPSHOT, D1)
    store.publish(p2)
    with pytest.raises(RuntimeError):
        store.publish(p1)


def test_append_reads_all_commits(spark, ws):
    store = LakeStore(spark, ws)
    for i, d in enumerate((D1, D2, D3)):
        df = spark.createDataFrame([(i, d)], "k int, batched_at date")
        store.publish(store.stage("f", df, APPEND, d), keep_history=i > 0)
    assert [r.k for r in store.read("f").orderBy("k").collect()] == [0, 1, 2]


def test_scd_layout_reads_open_and_closed(spark, ws):
    store = LakeStore(spark, ws)
    schema = "k int, v string, start_date date, end_date date"
    first = spark.createDataFrame([(1, "a", D1, None), (2, "b", D1, None)], schema)
    store.publish(store.stage("d", first, SCD, D1))
    # strict commit: open set after the batch plus the version it closes
    second = spark.createDataFrame([(1, "a", D1, D2), (1, "x", D2, None), (2, "b", D1, None)], schema)
    store.publish(store.stage("d", second, SCD, D2), keep_history=True)
    third = spark.createDataFrame([(1, "x", D2, D3), (1, "y", D3, None), (2, "b", D1, None)], schema)
    store.publish(store.stage("d", third, SCD, D3), keep_history=True)
    assert _rows(store.read("d")) == [(1, "a", D1, D2), (1, "x", D2, D3), (1, "y", D3, None), (2, "b", D1, None)]
    assert _rows(store.read_open("d")) == [(1, "y", D3, None), (2, "b", D1, None)]
    # the open set is read from one folder; closed history is not scanned
    files = store.read_open("d").inputFiles()
    assert files and all("/seq=3/" in f for f in files)
    plan = store.read_open("d")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnull(end_date" in plan
    removed = store.vacuum("d", retain=1)
    assert any("seq=2" in r for r in removed)
    assert _rows(store.read("d")) == [(1, "a", D1, D2), (1, "x", D2, D3), (1, "y", D3, None), (2, "b", D1, None)]


def test_self_derived_rewrite_keeps_rows(spark, ws):
    """A table rewritten from itself goes to a new folder, never in place."""
    store = LakeStore(spark, ws)
    store.publish(store.stage("t", spark.range(5).withColumn("v", F.lit(1)), SNAPSHOT, D1))
    new = store.read("t").withColumn("v", F.col("v") + 1).unionByName(spark.range(5, 6).withColumn("v", F.lit(1)))
    store.publish(store.stage("t", new, SNAPSHOT, D2))
    assert store.read("t").count() == 6
    assert sorted(r.v for r in store.read("t").collect()) == [1, 2, 2, 2, 2, 2]


def test_missing_table(spark, ws):
    with pytest.raises(FileNotFoundError):
        LakeStore(spark, ws).read("nope")


def test_retained_versions_vacuum_on_publish(spark, ws):
    store = LakeStore(spark, ws, retain_versions=2)
    schema = "k int, v string, start_date date, end_date date"
    store.publish(store.stage("d", spark.createDataFrame([(1, "a", D1, None), (2, "b", D1, None)], schema), SCD, D1))
    second = spark.createDataFrame([(1, "a", D1, D2), (1, "x", D2, None), (2, "b", D1, None)], schema)
    store.publish(store.stage("d", second, SCD, D2), keep_history=True)
    third = spark.createDataFrame([(1, "x", D2, D3), (1, "y", D3, None), (2, "b", D1, None)], schema)
    store.publish(store.stage("d", third, SCD, D3), keep_history=True)
    # the open set of commit 1 is gone; commits 2 and 3 stay whole
    import os

    local = ws.replace("file:", "", 1)
    assert not os.path.exists(f"{local}/d/seq=1/end_date=__HIVE_DEFAULT_PARTITION__")
    assert os.path.exists(f"{local}/d/seq=2/end_date=__HIVE_DEFAULT_PARTITION__")
    assert _rows(store.read("d")) == [(1, "a", D1, D2), (1, "x", D2, D3), (1, "y", D3, None), (2, "b", D1, None)]
    with pytest.raises(ValueError):
        LakeStore(spark, ws, retain_versions=0)


def test_one_of_two_writers_wins(spark, ws):
    """Two writers on one version: separate folders, one record, one error."""
    from concurrent.futures import ThreadPoolExecutor

    store = LakeStore(spark, ws)
    store.publish(store.stage("t", spark.createDataFrame([(0,)], "k int"), APPEND, D1))
    pending = [store.stage("t", spark.createDataFrame([(i,)], "k int"), APPEND, D2) for i in (1, 2)]
    assert len({p.path for p in pending}) == 2

    def publish(p):
        try:
            return store.publish(p, keep_history=True)
        except RuntimeError as e:
            return e

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(publish, pending))
    won = [i for i, r in enumerate(done, 1) if not isinstance(r, Exception)]
    assert len(won) == 1
    assert _rows(store.read("t")) == [(0,), (won[0],)]
    assert store.batch_dates("t") == [D1, D2]
    # the next version skips the loser's folder, in reads and in the view text
    store.publish(store.stage("t", spark.createDataFrame([(3,)], "k int"), APPEND, D3), keep_history=True)
    assert _rows(store.read("t")) == [(0,), (won[0],), (3,)] == _rows(spark.sql(view_sql(store, "t")))


def test_record_is_created_once(spark, ws):
    from batchwright import fs

    assert fs.create_new(spark, f"{ws}/r.json", "one")
    assert not fs.create_new(spark, f"{ws}/r.json", "two")
    assert fs.read_text(spark, f"{ws}/r.json") == "one"
    assert [e.name for e in fs.ls(spark, ws) if not e.name.endswith(".crc")] == ["r.json"]
