"""The original tables, loaded whole and compared row by row; scheduler pools of concurrent loads."""

import os
import re
import threading
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from batchwright import session
from batchwright.operators import scd2
from batchwright.plans import derived, load_once, replay
from batchwright.plans.pipeline import POOL
from batchwright.plans.registry import REFERENCE_BATCH_TABLES, REFERENCE_FACT_TABLE, driver_basic_registry, reference_batch_registry
from batchwright.sinks import LakeStore
from batchwright.sources import delimited
from batchwright.specs import APPEND, SCD

from .conftest import SF

MODES = (scd2.STRICT, scd2.COMPAT)
SCD_TABLES = [s for s in REFERENCE_BATCH_TABLES if s.load == SCD]


@pytest.mark.parametrize("name", ["q_original_tables", "q_original_one_time", "q_replay_rows"])
def test_rows_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    got = [tuple(r) for r in entry.queries()[name](spark, SF).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("spec", SCD_TABLES, ids=lambda s: s.name)
def test_second_batch_differs_in_every_change_column(spark, spec):
    one, two = (derived.original_batch(spark, SF, spec, n) for n in (1, 2))
    both = one.alias("a").join(two.alias("b"), spec.primary_key)
    for c in spec.change_columns:
        assert both.where(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).count(), c
    _, key = derived.ORIGINS[spec.name]
    added = derived.table(spark, SF, derived.ORIGINS[spec.name][0]).where(f"{key} < 7").count()
    assert added and two.join(one, spec.primary_key, "left_anti").count() == added


def test_replay_again_changes_nothing(spark, ws):
    derived.write_original_batches(spark, SF, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    for status in ("loaded", "not_new"):
        reports = replay(spark, store, reference_batch_registry(), f"{ws}/src", REFERENCE_FACT_TABLE)
        assert [r.status for r in reports] == [status] * 2


class PoolStore(LakeStore):
    """Notes the pool that each table's result is written in."""

    def stage(self, table, *args, **kwargs):
        sc = self.spark.sparkContext
        self.pools[table] = (sc.getLocalProperty(POOL), sc.getLocalProperty("own.property"))
        return super().stage(table, *args, **kwargs)


@pytest.mark.parametrize("chosen", [None, "nightly"])
def test_a_pool_a_load(spark, ws, chosen):
    sc = spark.sparkContext
    derived.write_one_time_files(spark, SF, f"{ws}/src")
    store = PoolStore(spark, f"{ws}/lake")
    store.pools = {}
    sc.setLocalProperty(POOL, chosen)
    sc.setLocalProperty("own.property", "kept")
    try:
        load_once(spark, store, driver_basic_registry(), f"{ws}/src", parallelism=2)
        assert sc.getLocalProperty(POOL) == chosen  # the caller's thread is as it was
    finally:
        sc.setLocalProperty(POOL, None)
        sc.setLocalProperty("own.property", None)
    assert store.pools == {t: (chosen or f"load-{t}", "kept") for t in ("customers", "nation", "region")}


@pytest.mark.parametrize("name", ["q_original_tables", "q_replay_rows"])
def test_both_modes_load_side_by_side(spark, monkeypatch, name):
    """Neither mode's replay, and neither of two folders' writes, waits for the end of the other."""
    met = {}

    def meeting(where, label):
        own, both = getattr(where, label), threading.Barrier(2)

        def run(*args, **kwargs):
            if met.setdefault(label, 0) < 2:  # the first two meet, or break the barrier
                met[label] += 1
                both.wait(120)
            return own(*args, **kwargs)

        monkeypatch.setattr(where, label, run)

    meeting(entry, "replay")
    meeting(derived, "write_delimited")
    rows = entry.queries()[name](spark, SF)
    assert met == {"replay": 2, "write_delimited": 2}
    assert rows.groupBy("mode").count().count() == 2


def test_row_text_rounds_as_sql(spark):
    """Halves go away from zero, and no decimal number is made of a double."""
    halves = [n + 0.5 for n in (0, 1, 2, 10, 12345678, 2**51)]
    values = [*halves, 0.49999999999999994, 0.0, -0.0, 1e-300, 28.499999999999996, 2.0**52 + 1, 2.0**53, 9e18, 1234567.25, float("nan"), float("inf"), 1e300]
    df = spark.createDataFrame([(v,) for x in values for v in (x, -x)] + [(None,)], "x double")
    got = df.selectExpr("x", f"{entry.NEAREST.format('x')} AS got", "ROUND(x) AS want")
    assert got.where("NOT (got <=> want)").collect() == []
    sums = spark.createDataFrame([(0.285,), (1.005,), (-2.675,), (904.125,), (-904.125,), (None,)], "x double")
    text = lambda f: [r[0] for r in sums.selectExpr(f).collect()]
    assert text(entry._row_text([("x", "double")], entry.NEAREST)) == text(entry._row_text([("x", "double")])) == ["28", "100", "-268", "90413", "-90413", "~"]


def test_row_texts_make_no_decimals(spark, ws):
    derived.write_one_time_files(spark, SF, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    load_once(spark, store, driver_basic_registry(), f"{ws}/src")
    plan = entry._row_texts(store, ["customers"])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rint(" in plan and "round(" not in plan


def _files(folder, pattern):
    """Paths of the files below a local folder whose names match."""
    folder = folder.removeprefix("file:")
    return sorted(f"{d}/{f}" for d, _, names in os.walk(folder) for f in names if re.fullmatch(pattern, f))


def _text_of(spark, folder):
    return sorted(r[0] for r in spark.read.text(folder).collect())


def test_original_batches_are_compressed(spark, ws, monkeypatch):
    """The files of each folder hold the rows of a plain write, in much less space."""
    monkeypatch.setattr(delimited, "ROWS_A_FILE", 1000)
    derived.write_original_batches(spark, SF, f"{ws}/src")
    plain = packed = 0
    for spec in REFERENCE_BATCH_TABLES:
        for n in (1, 2):
            path = f"{derived.batch_name(n)}/{spec.name}"
            rows = derived.original_batch(spark, SF, spec, n)
            delimited.write_delimited(rows, f"{ws}/plain/{path}")
            assert _text_of(spark, f"{ws}/src/{path}") == _text_of(spark, f"{ws}/plain/{path}"), path
            files = _files(f"{ws}/src/{path}", "part.*")
            assert len(files) >= rows.count() / 1000 and all(f.endswith(".csv.gz") for f in files), path
            plain += sum(map(os.path.getsize, _files(f"{ws}/plain/{path}", "part.*")))
            packed += sum(map(os.path.getsize, files))
    assert packed < plain / 2


def test_compressed_folder_of_no_rows(spark, ws):
    none = spark.range(3).select(F.col("id").alias("a"), F.lit("x").alias("b")).where("a > 5")
    delimited.write_delimited(none, f"{ws}/none", compressed=True)
    assert _files(f"{ws}/none", "part.*")  # the folder is there to be loaded, without a row
    assert delimited.read_delimited(spark, f"{ws}/none", "a int, b string").collect() == []


def test_original_tables_hold_no_spent_data(spark, ws, monkeypatch):
    """After the loads neither batch folders nor superseded versions are left; the result is whole."""
    monkeypatch.setattr(entry, "_ws", lambda spark, label: ws)
    rows = entry.queries()["q_original_tables"](spark, SF)
    assert _files(f"{ws}/src", "part.*") == []
    for mode in MODES:
        store = LakeStore(spark, f"{ws}/{mode}")
        for spec in REFERENCE_BATCH_TABLES:
            head = store.head(spec.target)
            kept = [os.path.relpath(f, store.table_path(spec.target).removeprefix("file:")) for f in _files(store.table_path(spec.target), r"part.*\.parquet")]
            assert head.version == 2 and all(f.endswith(".zstd.parquet") for f in kept), spec.name
            if spec.load == SCD:  # of the first commit at most closed rows
                kept = [f for f in kept if "__HIVE_DEFAULT_PARTITION__" in f]
            read = {1, 2} if spec.load == APPEND else {2}
            assert {int(re.match(r"seq=(\d+)/", f)[1]) for f in kept} == read, spec.name
        n = sum(store.read(s.target).count() for s in REFERENCE_BATCH_TABLES)
        assert n and rows.where(F.col("mode") == mode).count() == n


@pytest.mark.parametrize("last", MODES)
def test_a_folder_stays_until_both_modes_have_loaded_it(spark, ws, monkeypatch, last):
    """One mode begins when the other has ended: it still finds both batches."""
    own, ended, seen = entry.replay, threading.Event(), {}

    def run(*args, mode, **kwargs):
        if mode == last:
            assert ended.wait(300)
            seen["left"] = {n for n in (1, 2) if _files(f"{ws}/src/{derived.batch_name(n)}", "part.*")}
        try:
            reports = own(*args, mode=mode, **kwargs)
        finally:
            if mode != last:
                ended.set()
        seen[mode] = [r.status for r in reports]
        return reports

    monkeypatch.setattr(entry, "_ws", lambda spark, label: ws)
    monkeypatch.setattr(entry, "replay", run)
    entry.queries()["q_original_tables"](spark, SF)
    assert seen == {"left": {1, 2}, **{m: ["loaded", "loaded"] for m in MODES}}
    assert _files(f"{ws}/src", "part.*") == []


def test_after_batch_names_what_this_run_loaded(spark, ws):
    derived.write_original_batches(spark, SF, f"{ws}/src")
    os.makedirs(f"{ws}/src/{derived.batch_name(3)}/item".removeprefix("file:"))  # a folder without files
    store, told = LakeStore(spark, f"{ws}/lake"), []
    for want in ([derived.batch_name(1), derived.batch_name(2)], []):
        told.clear()
        reports = replay(spark, store, reference_batch_registry(), f"{ws}/src", REFERENCE_FACT_TABLE, after_batch=told.append)
        assert reports[-1].status == "incomplete" and told == want


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_when_a_write_ends(spark, ws):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()  # holds its shuffle from garbage collection
    before, value = _shuffle_files(spark), spark.conf.get(key, "false")
    with session.shuffle_files_cleaned(spark):
        kept.write.parquet(f"{ws}/cleaned")
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == value
    until = time.time() + 60  # Spark deletes them in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert _shuffle_files(spark) - before == set()
    with pytest.raises(ValueError):
        with session.shuffle_files_cleaned(spark):
            raise ValueError
    assert spark.conf.get(key) == value


def test_original_tables_load_with_shuffle_files_cleaned(spark, ws, monkeypatch):
    key, own, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", entry.replay, []

    def run(*args, **kwargs):
        seen.append(spark.conf.get(key))
        return own(*args, **kwargs)

    value = spark.conf.get(key, "false")
    monkeypatch.setattr(entry, "replay", run)
    entry.queries()["q_original_tables"](spark, SF)
    assert seen == ["true", "true"] and spark.conf.get(key) == value
