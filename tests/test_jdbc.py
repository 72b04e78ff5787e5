"""JDBC target through an in-process Derby database (no server)."""

import datetime as dt
import uuid

import pytest

from pyspark.sql import functions as F

from batchwright.operators import scd2
from batchwright.operators.loads import append_load, first_load, scd_load
from batchwright.plans import derived, driver_registry
from batchwright.sinks import JdbcStore
from batchwright.sources import read_jdbc
from batchwright.sources.jdbc import equi_depth_cuts, read_jdbc_equi_depth

from .conftest import SF

OPTS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _store(spark, **kw):
    return JdbcStore(spark, f"jdbc:derby:memory:t{uuid.uuid4().hex[:10]};create=true", OPTS, **kw)


@pytest.mark.parametrize("keys", [None, {"customer": "c_custkey"}])
def test_scd_over_jdbc_keeps_history(spark, keys):
    """Rewriting a table derived from itself must not lose its old rows
    (whole-table replace, or the close-and-insert delta when the key is known)."""
    store = _store(spark, keys=keys)
    spec = driver_registry()["customer"]
    b1 = derived.batch_frame(spark, SF, "customer", 1)
    b2 = derived.batch_frame(spark, SF, "customer", 2)
    first_load(store, spec, b1, derived.BATCH_DATES[0])
    res = scd_load(store, spec, b2, derived.BATCH_DATES[1], scd2.STRICT)
    out = store.read("customer")
    n1, n2 = b1.count(), b2.count()
    changed = res.metrics["closed"]
    assert out.count() == n1 + res.metrics["inserted"]
    assert out.where("end_date is null").count() == n2
    assert changed > 0


def test_append_retry_replaces_batch_rows(spark):
    store = _store(spark)
    spec = driver_registry()["orders"]
    first_load(store, spec, derived.batch_frame(spark, SF, "orders", 1), derived.BATCH_DATES[0])
    b2 = derived.batch_frame(spark, SF, "orders", 2)
    append_load(store, spec, b2, derived.BATCH_DATES[1])
    append_load(store, spec, b2, derived.BATCH_DATES[1])
    out = store.read("orders")
    assert out.where(F.col("batched_at") == F.lit(derived.BATCH_DATES[1])).count() == b2.count()
    assert store.batch_mark("orders") == derived.BATCH_DATES[1]


def test_recover_republishes_staged(spark):
    store = _store(spark)
    spec = driver_registry()["part"]
    df = derived.batch_frame(spark, SF, "part", 1).withColumn("batched_at", F.lit(dt.date(2022, 11, 1)))
    pending = store.stage("part", df, "snapshot", dt.date(2022, 11, 1))  # crash before publish
    assert not store.exists("part")
    assert [p.seq for p in store.recover()] == [pending.seq]
    assert store.read("part").count() == df.count()
    assert store.recover() == []


def test_partitioned_read(spark):
    store = _store(spark)
    spec = driver_registry()["customer"]
    first_load(store, spec, derived.batch_frame(spark, SF, "customer", 1), derived.BATCH_DATES[0])
    df = read_jdbc(spark, store.url, "customer", OPTS, partition_column="c_custkey", num_partitions=3)
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_publish_is_atomic(spark, monkeypatch):
    """A failure inside the publishing transaction leaves the table as it
    was; recover() then completes the publish."""
    store = _store(spark, keys={"customer": "c_custkey"})
    spec = driver_registry()["customer"]
    first_load(store, spec, derived.batch_frame(spark, SF, "customer", 1), derived.BATCH_DATES[0])
    before = store.read("customer").count()
    real = store.execute

    def broken(*statements):
        real(*statements[:-1], "INSERT INTO no_such_table VALUES (1)")

    monkeypatch.setattr(store, "execute", broken)
    try:
        scd_load(store, spec, derived.batch_frame(spark, SF, "customer", 2), derived.BATCH_DATES[1], scd2.STRICT)
        raise AssertionError("publish should have failed")
    except Exception as exc:  # noqa: BLE001
        assert "no_such_table" in str(exc).lower() or "NO_SUCH_TABLE" in str(exc)
    assert store.read("customer").count() == before
    assert not store.has_batch("customer", derived.BATCH_DATES[1])
    monkeypatch.setattr(store, "execute", real)
    assert len(store.recover()) == 1
    assert store.has_batch("customer", derived.BATCH_DATES[1])
    assert store.read("customer").where("end_date is null").count() == derived.batch_frame(spark, SF, "customer", 2).count()
    assert store.recover() == []


def test_unreachable_database_is_an_error_not_an_empty_store(spark):
    from batchwright.sinks import JdbcStore

    store = JdbcStore(spark, "jdbc:derby:memory:batchwright_missing_db_never_created", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    with pytest.raises(Exception):
        store.exists("orders")


def test_staged_files_removed_once_published(spark):
    from batchwright import fs

    url = f"jdbc:derby:memory:bw_stage_{uuid.uuid4().hex[:8]};create=true"
    store = JdbcStore(spark, url, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    spec = driver_registry()["nation"]
    res = first_load(store, spec, derived.table(spark, SF, "nation"), derived.BATCH_DATES[0])
    assert res.metrics["rows"] == 25
    assert store.read("nation").count() == 25
    assert not [e for e in fs.ls(spark, f"{store.stage_root}/nation") if fs.ls(spark, e.path)]


def test_log_is_read_by_the_database(spark, monkeypatch):
    """The loop's questions bring one row each from the log, however long it is."""
    store = _store(spark)
    spec = driver_registry()["orders"]
    assert not store.exists("orders") and store.head_seq("orders") == 0 and store.batch_mark("orders") is None
    first_load(store, spec, derived.batch_frame(spark, SF, "orders", 1), derived.BATCH_DATES[0])
    pending = store.stage("orders", derived.batch_frame(spark, SF, "orders", 2), "append", derived.BATCH_DATES[1])
    monkeypatch.setattr(store, "_log", lambda: pytest.fail("whole log read"))
    assert store.exists("orders") and not store.exists("order")
    assert store.head_seq("orders") == pending.seq == 2
    assert store.batch_mark("orders") == derived.BATCH_DATES[0]  # staged is not published
    assert store.has_batch("orders", derived.BATCH_DATES[0]) and not store.has_batch("orders", derived.BATCH_DATES[1])


@pytest.mark.parametrize("name", ["it's", 'a"b'])
def test_log_of_odd_names(spark, name):
    store = _store(spark)
    first_load(store, driver_registry()["orders"], derived.batch_frame(spark, SF, "orders", 1), derived.BATCH_DATES[0])
    assert not store.exists(name) and store.head_seq(name) == 0


def _sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_equi_depth_ranges(spark):
    """Skewed keys with NULLs: no range holds twice the mean, and no row is lost."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:10]};create=true"
    key = F.when(F.col("id") % 50 != 0, F.col("id") * F.col("id") * F.col("id"))
    rows = spark.range(4000).select("id", key.alias("k"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 7).cast("int")).alias("d"))
    rows.write.jdbc(url, "t", properties=OPTS)
    even = _sizes(read_jdbc(spark, url, "t", OPTS, partition_column="k", num_partitions=8))
    assert max(even) > 2 * 500  # ranges of equal width are uneven here
    out = read_jdbc_equi_depth(spark, url, "t", "k", 8, OPTS)
    assert out.rdd.getNumPartitions() == 8 and max(_sizes(out)) <= 2 * 500
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    days = read_jdbc_equi_depth(spark, url, "t", "d", 4, OPTS)
    assert days.count() == 4000 and days.rdd.getNumPartitions() > 1


def test_equi_depth_of_hot_and_empty(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:10]};create=true"
    spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("k")).write.jdbc(url, "hot", properties=OPTS)
    assert read_jdbc_equi_depth(spark, url, "hot", "k", 8, OPTS).count() == 1000
    spark.range(0).select(F.col("id").alias("k")).write.jdbc(url, "nothing", properties=OPTS)
    assert equi_depth_cuts(spark, url, "nothing", "k", 8, OPTS) == []
    assert read_jdbc_equi_depth(spark, url, "nothing", "k", 8, OPTS).count() == 0
