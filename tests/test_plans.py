"""Plan shapes that the scale design relies on (read from ``explain``).

These pin physical properties, not results: which side is shuffled, that
the duplicate-key check is a map-side-combined aggregate and not a window,
that a strict merge reads only the open partition, that hot change tuples
collapse before their shuffle, and that scans read only needed columns.
"""

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from batchwright.functions.stamps import with_batch_stamp, with_scd_columns
from batchwright.operators import scd2
from batchwright.plans import derived, driver_registry
from batchwright.sinks import LakeStore
from batchwright.sinks.lake import SCD
from batchwright.sources import read_delimited

from .conftest import SF

B1, B2 = derived.BATCH_DATES[0], derived.BATCH_DATES[1]
KEY, CHANGE = "c_custkey", ["c_name", "c_mktsegment"]


def plan(df, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def _count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def customer(spark):
    return derived.table(spark, SF, "customer")


@pytest.fixture(scope="module")
def open_set(spark, customer):
    return with_scd_columns(customer, B1)


def test_strict_shuffled_form(customer, open_set):
    src = derived.customer_batch(customer, 2)
    p = plan(scd2.scd2_strict_changes(src, open_set, KEY, CHANGE, B2, broadcast_source=False))
    assert "SortMergeJoin" in p and "FullOuter" in p
    assert "Window" not in p
    # one shuffle per join side, on the key; the source's is that of the duplicate check
    assert _count(r"Exchange hashpartitioning", p) == 2
    assert "partial_count(1)" in p  # the check combines map-side


def test_strict_broadcast_form_never_shuffles_open_set(customer, open_set):
    src = derived.customer_batch(customer, 2)
    p = plan(scd2.scd2_strict_changes(src, open_set, KEY, CHANGE, B2, broadcast_source=True))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "SortMergeJoin" not in p
    # only the guard's key-only aggregate shuffles
    assert _count(r"Exchange hashpartitioning", p) == 1
    assert re.search(r"Exchange hashpartitioning\(c_custkey#\d+L?, \d+\)", p)


def test_strict_size_check_picks_form(spark, customer, open_set):
    src = derived.customer_batch(customer, 2)
    assert scd2.fits_broadcast(src, limit=1 << 40)
    assert not scd2.fits_broadcast(src, limit=0)
    assert not scd2.fits_broadcast(src, limit=-1)  # broadcasting disabled


def test_strict_merge_reads_only_open_partition(spark, ws, customer):
    store = LakeStore(spark, ws)
    first = with_scd_columns(customer, B1)
    store.publish(store.stage("customer", first, SCD, B1), keep_history=True)
    src = derived.customer_batch(customer, 2)
    changes = scd2.scd2_strict_changes(src, store.read_open("customer"), KEY, CHANGE, B2)
    store.publish(store.stage("customer", changes, SCD, B2, keep_history=True), keep_history=True)
    p = plan(store.read_open("customer"), "formatted")
    assert re.search(r"PartitionFilters: \[isnull\(end_date", p)
    assert "seq=2" in p and "seq=1" not in p
    # the full table reads the closed partitions of every commit
    assert "seq=1" in plan(store.read("customer"), "formatted")


def test_compat_hot_tuples_collapse_before_shuffle(customer, open_set):
    src = derived.customer_batch(customer, 2)
    p = plan(scd2.unchanged_keys(src, open_set, KEY, CHANGE))
    assert re.search(r"HashAggregate\(keys=\[c_name#\d+, c_mktsegment#\d+\], functions=\[\]\)", p)
    assert "LeftSemi" in p
    # rows whose tuple has a NULL cannot match under '=' and are filtered
    # at the scan instead of being hashed into one partition
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(c_mktsegment\)", plan(scd2.unchanged_keys(src, open_set, KEY, CHANGE), "formatted"))


def test_delimited_scan_prunes_columns(spark, ws, customer):
    spec = driver_registry()["customer"]
    derived.write_batch_frame(customer, ws, 1, "customer")
    df = read_delimited(spark, f"{ws}/{derived.batch_name(1)}/customer", spec.schema)
    p = plan(df.select(KEY).where(F.col(KEY) > 10), "formatted")
    assert re.search(r"ReadSchema: struct<c_custkey:bigint>", p)
    assert "PushedFilters: [IsNotNull(c_custkey), GreaterThan(c_custkey,10)]" in p


def test_stamped_load_has_no_shuffle(spark, customer):
    p = plan(with_batch_stamp(customer, B1))
    assert "Exchange" not in p


def test_first_load_guard_only_reads_key(spark, customer):
    df = with_scd_columns(customer, B1)
    guarded = df.union(scd2.duplicate_key_guard(customer, KEY, df.schema))
    assert _count(r"Exchange", plan(guarded)) == 1
    assert "ReadSchema: struct<c_custkey:bigint>" in plan(guarded, "formatted")


def test_hot_duplicate_key_fails(spark, customer):
    """A key holding a third of the batch: the guard fails the job."""
    n = customer.count()
    one = customer.where(F.col(KEY) == 3)
    hot = one.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("_r")
    src = customer.unionByName(hot)
    with pytest.raises(Exception, match="duplicate source key c_custkey=3"):
        scd2.scd2_strict_changes(src, with_scd_columns(customer, dt.date(2022, 1, 1)), KEY, CHANGE, B2).write.format("noop").mode("overwrite").save()


def test_broadcast_bound_is_measured_not_estimated(spark, ws):
    """Compressed Parquet looks tiny to Catalyst; the measured bound sees
    the rows as they would sit in a broadcast relation."""
    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, None)], "k int, s string")
    # per row: 8 null-bit bytes + 2 words + 1 var word + 32 entry bytes; plus 3 string bytes
    assert scd2.broadcast_bytes_bound(df) == 3 * (8 + 16 + 8 + 32) + 3
    wide = spark.range(20000).select("id", F.lit("x" * 200).alias("s"))
    wide.write.parquet(f"{ws}/wide")
    back = spark.read.parquet(f"{ws}/wide")
    limit = 1 << 20
    assert scd2.estimated_bytes(back) <= limit  # dictionary-encoded on disk
    assert scd2.broadcast_bytes_bound(back) > limit
    assert not scd2.fits_broadcast(back, limit=limit)


def test_compat_mark_join_broadcast_only_under_counted_bound(spark, ws, customer, open_set):
    src = derived.customer_batch(customer, 2)
    scd2.changed_rows(src, open_set, KEY, CHANGE, "compat").write.parquet(f"{ws}/changed")
    changed = spark.read.parquet(f"{ws}/changed")  # staged, as the load does
    small = plan(scd2.scd2_compat(src, open_set, KEY, CHANGE, B2, changed=changed, changed_count=10))
    assert "BroadcastHashJoin" in small and "LeftOuter" in small
    big = plan(scd2.scd2_compat(src, open_set, KEY, CHANGE, B2, changed=changed, changed_count=10**9))
    assert "SortMergeJoin" in big and "BroadcastHashJoin" not in big


def test_compat_change_detection_forms(customer, open_set):
    # one branch (customer_batch is a union, which Catalyst splits the anti join over)
    src = customer.withColumn("c_name", F.when(F.col(KEY) % 10 == 0, F.lit("changed")).otherwise(F.col("c_name")))
    small = plan(scd2.changed_rows(src, open_set, KEY, CHANGE, "compat", broadcast_source=True), "formatted")
    # the target streams through broadcast semi joins; the only shuffle is
    # the distinct of the unchanged keys, which are at most the source's keys
    assert _count(r"\(\d+\) BroadcastHashJoin", small) == 3
    assert _count(r"\(\d+\) Exchange", small) == 1
    assert "SortMergeJoin" not in small
    big = plan(scd2.changed_rows(src, open_set, KEY, CHANGE, "compat", broadcast_source=False))
    assert "BroadcastHashJoin" not in big and _count("SortMergeJoin", big) == 2
