"""Batch loop: replay, reruns, recovery after a crash, bootstrap."""

import os
import shutil

import pytest

from batchwright.operators import loads
from batchwright.plans import bootstrap, derived, driver_basic_registry, driver_registry, replay
from batchwright.sinks import LakeStore
from batchwright.specs import UnknownTableError

from .conftest import SF

TABLES = ("customer", "supplier", "part", "nation", "region", "orders")


def _snapshot(store):
    return {t: sorted(tuple(r) for r in store.read(t).collect()) for t in TABLES if store.exists(t)}


@pytest.fixture(scope="module")
def batches(spark):
    from batchwright.session import scratch_dir

    root = scratch_dir(spark, "pipeline-src")
    derived.write_batches(spark, SF, root, tables=TABLES)
    return root


@pytest.fixture(scope="module")
def clean(spark, batches):
    from batchwright.session import scratch_dir

    store = LakeStore(spark, scratch_dir(spark, "pipeline-clean"))
    reports = replay(spark, store, driver_registry(), batches, "orders")
    return store, reports


def test_replay_loads_every_batch(clean):
    store, reports = clean
    assert [r.status for r in reports] == ["loaded"] * 3
    assert [x.action for x in reports[0].loads] == ["first_load"] * 6
    assert reports[-1].loads[-1].table == "orders"  # fact last
    assert store.batch_mark("orders") == derived.BATCH_DATES[-1]


def test_rerun_is_noop(spark, batches, clean):
    store, _ = clean
    before = _snapshot(store)
    reports = replay(spark, store, driver_registry(), batches, "orders")
    assert [r.status for r in reports] == ["not_new"] * 3
    assert _snapshot(store) == before


def test_crash_before_fact_then_rerun(spark, batches, clean, ws, monkeypatch):
    store = LakeStore(spark, ws)
    real = loads.append_load
    calls = {"n": 0}

    def failing(store_, spec, source, batch):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost")
        return real(store_, spec, source, batch)

    monkeypatch.setattr(loads, "append_load", failing)
    with pytest.raises(RuntimeError):
        replay(spark, store, driver_registry(), batches, "orders")
    # batch 2's dimensions are in, its fact is not: batch 2 is still "new"
    assert store.has_batch("customer", derived.BATCH_DATES[1])
    assert not store.has_batch("orders", derived.BATCH_DATES[1])
    reports = replay(spark, store, driver_registry(), batches, "orders")
    actions = {x.table: x.action for x in reports[1].loads}
    assert actions["customer"] == "already_loaded" and actions["orders"] == "append"
    assert _snapshot(store) == _snapshot(clean[0])


def test_table_first_seen_later_gets_first_load(spark, ws):
    root = f"{ws}/src"
    derived.write_batches(spark, SF, root, tables=("customer",), batches=(1,))
    derived.write_batches(spark, SF, root, tables=("customer", "supplier"), batches=(2,))
    store = LakeStore(spark, f"{ws}/lake")
    reports = replay(spark, store, driver_registry(), root, "orders")
    acts = {x.table: x.action for x in reports[1].loads}
    assert acts == {"customer": "scd2_strict", "supplier": "first_load"}


def test_unknown_table_fails_before_loading(spark, ws):
    root = f"{ws}/src"
    derived.write_batches(spark, SF, root, tables=("customer",), batches=(1,))
    derived.write_batch_frame(derived.table(spark, SF, "lineitem"), root, 1, "mystery")
    store = LakeStore(spark, f"{ws}/lake")
    with pytest.raises(UnknownTableError):
        replay(spark, store, driver_registry(), root, "orders")
    assert not store.exists("customer")


def test_missing_part_files_reported(spark, ws):
    root = f"{ws}/src"
    derived.write_batches(spark, SF, root, tables=("customer",), batches=(1,))
    local = root.replace("file:", "", 1)
    os.makedirs(f"{local}/{derived.batch_name(1)}/part")
    store = LakeStore(spark, f"{ws}/lake")
    reports = replay(spark, store, driver_registry(), root, "orders")
    assert reports[0].missing == ["part"] and store.exists("customer")


def test_bootstrap_once(spark, ws):
    derived.write_one_time_files(spark, SF, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    assert bootstrap(spark, store, driver_basic_registry(), f"{ws}/src")
    assert not bootstrap(spark, store, driver_basic_registry(), f"{ws}/src")
    assert store.read("customers").count() == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_compat_mode_replay(spark, batches, ws):
    store = LakeStore(spark, ws)
    reports = replay(spark, store, driver_registry(), batches, "orders", mode="compat")
    assert {x.table: x.action for x in reports[1].loads}["customer"] == "scd2_compat"
    open_rows = store.read("customer").where("end_date is null").count()
    assert open_rows > 0


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_null_keys_dropped_and_counted(spark, ws, mode):
    root = f"{ws}/src"
    base = derived.table(spark, SF, "customer")
    for n in (1, 2):
        derived.write_batch_frame(derived.customer_nulls_batch(base, n), root, n, "customer")
    store = LakeStore(spark, f"{ws}/lake")
    reports = replay(spark, store, driver_registry(), root, "orders", mode=mode)
    load = reports[1].loads[0]
    want = base.where("c_custkey % 25 = 1").count()
    assert load.metrics["null_keys"] == want > 0
    assert store.read("customer").where("c_custkey is null").count() == 0


def test_strict_first_load_rejects_duplicate_keys(spark, ws):
    from batchwright.operators.loads import first_load

    spec = driver_registry()["customer"]
    base = derived.table(spark, SF, "customer")
    dup = base.unionByName(base.where("c_custkey = 3"))
    with pytest.raises(Exception, match="duplicate source key c_custkey=3"):
        first_load(LakeStore(spark, f"{ws}/a"), spec, dup, derived.BATCH_DATES[0], "strict")
    res = first_load(LakeStore(spark, f"{ws}/b"), spec, dup, derived.BATCH_DATES[0], "compat")
    assert res.metrics["rows"] == base.count() + 1


def test_dimension_failure_blocks_fact_then_rerun(spark, batches, clean, ws, monkeypatch):
    """Dimensions load concurrently; one failing keeps the fact (and so the
    batch) unloaded, the others commit, and a rerun completes the batch."""
    from batchwright.plans import pipeline

    store = LakeStore(spark, ws)
    real = pipeline.incremental_load
    calls = {"n": 0}

    def failing(store_, spec, source, batch, mode):
        if spec.name == "supplier":
            calls["n"] += 1
            if calls["n"] == 1:
                raise RuntimeError("executor lost")
        return real(store_, spec, source, batch, mode)

    monkeypatch.setattr(pipeline, "incremental_load", failing)
    with pytest.raises(RuntimeError, match="executor lost"):
        replay(spark, store, driver_registry(), batches, "orders", parallelism=4)
    b2 = derived.BATCH_DATES[1]
    assert store.has_batch("customer", b2) and store.has_batch("part", b2)
    assert not store.has_batch("supplier", b2) and not store.has_batch("orders", b2)
    reports = replay(spark, store, driver_registry(), batches, "orders", parallelism=4)
    actions = {x.table: x.action for x in reports[1].loads}
    assert actions["customer"] == "already_loaded" and actions["supplier"] == "scd2_strict"
    assert actions["orders"] == "append"
    assert _snapshot(store) == _snapshot(clean[0])


def test_sequential_and_concurrent_replays_agree(spark, batches, clean, ws):
    store = LakeStore(spark, ws)
    reports = replay(spark, store, driver_registry(), batches, "orders", parallelism=1)
    assert [x.table for x in reports[0].loads] == [x.table for x in clean[1][0].loads]
    assert _snapshot(store) == _snapshot(clean[0])


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_unchanged_batch_is_recorded(spark, ws, mode):
    from batchwright.operators.loads import first_load, scd_load

    spec = driver_registry()["customer"]
    base = derived.table(spark, SF, "customer")
    store = LakeStore(spark, ws)
    first_load(store, spec, base, derived.BATCH_DATES[0], mode)
    before = sorted(tuple(r) for r in store.read("customer").collect())
    res = scd_load(store, spec, base, derived.BATCH_DATES[1], mode)
    assert res.action == "no_change" and res.metrics["inserted"] == 0
    assert store.batch_dates("customer") == list(derived.BATCH_DATES[:2])  # so a rerun knows the batch
    assert sorted(tuple(r) for r in store.read("customer").collect()) == before


def test_rerun_lists_no_table_folders_of_loaded_batches(spark, batches, clean, monkeypatch):
    from batchwright.plans import pipeline

    listed = []
    real = pipeline.list_batch_entries
    monkeypatch.setattr(pipeline, "list_batch_entries", lambda s, root, b: listed.append(b) or real(s, root, b))
    reports = replay(spark, clean[0], driver_registry(), batches, "orders")
    assert [r.status for r in reports] == ["not_new"] * 3 and listed == []


def test_compat_merge_leaves_no_staged_change_set(spark, ws):
    from batchwright import fs
    from batchwright.operators.loads import first_load, scd_load
    from batchwright.session import work_dir

    spec = driver_registry()["customer"]
    base = derived.table(spark, SF, "customer")
    store = LakeStore(spark, ws)
    first_load(store, spec, base, derived.BATCH_DATES[0], "compat")
    res = scd_load(store, spec, derived.customer_batch(base, 2), derived.BATCH_DATES[1], "compat")
    assert res.action == "scd2_compat"
    assert not [e for e in fs.ls(spark, work_dir(spark)) if e.name.startswith("changed-customer")]
