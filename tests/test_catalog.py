import uuid

from batchwright.plans import derived, driver_basic_registry, driver_registry, replay
from batchwright.plans.catalog import bootstrap_database, register, replay_with_views
from batchwright.sinks import LakeStore

from .conftest import SF


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_views_match_store_reads(spark, ws):
    root = f"{ws}/src"
    derived.write_batches(spark, SF, root, tables=("customer", "part", "orders"))
    store = LakeStore(spark, f"{ws}/lake")
    replay(spark, store, driver_registry(), root, "orders")
    assert sorted(register(spark, store)) == ["customer", "orders", "part"]
    for t in ("customer", "part", "orders"):
        assert _rows(spark.table(t)) == _rows(store.read(t))


def test_bootstrap_database_once(spark, ws):
    db = f"bw_{uuid.uuid4().hex[:8]}"
    derived.write_one_time_files(spark, SF, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    reg = driver_basic_registry()
    assert bootstrap_database(spark, store, reg, f"{ws}/src", db)
    assert not bootstrap_database(spark, store, reg, f"{ws}/src", db)
    assert spark.table(f"{db}.customers").count() == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_views_follow_replay_with_stable_types(spark, ws):
    root, store = f"{ws}/src", LakeStore(spark, f"{ws}/lake")
    for n in (1, 2):
        derived.write_batches(spark, SF, root, tables=("customer",), batches=(n,))
        replay_with_views(spark, store, driver_registry(), root, "orders")
        view = spark.table("customer")
        assert view.dtypes == store.read("customer").dtypes
        assert _rows(view) == _rows(store.read("customer"))
