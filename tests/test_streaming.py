from batchwright.plans import derived, driver_registry
from batchwright.sinks import LakeStore
from batchwright.streaming import watch

from .conftest import SF


def test_new_batches_loaded_once(spark, ws):
    root = f"{ws}/src"
    ckpt = f"{ws}/ckpt"
    store = LakeStore(spark, f"{ws}/lake")
    reg = driver_registry()
    derived.write_batches(spark, SF, root, tables=("customer", "orders"), batches=(1, 2))
    reports = []
    q = watch(spark, store, reg, root, "orders", checkpoint=ckpt, reports=reports)
    q.awaitTermination(300)
    assert store.batch_mark("orders") == derived.BATCH_DATES[1]
    assert [r.status for r in reports] == ["loaded", "loaded"]

    derived.write_batches(spark, SF, root, tables=("customer", "orders"), batches=(3,))
    reports.clear()
    q = watch(spark, store, reg, root, "orders", checkpoint=ckpt, reports=reports)
    q.awaitTermination(300)
    assert store.batch_mark("orders") == derived.BATCH_DATES[2]
    assert [r.status for r in reports] == ["not_new", "not_new", "loaded"]

    reports.clear()
    q = watch(spark, store, reg, root, "orders", checkpoint=ckpt, reports=reports)
    q.awaitTermination(300)
    assert reports == []  # nothing new arrived
