"""Bench: headline loads at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Input batch folders (pipe-delimited, derived from the driver's tables) are
written once, untimed.  Each query then runs the library end to end into a
fresh store (scan, stamp / merge, stage, publish) and materialises the
loaded table with a no-op write.  The median of ``$BENCH_RUNS`` runs is
reported per query; ``value`` is their sum.  Prints one JSON line.
``$BENCH_EVENT_LOG`` (a folder) also writes Spark's event log there, for
``tools/stage_times.py``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from batchwright.operators import scd2  # noqa: E402
from batchwright.plans import DRIVER_FACT_TABLE, derived, driver_registry, replay  # noqa: E402
from batchwright.session import local_session, scratch_dir  # noqa: E402
from batchwright.sinks import LakeStore  # noqa: E402
from batchwright.sources.manifest import entries_for, manifest  # noqa: E402
from batchwright.plans.pipeline import run_batch  # noqa: E402


def _materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    event_log = os.environ.get("BENCH_EVENT_LOG")  # a folder: Spark's event log for tools/stage_times.py
    if event_log:
        os.makedirs(event_log, exist_ok=True)
    spark = local_session("batchwright-bench", cores=cpus, shuffle_partitions=cpus * 2, event_log=event_log)
    reg = driver_registry()

    t0 = time.time()
    src = f"{scratch_dir(spark, 'bench-src')}"
    derived.write_batches(spark, sf_dir, src, tables=("customer", "supplier", "part", "nation", "region", "orders"))
    prep = time.time() - t0
    entries = manifest(spark, src)

    def run_tables(tables, batches, mode):
        store = LakeStore(spark, scratch_dir(spark, "bench-lake"))
        for n in batches:
            picked = [e for e in entries_for(entries, derived.batch_name(n)) if e.table in tables]
            run_batch(spark, store, reg, picked, mode=mode)
        return store

    def q_scd2_strict():
        _materialise(run_tables({"customer"}, (1, 2), scd2.STRICT).read("customer"))

    def q_scd2_compat():
        _materialise(run_tables({"customer"}, (1, 2), scd2.COMPAT).read("customer"))

    def q_scd2_history():
        _materialise(run_tables({"customer"}, (1, 2, 3), scd2.STRICT).read("customer"))

    def q_append_load():
        _materialise(run_tables({"orders"}, (1, 2, 3), scd2.STRICT).read("orders"))

    def q_truncate_load():
        _materialise(run_tables({"part"}, (1, 2), scd2.STRICT).read("part"))

    def q_replay():
        store = LakeStore(spark, scratch_dir(spark, "bench-lake"))
        replay(spark, store, reg, src, DRIVER_FACT_TABLE, mode=scd2.STRICT)
        for t in ("customer", "supplier", "part", "nation", "region", "orders"):
            _materialise(store.read(t))

    bench = {
        "q_scd2_strict": q_scd2_strict,
        "q_scd2_compat": q_scd2_compat,
        "q_scd2_history": q_scd2_history,
        "q_append_load": q_append_load,
        "q_truncate_load": q_truncate_load,
        "q_replay": q_replay,
    }
    q_scd2_strict()  # warm-up (JIT, file listing caches)
    results = {}
    windows = [("prep", int(t0 * 1000), int((t0 + prep) * 1000))]
    for name, fn in bench.items():
        times = []
        for _ in range(runs):
            t = time.time()
            fn()
            times.append(time.time() - t)
            windows.append((name, int(t * 1000), int(time.time() * 1000)))
        results[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "batch_load_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "cpus": cpus,
                "runs": runs,
                "prep_sec": round(prep, 3),
                "spark": spark.version,
            }
        )
    )
    spark.stop()
    if event_log:  # query time windows, so stages can be attributed by submission time
        with open(os.path.join(event_log, "windows.json"), "w") as f:
            json.dump(windows, f)


if __name__ == "__main__":
    main()
