"""The batch loop: discover batches, load each table by its strategy, replay.

Per batch the decisions are

* the batch is skipped when it is not after the fact table's high-water mark,
  by date, then by the rest of its name (no mark means new);
* per table: a table with no version yet gets a first load, a table that
  already holds this batch is skipped (a rerun after a crash), as is one that
  holds a newer batch (appended tables excepted); anything else gets its
  strategy's incremental load;
* while a table folder of a batch has no part file, the fact waits and no
  later batch is loaded;
* dimensions load before the appended fact, so the fact's mark moves only
  after every other table of the batch is in; the dimensions of one batch
  load concurrently.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import control
from ..operators.loads import LoadResult, first_load, full_load, incremental_load
from ..operators.scd2 import STRICT
from ..sources.delimited import read_delimited, read_named_file, record_check
from ..functions.stamps import is_newer, parse_batch_date, token_of
from ..sources.manifest import BatchEntry, list_batches
from ..sources.manifest import batch_entries as list_batch_entries
from ..specs import APPEND, Registry, TableSpec, load_order


@dataclass
class BatchReport:
    batch: str
    batch_date: dt.date
    status: str
    loads: list[LoadResult] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)


POOL = "spark.scheduler.pool"


def concurrently[T](spark: SparkSession, tasks: dict[str, Callable[[], T]], parallelism: int) -> list[T]:
    """Run independent loads (or writes), by name, as concurrent Spark jobs; results in task order.

    Each load inherits the caller's job properties and has a scheduler pool of its own,
    unless the caller has chosen one.  Where the session sets ``spark.scheduler.mode`` to
    ``FAIR``, the loads share the executors evenly, so a small table need not wait for a
    large one's tasks; else Spark ignores the pools.  Every task runs to its end; the
    first error is raised afterwards."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks.values()]
    sc = spark.sparkContext
    chosen = sc.getLocalProperty(POOL)

    def pooled(name: str, task: Callable[[], T]) -> Callable[[], T]:
        def run() -> T:
            sc.setLocalProperty(POOL, chosen or f"load-{name}")
            try:
                return task()
            finally:
                sc.setLocalProperty(POOL, chosen)  # the thread may take another load

        return inheritable_thread_target(spark)(run)  # with the session, tags are inherited too

    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks)), thread_name_prefix="batchwright-load") as pool:
        futures = [pool.submit(pooled(name, task)) for name, task in tasks.items()]
    for f in futures:
        if f.exception() is not None:
            raise f.exception()
    return [f.result() for f in futures]


def _load_table(spark: SparkSession, store, spec, entry: BatchEntry, mode: str, sep: str) -> LoadResult:
    """One table of one batch: skip, first load, or its strategy's load."""
    if entry.n_parts == 0:
        return LoadResult(spec.target, spec.load, "missing_files", entry.batch_date)
    if store.has_batch(spec.target, entry.batch_date):
        return LoadResult(spec.target, spec.load, "already_loaded", entry.batch_date)
    mark = store.batch_mark(spec.target)
    if spec.load != APPEND and mark is not None and token_of(entry.batch_date) < token_of(mark):
        # merged over newer state an old batch would corrupt the history
        return LoadResult(spec.target, spec.load, "older_than_table", entry.batch_date)
    started = time.perf_counter()
    source = read_delimited(spark, entry.path, spec.schema, sep=sep)
    if not store.exists(spec.target):
        result = first_load(store, spec, source, entry.batch_date, mode)
    else:
        result = incremental_load(store, spec, source, entry.batch_date, mode)
    result.seconds = round(time.perf_counter() - started, 3)
    return result


def check_batch(spark: SparkSession, registry: Registry, entries: list[BatchEntry], sep: str = "|") -> DataFrame:
    """``table_name, rows, bad_records, null_fields`` for every table folder
    of a batch that has part files: one plan, one job, each table's counts
    combined per task before a single-row final aggregate."""
    parts = [
        record_check(spark, e.path, registry[e.table].schema, sep=sep).select(F.lit(e.table).alias("table_name"), "*")
        for e in sorted(entries, key=lambda e: e.table)
        if e.n_parts > 0
    ]
    if not parts:
        return spark.createDataFrame([], "table_name string, rows bigint, bad_records bigint, null_fields bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_batch(
    spark: SparkSession,
    store,
    registry: Registry,
    entries: list[BatchEntry],
    mode: str = STRICT,
    sep: str = "|",
    parallelism: int = 8,
    check_records: bool = False,
) -> list[LoadResult]:
    """Load every table folder of one batch (all entries share a batch).

    With ``check_records`` the batch's files are first counted by
    :func:`check_batch` (one extra scan) and each load's metrics get
    ``source_rows``, ``bad_records`` and ``null_fields``.

    Dimension tables are independent of each other (one commit each), so up
    to ``parallelism`` of them load at once as concurrent Spark jobs on the
    one session, each in a scheduler pool of its own.
    Appended facts load after every dimension has succeeded, one by one, so
    the fact's high-water mark still moves last.  If a dimension fails, its
    error is raised after the other running loads finish and no fact is
    loaded; a rerun skips the dimensions that did commit.
    """
    if not entries:
        return []
    registry.check_tables(e.table for e in entries)
    by_table = {e.table: e for e in entries}
    ordered = load_order(registry[t] for t in by_table)
    dims = [s for s in ordered if s.load != APPEND]
    facts = [s for s in ordered if s.load == APPEND]  # load_order puts them last
    checked = {}
    if check_records:
        for r in check_batch(spark, registry, entries, sep).collect():  # one row per table
            checked[r["table_name"]] = {"source_rows": r["rows"], "bad_records": r["bad_records"], "null_fields": r["null_fields"]}
    results = concurrently(spark, {s.target: lambda s=s: _load_table(spark, store, s, by_table[s.name], mode, sep) for s in dims}, parallelism)
    if any(r.action == "missing_files" for r in results):
        # files may still arrive; the fact's mark must not pass this batch before
        results += [LoadResult(s.target, s.load, "waiting", by_table[s.name].batch_date) for s in facts]
    else:
        results += [_load_table(spark, store, s, by_table[s.name], mode, sep) for s in facts]
    for spec, r in zip(dims + facts, results):
        r.metrics.update(checked.get(spec.name, {}))
    return results


def replay(
    spark: SparkSession,
    store,
    registry: Registry,
    source_root: str,
    fact_table: str,
    mode: str = STRICT,
    sep: str = "|",
    parallelism: int = 8,
    check_records: bool = False,
    after_batch: Callable[[str], None] | None = None,
) -> list[BatchReport]:
    """Every batch under ``source_root`` in date order; already loaded
    batches are skipped, so rerunning after a failure is safe.
    ``after_batch`` gets the name of each batch once this run has loaded all of it.

    Only the batch folder names are listed up front (one listing, which
    also validates every name).  A batch's table folders are listed only
    once it is found to be new, so the cost of a run follows the batches it
    loads, not every batch the landing area has ever held."""
    reports = []
    mark = control.high_water_mark(store, fact_table)  # re-read only after a load
    for batch in list_batches(spark, source_root, same_day=getattr(store, "same_day", True)):
        bdate = parse_batch_date(batch)
        if not is_newer(bdate, mark):
            reports.append(BatchReport(batch, bdate, "not_new"))
            continue
        batch_entries = list_batch_entries(spark, source_root, batch)
        if not batch_entries:
            continue
        registry.check_tables(e.table for e in batch_entries)
        loads = run_batch(spark, store, registry, batch_entries, mode, sep, parallelism, check_records)
        mark = control.high_water_mark(store, fact_table)
        missing = [r.table for r in loads if r.action == "missing_files"]
        reports.append(BatchReport(batch, bdate, "incomplete" if missing else "loaded", loads, missing))
        if missing:
            break  # later batches wait for this one's files
        if after_batch:
            after_batch(batch)
    return reports


def load_once(spark: SparkSession, store, registry: Iterable[TableSpec], base_dir: str, sep: str = "|", parallelism: int = 8) -> list[LoadResult]:
    """One-time load: each declared file, as it is, replaces its target
    (tables load concurrently, as in :func:`run_batch`)."""
    def one(spec):
        name = spec.file_name or f"{spec.name}.dat"
        return full_load(store, spec, read_named_file(spark, base_dir, name, spec.schema, sep=sep))

    return concurrently(spark, {s.target: lambda s=s: one(s) for s in registry}, parallelism)


def bootstrap(spark: SparkSession, store, registry: Registry, base_dir: str, sep: str = "|") -> bool:
    """One-time load of the targets that do not exist yet (all, or what an
    earlier run did not reach).

    Returns True when it loaded."""
    present = control.tables_present(store, [s.target for s in registry])
    absent = [s for s in registry if not present[s.target]]
    if absent:
        load_once(spark, store, absent, base_dir, sep)
    return bool(absent)
