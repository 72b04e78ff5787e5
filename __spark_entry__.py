"""

Every query derives dated batch folders from the driver's tables (whole
tables, see ``batchwright.plans.derived``), writes them under a fresh
scratch folder below the session's checkpoint folder, runs the library on
them and returns the loaded result as a DataFrame.  The oracle SQL recomputes
the same result from the raw tables with plain SQL.
"""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchwright import fs
from batchwright.functions.stamps import batch_date_col
from batchwright.operators import control, scd2
from batchwright.operators.loads import append_load, first_load, scd_load
from batchwright.plans import DRIVER_FACT_TABLE, bootstrap, derived, driver_basic_registry, driver_registry, load_once, replay
from batchwright.plans.catalog import replay_with_views
from batchwright.plans.pipeline import check_batch, concurrently
from batchwright.plans.registry import DRIVER_SCHEMAS, REFERENCE_BASIC_TABLES, REFERENCE_BATCH_TABLES, REFERENCE_FACT_TABLE, reference_basic_registry, reference_batch_registry
from batchwright.session import scratch_dir, shuffle_files_cleaned
from batchwright.sinks import JdbcStore, LakeStore, PartitionedStore
from batchwright.sources import manifest_frame, read_delimited, read_jdbc
from batchwright.sources.jdbc import read_jdbc_equi_depth
from batchwright.sources.delimited import write_delimited
from batchwright.sources.manifest import entries_for, manifest, manifest_scan
from batchwright.specs import APPEND, SCD

SF_SMOKE = "/root/testdata/sf0.001"
B1, B2, B3 = (d.isoformat() for d in derived.BATCH_DATES)



def _reg():
    """The driver-table registry (parsing DDL needs a running session)."""
    global _REG
    if _REG is None:
        _REG = driver_registry()
    return _REG


_REG = None


# ------------------------------------------------------------------ helpers
def _ws(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, f"q-{label}")


def _loaded(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], batches: tuple[int, ...], mode: str = "strict", label: str = "load") -> LakeStore:
    """Write derived batches for ``tables`` and replay them into a new store."""
    ws = _ws(spark, label)
    derived.write_batches(spark, sf_dir, f"{ws}/src", tables=tables, batches=batches)
    store = LakeStore(spark, f"{ws}/lake")
    replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE, mode=mode)
    return store


def _scd_run(spark: SparkSession, sf_dir: str, builder, batches: tuple[int, ...], mode: str, label: str) -> DataFrame:
    """customer batches from ``builder`` replayed in ``mode``."""
    ws = _ws(spark, label)
    base = derived.table(spark, sf_dir, "customer")
    for n in batches:
        derived.write_batch_frame(builder(base, n), f"{ws}/src", n, "customer")
    store = LakeStore(spark, f"{ws}/lake")
    replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE, mode=mode)
    return store.read("customer")


# ------------------------------------------------------------------ queries
def q_delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, "scan")
    derived.write_batch_frame(derived.table(spark, sf_dir, "orders"), f"{ws}/src", 1, "orders")
    return read_delimited(spark, f"{ws}/src/{derived.batch_name(1)}/orders", _reg()["orders"].schema)


def q_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, "full")
    derived.write_one_time_files(spark, sf_dir, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    load_once(spark, store, driver_basic_registry(), f"{ws}/src")
    parts = [
        store.read("customers").agg(F.lit("customers").alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").cast("bigint").alias("key_sum")),
        store.read("nation").agg(F.lit("nation").alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum("n_nationkey").cast("bigint").alias("key_sum")),
        store.read("region").agg(F.lit("region").alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum("r_regionkey").cast("bigint").alias("key_sum")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_first_load_scd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, ("customer",), (1,), label="first-scd").read("customer")


def q_first_load_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, ("part",), (1,), label="first-stamped").read("part")


def q_truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, ("part",), (1, 2), label="truncate").read("part")


def q_append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, ("orders",), (1, 2, 3), label="append").read("orders")


def _customer_b1_target_and_b2(spark: SparkSession, sf_dir: str, label: str):
    store = _loaded(spark, sf_dir, ("customer",), (1,), label=label)
    ws = _ws(spark, f"{label}-src")
    derived.write_batch_frame(derived.batch_frame(spark, sf_dir, "customer", 2), ws, 2, "customer")
    source = read_delimited(spark, f"{ws}/{derived.batch_name(2)}/customer", _reg()["customer"].schema)
    return store.read("customer"), source


def q_unchanged_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _customer_b1_target_and_b2(spark, sf_dir, "unchanged")
    return scd2.unchanged_keys(source, target, "c_custkey", ["c_name", "c_mktsegment"])


def q_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _customer_b1_target_and_b2(spark, sf_dir, "changed")
    cols = ["c_name", "c_mktsegment"]
    compat = scd2.changed_rows(source, target, "c_custkey", cols, scd2.COMPAT).withColumn("mode", F.lit("compat"))
    strict = scd2.changed_rows(source, target, "c_custkey", cols, scd2.STRICT).withColumn("mode", F.lit("strict"))
    return compat.unionByName(strict)


def q_scd2_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, ("customer",), (1, 2), mode="strict", label="strict").read("customer")


def q_scd2_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, ("customer",), (1, 2), mode="compat", label="compat").read("customer")


def q_scd2_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = [
        _scd_run(spark, sf_dir, derived.customer_nulls_batch, (1, 2), m, f"nulls-{m}").withColumn("mode", F.lit(m))
        for m in (scd2.STRICT, scd2.COMPAT)
    ]
    return out[0].unionByName(out[1])


def q_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = [
        _scd_run(spark, sf_dir, derived.customer_batch, (1, 2, 3), m, f"hist-{m}").withColumn("mode", F.lit(m))
        for m in (scd2.STRICT, scd2.COMPAT)
    ]
    return out[0].unionByName(out[1])


HWM_CANDIDATES = ("batch_2022-11-01", "batch_2022-11-02", "batch_2022-11-02T120000", "batch_2022-11-03")


def q_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _loaded(spark, sf_dir, ("orders",), (1, 2), label="hwm")
    mark = control.high_water_mark_frame(store.read("orders"))
    cands = F.array(*[F.struct(F.lit(b).alias("batch"), batch_date_col(F.lit(b)).alias("batch_date")) for b in HWM_CANDIDATES])
    return (
        mark.select(F.explode(cands).alias("c"), "high_water_mark")
        .select(
            "c.batch",
            "c.batch_date",
            "high_water_mark",
            (F.col("high_water_mark").isNull() | (F.col("c.batch_date") > F.col("high_water_mark"))).alias("is_new"),
        )
    )


def q_tables_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, "present")
    derived.write_one_time_files(spark, sf_dir, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    reg = driver_basic_registry()
    names = [s.target for s in reg] + ["orders"]
    before = control.tables_present(store, names)
    loaded_first = bootstrap(spark, store, reg, f"{ws}/src")
    loaded_again = bootstrap(spark, store, reg, f"{ws}/src")
    assert loaded_first and not loaded_again
    after = control.tables_present(store, names)
    parts = []
    for n in names:
        counted = store.read(n).agg(F.count(F.lit(1)).alias("n_rows")) if after[n] else spark.range(1).select(F.lit(0).cast("bigint").alias("n_rows"))
        parts.append(
            counted.select(
                F.lit(n).alias("table_name"),
                F.lit(before[n]).alias("present_before"),
                F.lit(after[n]).alias("present_after"),
                "n_rows",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, "manifest")
    root = f"{ws}/src"
    derived.write_batches(spark, sf_dir, root, tables=("customer", "part", "orders"), batches=(1, 2, 3))
    # a folder that is not a batch is ignored
    derived.write_batch_frame(derived.table(spark, sf_dir, "region"), f"{ws}/src/staging", 1, "region")
    assert [e.table for e in manifest(spark, root)][:3] == ["customer", "orders", "part"]
    return manifest_frame(spark, root)


def q_record_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bad records and NULL fields per table folder of one batch:
    customer with unparsable fields, part as is."""
    root = f"{_ws(spark, 'records')}/src"
    derived.write_batch_frame(derived.customer_malformed_batch(derived.table(spark, sf_dir, "customer")), root, 1, "customer")
    derived.write_batch_frame(derived.table(spark, sf_dir, "part"), root, 1, "part")
    return check_batch(spark, _reg(), entries_for(manifest(spark, root), derived.batch_name(1)))


REPLAYED = ("customer", "supplier", "part", "nation", "region", "orders")


def q_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay_summary(_loaded(spark, sf_dir, REPLAYED, (1, 2, 3), label="replay"))


def _replay_summary(store) -> DataFrame:
    """One row a table of a replayed store."""
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "nation": "n_nationkey", "region": "r_regionkey", "orders": "o_orderkey"}
    b1 = F.lit(derived.BATCH_DATES[0])
    out = None
    for t, k in keys.items():
        df = store.read(t)
        scd = "end_date" in df.columns
        start = F.col("start_date") if scd else F.col("batched_at")
        part = df.agg(
            F.lit(t).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            (F.count_if(F.col("end_date").isNull()) if scd else F.lit(None).cast("bigint")).alias("n_open"),
            F.sum(F.col(k)).cast("bigint").alias("key_sum"),
            F.sum(F.datediff(start, b1)).cast("bigint").alias("start_days"),
            (F.sum(F.datediff(F.col("end_date"), b1)) if scd else F.lit(None)).cast("bigint").alias("end_days"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def q_jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer b1 then b2 (strict) into an in-process Derby database,
    read back with a range-partitioned JDBC scan."""
    url = f"jdbc:derby:memory:bw{uuid.uuid4().hex[:10]};create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    store = JdbcStore(spark, url, opts, keys={"customer": "c_custkey"})
    spec = _reg()["customer"]
    ws = _ws(spark, "jdbc")
    for n in (1, 2):
        derived.write_batch_frame(derived.batch_frame(spark, sf_dir, "customer", n), ws, n, "customer")
    src = [read_delimited(spark, f"{ws}/{derived.batch_name(n)}/customer", spec.schema) for n in (1, 2)]
    first_load(store, spec, src[0], derived.BATCH_DATES[0])
    scd_load(store, spec, src[1], derived.BATCH_DATES[1], scd2.STRICT)
    df = read_jdbc(spark, url, "customer", opts, partition_column="c_custkey", num_partitions=4)
    return df.toDF(*[c.lower() for c in df.columns])


def q_jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders b1, b2, b2 again (a retry) and b3 appended to Derby: the retry
    replaces the batch's rows instead of doubling them."""
    url = f"jdbc:derby:memory:bw{uuid.uuid4().hex[:10]};create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    store = JdbcStore(spark, url, opts)
    spec = _reg()["orders"]
    first_load(store, spec, derived.batch_frame(spark, sf_dir, "orders", 1), derived.BATCH_DATES[0])
    append_load(store, spec, derived.batch_frame(spark, sf_dir, "orders", 2), derived.BATCH_DATES[1])
    append_load(store, spec, derived.batch_frame(spark, sf_dir, "orders", 2), derived.BATCH_DATES[1])
    append_load(store, spec, derived.batch_frame(spark, sf_dir, "orders", 3), derived.BATCH_DATES[2])
    return store.read("orders")


def q_jdbc_equidepth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with a skewed column, written to Derby and read back in ranges of about
    equally many rows."""
    url = f"jdbc:derby:memory:bw{uuid.uuid4().hex[:10]};create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    low = F.col("o_orderkey") % 1000
    rows = derived.table(spark, sf_dir, "orders").select("o_orderkey", (low * low * low).alias("o_skew"), "o_totalprice", "o_orderdate")
    rows.write.jdbc(url, "orders", properties=opts)
    return read_jdbc_equi_depth(spark, url, "orders", "o_skew", 8, opts)


def q_jdbc_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables and three batches replayed twice into Derby, tables of a batch side by
    side; the second run finds in the database that it has nothing to load."""
    ws = _ws(spark, "jdbc-replay")
    derived.write_batches(spark, sf_dir, f"{ws}/src", tables=REPLAYED)
    url = f"jdbc:derby:memory:bw{uuid.uuid4().hex[:10]};create=true"
    keys = {"customer": "c_custkey", "supplier": "s_suppkey"}
    store = JdbcStore(spark, url, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, keys=keys)
    for _ in range(2):
        reports = replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE)
    if {r.status for r in reports} != {"not_new"}:
        raise AssertionError(f"the second replay loaded something: {reports}")
    return _replay_summary(store)


def q_replay_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer: b1 with a fact, then an unchanged and a changed batch without
    one, replayed twice: the second run changes nothing."""
    ws = _ws(spark, "rerun")
    root = f"{ws}/src"
    derived.write_batch_frame(derived.batch_frame(spark, sf_dir, "orders", 1), root, 1, "orders")
    for n, content in ((1, 1), (2, 1), (3, 2)):
        derived.write_batch_frame(derived.batch_frame(spark, sf_dir, "customer", content), root, n, "customer")
    store = LakeStore(spark, f"{ws}/lake")
    for _ in range(2):
        replay(spark, store, _reg(), root, DRIVER_FACT_TABLE)
    return store.read("customer")


def q_nested_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer b1 with its part files two folders further down."""
    ws = _ws(spark, "nested")
    derived.write_batch_frame(derived.batch_frame(spark, sf_dir, "customer", 1), f"{ws}/src", 1, "customer/x/y")
    store = LakeStore(spark, f"{ws}/lake")
    replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE)
    return store.read("customer")


def _shuffled(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """customer b1 then b2 with broadcasting off, so the merge shuffles."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return _loaded(spark, sf_dir, ("customer",), (1, 2), mode=mode, label=f"shuffled-{mode}").read("customer")
    finally:
        spark.conf.set(key, before)


def q_scd2_strict_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir, scd2.STRICT)


def q_scd2_compat_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir, scd2.COMPAT)


def q_scd2_nochange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer b1 and the same rows again as b2, in both modes: no version changes."""
    out = [
        _scd_run(spark, sf_dir, lambda base, n: derived.customer_batch(base, 1), (1, 2), m, f"nochange-{m}").withColumn("mode", F.lit(m))
        for m in (scd2.STRICT, scd2.COMPAT)
    ]
    return out[0].unionByName(out[1])


def q_catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer by its catalog name after b1 (nothing closed yet) and after b2."""
    ws = _ws(spark, "views")
    store, out, db = LakeStore(spark, f"{ws}/lake"), [], f"bw_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db}")
    for n in (1, 2):
        derived.write_batches(spark, sf_dir, f"{ws}/src", tables=("customer",), batches=(n,))
        replay_with_views(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE, database=db)
        view = spark.table(f"{db}.customer")
        out.append(view.select("*", F.typeof("end_date").alias("end_date_type"), F.lit(n).alias("after_batch")))
    return out[0].unionByName(out[1])


def _partitioned(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], label: str, builder=None) -> PartitionedStore:
    """Batches 1 to 3 of ``tables`` (customer by ``builder``) replayed into a partitioned store."""
    ws = _ws(spark, label)
    for n in (1, 2, 3):
        for t in tables:
            rows = builder(derived.table(spark, sf_dir, t), n) if builder else derived.batch_frame(spark, sf_dir, t, n)
            derived.write_batch_frame(rows, f"{ws}/src", n, t)
    store = PartitionedStore(spark, f"{ws}/lake", buckets=8)
    replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE)
    return store


def q_scd2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer b1 to b3, strict, merged bucket by bucket: open and closed versions."""
    return _partitioned(spark, sf_dir, ("customer",), "bucketed").read("customer")


def q_scd2_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with NULLs in change columns and keys: the digest probe decides as ``<=>`` does."""
    return _partitioned(spark, sf_dir, ("customer",), "digest", derived.customer_nulls_batch).read("customer")


def q_append_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem b1 to b3 into date partitions, b2 twice: the retry replaces its own rows."""
    store = _partitioned(spark, sf_dir, ("lineitem",), "lineitem")
    append_load(store, _reg()["lineitem"], derived.batch_frame(spark, sf_dir, "lineitem", 2), derived.BATCH_DATES[1])
    return store.read("lineitem")


def q_manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files by a metadata scan: at the top, in a folder called ``part*``, further down,
    and beside files that are no input."""
    root = f"{_ws(spark, 'manifest-scan')}/src"
    places = {"customer": "customer", "part": "part/part-group=1", "supplier": "supplier/x/y"}
    for t, place in places.items():
        write_delimited(derived.table(spark, sf_dir, t).repartition(3), f"{root}/{derived.batch_name(1)}/{place}")
    write_delimited(derived.table(spark, sf_dir, "region").repartition(1), f"{root}/{derived.batch_name(1)}/customer/_old")
    write_delimited(derived.table(spark, sf_dir, "nation").repartition(1), f"{root}/{derived.batch_name(2)}T120000/nation/part-x/part-y")
    found = manifest_scan(spark, root)
    listed = {(e.batch, e.table) for e in manifest(spark, root) if e.n_parts}
    scanned = {(r["batch"], r["table_name"]) for r in found.collect()}  # one row a table folder
    return found.select("batch", "batch_date", "table_name", "n_parts", (F.col("bytes") > 0).alias("has_bytes"), F.lit(listed == scanned).alias("as_listed"))


def q_unchanged_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q_unchanged_keys with a Bloom filter of the source's tuples on the target scan."""
    target, source = _customer_b1_target_and_b2(spark, sf_dir, "bloom")
    return scd2.unchanged_keys(source, target, "c_custkey", ["c_name", "c_mktsegment"], bloom=True)


def q_replay_part_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer b1 whose files lie in a folder called ``part*``, replayed."""
    ws = _ws(spark, "part-folder")
    derived.write_batch_frame(derived.batch_frame(spark, sf_dir, "customer", 1), f"{ws}/src", 1, "customer/part-group=1")
    store = LakeStore(spark, f"{ws}/lake")
    replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE)
    return store.read("customer")


def q_replay_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer and orders b1, then b2 as a second batch of the same day, replayed twice:
    it loads once, into both stores alike."""
    ws, day = _ws(spark, "same-day"), derived.batch_name(1)
    for n, folder in ((1, day), (2, f"{day}T120000")):
        for t in ("customer", "orders"):
            write_delimited(derived.batch_frame(spark, sf_dir, t, n), f"{ws}/src/{folder}/{t}")
    out = []
    for name, store in (("lake", LakeStore(spark, f"{ws}/lake")), ("partitioned", PartitionedStore(spark, f"{ws}/partitioned", buckets=8))):
        for _ in range(2):
            replay(spark, store, _reg(), f"{ws}/src", DRIVER_FACT_TABLE)
        orders = store.read("orders").groupBy("batched_at").agg(F.count(F.lit(1)).alias("n_orders"))
        out.append(store.read("customer").join(orders, F.col("start_date") == F.col("batched_at"), "left").drop("batched_at").withColumn("store", F.lit(name)))
    return out[0].unionByName(out[1])


#: ``ROUND`` of a double, halves away from zero, without the decimal number that Spark's own makes
#: of each: a double's distance to its nearest whole number is exact.
NEAREST = "CASE WHEN ABS({0} - RINT({0})) = 0.5D THEN {0} + 0.5D * SIGNUM({0}) ELSE RINT({0}) END"


def _row_text(fields: list[tuple[str, str]], nearest: str = "ROUND({0})") -> str:
    """SQL text of a whole row as one string, the same in Spark and in DuckDB: doubles in hundredths, NULL as ``~``."""
    each = (f"COALESCE(CAST({f'CAST({nearest.format(f'{c} * 100')} AS BIGINT)' if t == 'double' else c} AS VARCHAR(4000)), '~')" for c, t in fields)
    return f"CONCAT_WS('|', {', '.join(each)})"


def _row_texts(store, tables: list[str], mode: str = "strict") -> DataFrame:
    """Every row of every table, as ``table_name, mode, row_text``."""
    out = None
    for t in tables:
        df = store.read(t)
        part = df.select(F.lit(t).alias("table_name"), F.lit(mode).alias("mode"), F.expr(_row_text(df.dtypes, NEAREST)).alias("row_text"))
        out = part if out is None else out.unionByName(part)
    return out


MODES = (scd2.STRICT, scd2.COMPAT)


def _in_both_modes(spark: SparkSession, run: Callable[[str], DataFrame]) -> list[DataFrame]:
    """``run`` in each mode, side by side (each into a store of its own)."""
    return concurrently(spark, {mode: lambda m=mode: run(m) for mode in MODES}, len(MODES))


def _drop_when_loaded(spark: SparkSession, root: str) -> Callable[[str], None]:
    """To be told of each batch that a mode has loaded; deletes the batch's folder below
    ``root`` once every mode has, as nothing reads it any more."""
    loaded, lock = Counter(), threading.Lock()

    def after_batch(batch: str) -> None:
        with lock:
            loaded[batch] += 1
            last = loaded[batch] == len(MODES)
        if last:
            fs.delete(spark, f"{root}/{batch}")

    return after_batch


def q_original_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine original tables (three SCD schemas, a double change column, the sparse
    ``c_login``), two batches replayed in both modes: every row of every table.

    Disk holds the batches that a mode still has to load, the newest version of each table
    and the shuffle files of what runs."""
    ws = _ws(spark, "original")
    derived.write_original_batches(spark, sf_dir, f"{ws}/src")
    after_batch = _drop_when_loaded(spark, f"{ws}/src")

    def loaded(mode: str) -> DataFrame:
        store = LakeStore(spark, f"{ws}/{mode}", retain_versions=1, compression="zstd")
        replay(spark, store, reference_batch_registry(), f"{ws}/src", REFERENCE_FACT_TABLE, mode=mode, after_batch=after_batch)
        return _row_texts(store, [s.target for s in REFERENCE_BATCH_TABLES], mode)

    with shuffle_files_cleaned(spark):
        out = _in_both_modes(spark, loaded)
    return out[0].unionByName(out[1])


def q_original_one_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three files of the original one-time load: every row of every table."""
    ws = _ws(spark, "original-once")
    derived.write_original_files(spark, sf_dir, f"{ws}/src")
    store = LakeStore(spark, f"{ws}/lake")
    load_once(spark, store, reference_basic_registry(), f"{ws}/src")
    return _row_texts(store, [s.target for s in REFERENCE_BASIC_TABLES], "full")


def q_replay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q_replay in both modes: every row of every table."""
    out = _in_both_modes(spark, lambda m: _row_texts(_loaded(spark, sf_dir, REPLAYED, (1, 2, 3), mode=m, label=f"replay-{m}"), list(REPLAYED), m))
    return out[0].unionByName(out[1])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_delimited_scan": q_delimited_scan,
    "q_full_load": q_full_load,
    "q_first_load_scd": q_first_load_scd,
    "q_first_load_stamped": q_first_load_stamped,
    "q_truncate_load": q_truncate_load,
    "q_append_load": q_append_load,
    "q_unchanged_keys": q_unchanged_keys,
    "q_changed_rows": q_changed_rows,
    "q_scd2_strict": q_scd2_strict,
    "q_scd2_compat": q_scd2_compat,
    "q_scd2_nulls": q_scd2_nulls,
    "q_scd2_history": q_scd2_history,
    "q_high_water_mark": q_high_water_mark,
    "q_tables_present": q_tables_present,
    "q_manifest": q_manifest,
    "q_record_check": q_record_check,
    "q_replay": q_replay,
    "q_jdbc_roundtrip": q_jdbc_roundtrip,
    "q_jdbc_append": q_jdbc_append,
    "q_jdbc_equidepth": q_jdbc_equidepth,
    "q_jdbc_replay": q_jdbc_replay,
    "q_replay_rerun": q_replay_rerun,
    "q_nested_parts": q_nested_parts,
    "q_scd2_strict_shuffled": q_scd2_strict_shuffled,
    "q_scd2_compat_shuffled": q_scd2_compat_shuffled,
    "q_scd2_nochange": q_scd2_nochange,
    "q_catalog_views": q_catalog_views,
    "q_scd2_bucketed": q_scd2_bucketed,
    "q_scd2_digest": q_scd2_digest,
    "q_append_lineitem": q_append_lineitem,
    "q_manifest_scan": q_manifest_scan,
    "q_unchanged_bloom": q_unchanged_bloom,
    "q_replay_part_folder": q_replay_part_folder,
    "q_replay_same_day": q_replay_same_day,
    "q_original_tables": q_original_tables,
    "q_original_one_time": q_original_one_time,
    "q_replay_rows": q_replay_rows,
}


# ------------------------------------------------------------------ oracle SQL
C_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
S_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
P_COLS = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"
O_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority"
O_STAMP = (
    "CASE WHEN CAST(o_orderdate AS DATE) < DATE '1997-01-01' THEN DATE '2022-11-01' "
    "WHEN CAST(o_orderdate AS DATE) <= DATE '1998-12-31' THEN DATE '2022-11-02' ELSE DATE '2022-11-03' END"
)


def _c_batch(n: int, nulls: bool = False) -> str:
    base = (
        "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)"
        if nulls
        else "customer"
    )
    if n == 1:
        return f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {base} b"
    seg = "CASE WHEN c_custkey % 10 = 0 THEN 'CHANGED' ELSE c_mktsegment END"
    if n == 3:
        seg = "CASE WHEN c_custkey % 20 = 0 THEN c_mktsegment WHEN c_custkey % 10 = 0 THEN 'CHANGED' ELSE c_mktsegment END"
    sql = (
        f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, {seg} AS c_mktsegment FROM {base} b "
        f"UNION ALL SELECT -1 - c_custkey AS c_custkey, 'New#' || CAST(-1 - c_custkey AS VARCHAR) AS c_name, "
        f"c_nationkey, c_acctbal, c_mktsegment FROM {base} b WHERE c_custkey < 7"
    )
    if nulls:
        sql += f" UNION ALL SELECT CAST(NULL AS BIGINT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {base} b WHERE c_custkey % 25 = 1"
    return sql


def _s_batch(n: int) -> str:
    bal = "s_acctbal" if n == 1 else "CASE WHEN s_suppkey % 4 = 0 THEN s_acctbal + 100 ELSE s_acctbal END"
    nat = "CASE WHEN s_suppkey % 6 = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END" if n == 3 else "s_nationkey"
    return f"SELECT s_suppkey, s_name, {nat} AS s_nationkey, {bal} AS s_acctbal FROM supplier"


def _first(src: str, cols: list[str], b: str) -> str:
    return f"SELECT {', '.join(cols)}, DATE '{b}' AS start_date, CAST(NULL AS DATE) AS end_date FROM {src}"


def _strict(t: str, s: str, key: str, cols: list[str], change: list[str], b: str) -> str:
    eq = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in change)
    tc = ", ".join(f"t.{c}" for c in cols)
    sc = ", ".join(f"s.{c}" for c in cols)
    return (
        f"SELECT {tc}, t.start_date, CASE WHEN t.end_date IS NULL AND EXISTS (SELECT 1 FROM {s} s WHERE s.{key} = t.{key} AND NOT ({eq})) "
        f"THEN DATE '{b}' ELSE t.end_date END AS end_date FROM {t} t "
        f"UNION ALL SELECT {sc}, DATE '{b}' AS start_date, CAST(NULL AS DATE) AS end_date FROM {s} s "
        f"WHERE s.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {t} t WHERE t.end_date IS NULL AND t.{key} = s.{key} AND {eq})"
    )


def _compat(out: str, t: str, s: str, key: str, cols: list[str], change: list[str], b: str) -> list[str]:
    """CTE definitions (``name AS (...)``) computing compat step ``out``."""
    eq = " AND ".join(f"t.{c} = s.{c}" for c in change)
    cl = ", ".join(cols)
    return [
        f"{out}_u AS (SELECT DISTINCT t.{key} FROM {t} t JOIN {s} s ON {eq} WHERE t.{key} IS NOT NULL)",
        f"{out}_n AS (SELECT * FROM {s} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {out}_u))",
        f"{out}_a AS (SELECT {cl}, start_date FROM {t} UNION ALL SELECT {cl}, DATE '{b}' AS start_date FROM {out}_n)",
        f"{out} AS (SELECT {cl}, start_date, CASE WHEN {key} IN (SELECT {key} FROM {out}_n) THEN DATE '{b}' ELSE CAST(NULL AS DATE) END AS end_date "
        f"FROM {out}_a WHERE EXISTS (SELECT 1 FROM {out}_n) "
        f"UNION ALL SELECT {cl}, start_date, end_date FROM {t} WHERE NOT EXISTS (SELECT 1 FROM {out}_n))",
    ]


def _scd_chain(prefix: str, batch_sql, n_batches: int, mode: str, key="c_custkey", cols=C_COLS, change=("c_name", "c_mktsegment")) -> tuple[list[str], str]:
    dates = [B1, B2, B3]
    ctes = [f"{prefix}s{n} AS ({batch_sql(n)})" for n in range(1, n_batches + 1)]
    ctes.append(f"{prefix}t1 AS ({_first(f'{prefix}s1', cols, B1)})")
    for n in range(2, n_batches + 1):
        t, s, out = f"{prefix}t{n - 1}", f"{prefix}s{n}", f"{prefix}t{n}"
        if mode == "strict":
            ctes.append(f"{out} AS ({_strict(t, s, key, cols, list(change), dates[n - 1])})")
        else:
            ctes.extend(_compat(out, t, s, key, cols, list(change), dates[n - 1]))
    return ctes, f"{prefix}t{n_batches}"


def _with(ctes: list[str], select: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


def _scd_sql(mode: str, n: int, nulls: bool = False) -> str:
    ctes, last = _scd_chain("x", lambda k: _c_batch(k, nulls), n, mode)
    return _with(ctes, f"SELECT * FROM {last}")


def _scd_both(n: int, nulls: bool) -> str:
    s_ctes, s_last = _scd_chain("st", lambda k: _c_batch(k, nulls), n, "strict")
    c_ctes, c_last = _scd_chain("cp", lambda k: _c_batch(k, nulls), n, "compat")
    return _with(s_ctes + c_ctes, f"SELECT *, 'strict' AS mode FROM {s_last} UNION ALL SELECT *, 'compat' AS mode FROM {c_last}")


def _replay_sql() -> str:
    c_ctes, c_last = _scd_chain("c", _c_batch, 3, "strict")
    s_ctes, s_last = _scd_chain("s", _s_batch, 3, "strict", key="s_suppkey", cols=S_COLS, change=("s_name", "s_nationkey", "s_acctbal"))

    def scd(name, src, key):
        return (
            f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE end_date IS NULL) AS n_open, "
            f"CAST(sum({key}) AS BIGINT) AS key_sum, CAST(sum(date_diff('day', DATE '{B1}', start_date)) AS BIGINT) AS start_days, "
            f"CAST(sum(date_diff('day', DATE '{B1}', end_date)) AS BIGINT) AS end_days FROM {src}"
        )

    def stamped(name, src, key, stamp):
        return (
            f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(NULL AS BIGINT) AS n_open, "
            f"CAST(sum({key}) AS BIGINT) AS key_sum, CAST(sum(date_diff('day', DATE '{B1}', {stamp})) AS BIGINT) AS start_days, "
            f"CAST(NULL AS BIGINT) AS end_days FROM {src}"
        )

    return _with(
        c_ctes + s_ctes,
        " UNION ALL ".join(
            [
                scd("customer", c_last, "c_custkey"),
                scd("supplier", s_last, "s_suppkey"),
                stamped("part", "(SELECT * FROM part WHERE p_size > 20)", "p_partkey", f"DATE '{B3}'"),
                stamped("nation", "nation", "n_nationkey", f"DATE '{B3}'"),
                stamped("region", "region", "r_regionkey", f"DATE '{B3}'"),
                stamped("orders", "orders", "o_orderkey", O_STAMP),
            ]
        ),
    )


def _changed_rows_sql() -> str:
    ctes = [f"s2 AS ({_c_batch(2)})", f"t1 AS ({_first('customer', C_COLS, B1)})"]
    ctes += ["u AS (SELECT DISTINCT t.c_custkey FROM t1 t JOIN s2 s ON t.c_name = s.c_name AND t.c_mktsegment = s.c_mktsegment WHERE t.c_custkey IS NOT NULL)"]
    compat = "SELECT *, 'compat' AS mode FROM s2 WHERE c_custkey IS NOT NULL AND c_custkey NOT IN (SELECT c_custkey FROM u)"
    strict = (
        "SELECT *, 'strict' AS mode FROM s2 s WHERE c_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t1 t WHERE t.end_date IS NULL "
        "AND t.c_custkey = s.c_custkey AND t.c_name IS NOT DISTINCT FROM s.c_name AND t.c_mktsegment IS NOT DISTINCT FROM s.c_mktsegment)"
    )
    return _with(ctes, f"{compat} UNION ALL {strict}")


def _hwm_sql() -> str:
    vals = ", ".join(f"('{b}', DATE '{b.split('_')[1][:10]}')" for b in HWM_CANDIDATES)
    return (
        f"WITH m AS (SELECT max({O_STAMP}) AS high_water_mark FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-12-31'), "
        f"c(batch, batch_date) AS (VALUES {vals}) "
        "SELECT c.batch, c.batch_date, m.high_water_mark, (m.high_water_mark IS NULL OR c.batch_date > m.high_water_mark) AS is_new FROM c, m"
    )


def _manifest_sql() -> str:
    parts = []
    for n, d in enumerate([B1, B2, B3], start=1):
        parts.append(f"SELECT 'batch_{d}' AS batch, DATE '{d}' AS batch_date, 'customer' AS table_name, count(*) AS n_records FROM ({_c_batch(n)}) x")
        p_where = "" if n == 1 else f" WHERE p_size > {10 if n == 2 else 20}"
        parts.append(f"SELECT 'batch_{d}' AS batch, DATE '{d}' AS batch_date, 'part' AS table_name, count(*) AS n_records FROM part{p_where}")
        parts.append(f"SELECT 'batch_{d}' AS batch, DATE '{d}' AS batch_date, 'orders' AS table_name, count(*) AS n_records FROM orders WHERE {O_STAMP} = DATE '{d}'")
    return " UNION ALL ".join(parts)


def _record_check_sql() -> str:
    def nulls(cols, bad=None):
        bad = bad or {}
        terms = [f"CAST({c} IS NULL{(' OR ' + bad[c]) if c in bad else ''} AS BIGINT)" for c in cols]
        return "CAST(sum(" + " + ".join(terms) + ") AS BIGINT)"

    c_bad = {"c_acctbal": "c_custkey % 13 = 0", "c_nationkey": "c_custkey % 17 = 0"}
    p_cols = [c.strip() for c in P_COLS.split(",")]
    return (
        "SELECT 'customer' AS table_name, count(*) AS rows, "
        "count(*) FILTER (WHERE c_custkey % 13 = 0 OR c_custkey % 17 = 0) AS bad_records, "
        f"{nulls(C_COLS, c_bad)} AS null_fields FROM customer "
        f"UNION ALL SELECT 'part', count(*), CAST(0 AS BIGINT), {nulls(p_cols)} FROM part"
    )


ORACLE: dict[str, str] = {
    "q_delimited_scan": f"SELECT {O_COLS} FROM orders",
    "q_full_load": (
        "SELECT 'customers' AS table_name, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer "
        "UNION ALL SELECT 'nation', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation "
        "UNION ALL SELECT 'region', count(*), CAST(sum(r_regionkey) AS BIGINT) FROM region"
    ),
    "q_first_load_scd": _first("customer", C_COLS, B1),
    "q_first_load_stamped": f"SELECT {P_COLS}, DATE '{B1}' AS batched_at FROM part",
    "q_truncate_load": f"SELECT {P_COLS}, DATE '{B2}' AS batched_at FROM part WHERE p_size > 10",
    "q_append_load": f"SELECT {O_COLS}, {O_STAMP} AS batched_at FROM orders",
    "q_unchanged_keys": _with(
        [f"s2 AS ({_c_batch(2)})"],
        "SELECT DISTINCT t.c_custkey FROM customer t JOIN s2 s ON s.c_name = t.c_name AND s.c_mktsegment = t.c_mktsegment",
    ),
    "q_changed_rows": _changed_rows_sql(),
    "q_scd2_strict": _scd_sql("strict", 2),
    "q_scd2_compat": _scd_sql("compat", 2),
    "q_scd2_nulls": _scd_both(2, nulls=True),
    "q_scd2_history": _scd_both(3, nulls=False),
    "q_high_water_mark": _hwm_sql(),
    "q_tables_present": (
        "SELECT 'customers' AS table_name, false AS present_before, true AS present_after, count(*) AS n_rows FROM customer "
        "UNION ALL SELECT 'nation', false, true, count(*) FROM nation "
        "UNION ALL SELECT 'region', false, true, count(*) FROM region "
        "UNION ALL SELECT 'orders', false, false, CAST(0 AS BIGINT)"
    ),
    "q_manifest": _manifest_sql(),
    "q_record_check": _record_check_sql(),
    "q_replay": _replay_sql(),
    "q_jdbc_equidepth": "SELECT o_orderkey, (o_orderkey % 1000) * (o_orderkey % 1000) * (o_orderkey % 1000) AS o_skew, "
    "o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "q_jdbc_replay": _replay_sql(),
    "q_jdbc_roundtrip": _scd_sql("strict", 2),
    "q_jdbc_append": f"SELECT {O_COLS}, {O_STAMP} AS batched_at FROM orders",
}
ORACLE |= {
    "q_replay_rerun": ORACLE["q_scd2_strict"].replace(B2, B3),
    "q_nested_parts": ORACLE["q_first_load_scd"],
    "q_scd2_strict_shuffled": ORACLE["q_scd2_strict"],
    "q_scd2_compat_shuffled": ORACLE["q_scd2_compat"],
    "q_scd2_nochange": " UNION ALL ".join(f"SELECT *, '{m}' AS mode FROM ({ORACLE['q_first_load_scd']}) x" for m in ("strict", "compat")),
    "q_catalog_views": " UNION ALL ".join(
        f"SELECT *, 'date' AS end_date_type, {n} AS after_batch FROM ({ORACLE[q]}) x" for n, q in ((1, "q_first_load_scd"), (2, "q_scd2_strict"))
    ),
}


def _lineitem_sql() -> str:
    cols = ", ".join(c if c != "l_shipdate" else "CAST(l_shipdate AS DATE) AS l_shipdate" for c in (x.strip().split(" ")[0] for x in DRIVER_SCHEMAS["lineitem"].split(",")))
    return f"SELECT {cols}, {O_STAMP.replace('o_orderdate', 'l_shipdate')} AS batched_at FROM lineitem"


def _same_day_sql() -> str:
    ctes = [f"s1 AS ({_c_batch(1)})", f"s2 AS ({_c_batch(2)})", f"t1 AS ({_first('s1', C_COLS, B1)})"]
    ctes.append(f"t2 AS ({_strict('t1', 's2', 'c_custkey', C_COLS, ['c_name', 'c_mktsegment'], B1)})")
    ctes.append(f"o AS (SELECT count(*) AS n_orders FROM orders WHERE {O_STAMP} <> DATE '{B3}')")
    return _with(ctes, "SELECT t2.*, n_orders, store FROM t2, o, (VALUES ('lake'), ('partitioned')) v(store)")


ORACLE |= {
    "q_scd2_bucketed": _scd_sql("strict", 3),
    "q_scd2_digest": _scd_sql("strict", 3, nulls=True),
    "q_append_lineitem": _lineitem_sql(),
    "q_manifest_scan": (
        f"SELECT 'batch_{B1}' AS batch, DATE '{B1}' AS batch_date, t AS table_name, CAST(3 AS BIGINT) AS n_parts, true AS has_bytes, true AS as_listed "
        "FROM (VALUES ('customer'), ('part'), ('supplier')) v(t) "
        f"UNION ALL SELECT 'batch_{B2}T120000', DATE '{B2}', 'nation', CAST(1 AS BIGINT), true, true"
    ),
    "q_unchanged_bloom": ORACLE["q_unchanged_keys"],
    "q_replay_part_folder": ORACLE["q_first_load_scd"],
    "q_replay_same_day": _same_day_sql(),
}


def _texts_sql(ctes: list[str], tables: list[tuple[str, str, str, list[tuple[str, str]]]]) -> str:
    """:func:`_row_texts` of (table, mode, relation, fields) over ``ctes``."""
    return _with(ctes, " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{m}' AS mode, {_row_text(f)} AS row_text FROM {rel} x" for t, m, rel, f in tables))


def _original_sql(spec, n: int) -> str:
    parts = [derived.original_select(spec, n)] + ([derived.original_select(spec, n, new_keys=True)] if spec.load == SCD and n == 2 else [])
    return " UNION ALL ".join(f"SELECT {', '.join(exprs)} FROM {derived.ORIGINS[spec.name][0]} WHERE {where}" for exprs, where in parts)


def _original_tables_sql() -> str:
    ctes, tables = [], []
    for i, spec in enumerate(REFERENCE_BATCH_TABLES):
        fields = derived.fields(spec.schema)
        for m in ("strict", "compat"):
            if spec.load == SCD:
                chain, rel = _scd_chain(f"o{i}{m}_", lambda n, s=spec: _original_sql(s, n), 2, m, spec.primary_key, [c for c, _ in fields], spec.change_columns)
                ctes += chain
                tables.append((spec.target, m, rel, fields + [("start_date", "date"), ("end_date", "date")]))
            else:
                batches = ((1, B1), (2, B2)) if spec.load == APPEND else ((2, B2),)
                rel = " UNION ALL ".join(f"SELECT *, DATE '{b}' AS batched_at FROM ({_original_sql(spec, n)}) b{n}" for n, b in batches)
                tables.append((spec.target, m, f"({rel})", fields + [("batched_at", "date")]))
    return _texts_sql(ctes, tables)


def _replay_rows_sql() -> str:
    stamped, scd = [("batched_at", "date")], [("start_date", "date"), ("end_date", "date")]
    ctes, tables = [], []
    changes = {"customer": (_c_batch, "c_custkey", C_COLS, ("c_name", "c_mktsegment")), "supplier": (_s_batch, "s_suppkey", S_COLS, ("s_name", "s_nationkey", "s_acctbal"))}
    for m in ("strict", "compat"):
        for t, (batch, key, cols, change) in changes.items():
            chain, rel = _scd_chain(f"{t}_{m}_", batch, 3, m, key, cols, change)
            ctes += chain
            tables.append((t, m, rel, derived.fields(DRIVER_SCHEMAS[t]) + scd))
        for t, rows in (("part", f"SELECT {P_COLS} FROM part WHERE p_size > 20"), ("nation", "SELECT * FROM nation"), ("region", "SELECT * FROM region")):
            tables.append((t, m, f"(SELECT *, DATE '{B3}' AS batched_at FROM ({rows}) r)", derived.fields(DRIVER_SCHEMAS[t]) + stamped))
        tables.append(("orders", m, f"(SELECT {O_COLS}, {O_STAMP} AS batched_at FROM orders)", derived.fields(DRIVER_SCHEMAS["orders"]) + stamped))
    return _texts_sql(ctes, tables)


ORACLE |= {
    "q_original_tables": _original_tables_sql(),
    "q_original_one_time": _texts_sql([], [(s.target, "full", f"({_original_sql(s, 1)})", derived.fields(s.schema)) for s in REFERENCE_BASIC_TABLES]),
    "q_replay_rows": _replay_rows_sql(),
}


# ------------------------------------------------------------------ contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: customer b1 first load then b2 strict SCD2 merge, sf0.001."""
    return q_scd2_strict(spark, SF_SMOKE)


def _llm():
    """(queries, oracles) of the training-data operators and the pipeline; none where those are deleted."""
    try:
        import corpus_pipeline
        from batchwright.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "batchwright.llm"):
            raise
        return {}, {}
    oracles = llm.oracle_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return llm.queries() | {"pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return ORACLE | _llm()[1]
