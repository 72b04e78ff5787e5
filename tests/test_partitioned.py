"""Bucketed SCD tables and date-partitioned facts: what a load reads, writes and leaves alone."""

import datetime as dt
import math
import random
import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from batchwright import fs
from batchwright.functions.digest import row_digest
from batchwright.functions.stamps import BatchNameError, parse_batch_date
from batchwright.operators import bucketed, scd2
from batchwright.operators.loads import append_load, first_load, scd_load
from batchwright.plans import derived, driver_registry, replay
from batchwright.plans.catalog import bootstrap_database, register
from batchwright.plans.registry import driver_basic_registry
from batchwright.sinks import LakeStore, PartitionedStore
from batchwright.sinks.partitioned import DIGEST, bucket_of
from batchwright.sources.manifest import list_batches, manifest, manifest_scan
from batchwright.specs import APPEND, SCD, TableSpec

from .conftest import SF
from .test_plans import plan

D1, D2, D3, D4 = (dt.date(2022, 11, n) for n in (1, 2, 3, 4))
SPEC = TableSpec("t", "k bigint, a string, b double, c int", SCD, "k", ("a", "b"))
FACT = TableSpec("f", "k bigint, v string", APPEND)


def _src(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema)


def _rows(df):
    return sorted(map(str, df.collect()))


def _files(df):
    return {f.split("/t/", 1)[1] for f in df.inputFiles()}


def _base(n=200):
    return [(i, f"a{i}", float(i), i) for i in range(n)]


@pytest.fixture
def store(spark, ws):
    s = PartitionedStore(spark, ws, buckets=16)
    first_load(s, SPEC, _src(spark, _base()), D1)
    return s


def _bucket(spark, key):
    return spark.range(1).select(F.lit(key).cast("bigint").alias("k")).select(bucket_of("k", 16)).first()[0]


def test_one_key_batch_touches_one_bucket(spark, store):
    before = store.head("t").open_seqs
    untouched = _files(store.open_rows("t"))
    result = scd_load(store, SPEC, _src(spark, [(7, "new", 7.0, 7)]), D2)
    assert {k: result.metrics[k] for k in ("inserted", "closed", "buckets_read", "buckets_written")} == {"inserted": 1, "closed": 1, "buckets_read": 1, "buckets_written": 1}
    now, k = store.head("t").open_seqs, _bucket(spark, 7)
    assert [i for i in range(16) if now[i] != before[i]] == [k]
    kept = {f for f in untouched if f"_bucket={k}/" not in f}
    assert kept < _files(store.open_rows("t"))  # the other buckets' files are the same ones
    assert {re.sub("/part.*", "", f) for f in _files(store.open_rows("t")) - kept} == {f"seq={now[k]}/kind=open/_bucket={k}"}
    assert _rows(store.read("t").where("k = 7")) == _rows(
        spark.createDataFrame([(7, "a7", 7.0, 7, D1, D2), (7, "new", 7.0, 7, D2, None)], store.read("t").schema)
    )
    assert store.read("t").count() == 201


def test_batch_without_changes_writes_nothing(spark, store):
    before = {e.name for e in fs.ls(spark, store.table_path("t"))}
    unchanged = [(k, a, b, c + 1) for k, a, b, c in _base()]  # c is no change column
    result = scd_load(store, SPEC, _src(spark, [*unchanged, (None, "x", 1.0, 1)]), D2)
    assert result.action == "no_change" and result.metrics["null_keys"] == 1 and result.metrics["buckets_written"] == 0
    assert {e.name for e in fs.ls(spark, store.table_path("t"))} == before
    assert store.has_batch("t", D2) and store.batch_mark("t") == D2
    assert store.read("t").where("end_date IS NULL AND start_date = '2022-11-01'").count() == 200


def test_probe_reads_key_and_digest_only(spark, store):
    staged = _src(spark, [(1, "x", 1.0, 1)]).withColumn(DIGEST, row_digest(SPEC.struct, SPEC.change_columns))
    for small in (True, False):
        text = plan(bucketed.probe(staged, store.open_rows("t"), "k", small), "formatted")
        assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<k:bigint,_digest:binary>"]
        assert ("SortMergeJoin" in text) == (not small)


def test_probe_prunes_buckets(spark, store):
    k = _bucket(spark, 7)
    assert {re.sub("/part.*", "", f) for f in _files(store.open_rows("t", [k]))} == {f"seq=1/kind=open/_bucket={k}"}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_merges_equal_the_unbucketed_store(spark, ws, threshold):
    rng, before = random.Random(5), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        a, b = LakeStore(spark, f"{ws}/a"), PartitionedStore(spark, f"{ws}/b", buckets=4)
        values = [None, "", "-", "x", "1:x"], [None, 0.0, -0.0, math.nan, 1.5]
        for n, day in enumerate((D1, D2, D3, D4)):
            keys = rng.sample(range(60), 40 + n)
            rows = [(k, rng.choice(values[0]), rng.choice(values[1]), n) for k in keys] + [(None, "n", 1.0, n)] * n
            for s in (a, b):
                (first_load if n == 0 else scd_load)(s, SPEC, _src(spark, rows), day)
            assert _rows(a.read("t")) == _rows(b.read("t"))
            assert _rows(a.read_open("t")) == _rows(b.read_open("t")) and _rows(a.read_closed("t")) == _rows(b.read_closed("t"))
            assert a.read("t").schema == b.read("t").schema
        assert b.head("t").open_seqs
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_key_fails_before_any_join(spark, store):
    hot = spark.range(0, 200_000, 1, 8).select(F.expr("least(id, 5) + greatest(5 - id, 0)").alias("k"), F.col("id").cast("string").alias("a"), F.lit(1.0).alias("b"), F.lit(1).alias("c"))
    with pytest.raises((Py4JJavaError, PySparkException), match="duplicate source key k=5"):
        scd_load(store, SPEC, hot, D2)
    assert store.batch_mark("t") == D1 and fs.ls(spark, f"{store.table_path('t')}/seq=2") == []
    text = plan(scd2.one_row_per_key(hot, "k"))
    # each task hands one row of the key to the shuffle, and there is no join yet
    assert "partial_count(1)" in text and re.search(r"partial_(any_value|first)\(", text) and "Join" not in text


def test_unbucketed_merge_joins_one_row_a_key(spark, ws):
    store = LakeStore(spark, ws)
    first_load(store, SPEC, _src(spark, _base()), D1)
    hot = spark.range(0, 100_000, 1, 8).select(F.expr("least(id, 5) + greatest(5 - id, 0)").alias("k"), F.lit("a").alias("a"), F.lit(1.0).alias("b"), F.lit(1).alias("c"))
    out = scd2.scd2_strict_changes(hot, store.read_open("t"), "k", ["a", "b"], D2, broadcast_source=False)
    text = plan(out)
    join = text.index("SortMergeJoin")
    assert "partial_count(1)" in text[join:] and text.count("Exchange hashpartitioning") == 2  # the aggregate is the join's side
    with pytest.raises((Py4JJavaError, PySparkException), match="duplicate source key k=5"):
        out.collect()


def test_unpublished_merge_is_invisible_and_vacuumed_buckets_go(spark, store):
    changed = _src(spark, [(k, "z", b, c) for k, _, b, c in _base()])
    before = _rows(store.read("t"))
    one = scd2.one_row_per_key(changed, "k")
    rows, closed = bucketed.merged(store.open_rows("t"), bucketed._laid_out(store, SPEC, one, 16), "k", D2, 16, True)
    store.stage_open("t", rows, D2, range(16), closed)  # crash before publish
    assert _rows(store.read("t")) == before
    scd_load(store, SPEC, _src(spark, [(7, "y", 7.0, 7)]), D2)
    after = _rows(store.read("t"))
    assert len(after) == 201
    removed = store.vacuum("t", retain=1)
    assert _rows(store.read("t")) == after
    k = _bucket(spark, 7)
    assert f"seq=1/kind=open/_bucket={k}" in {r.split("/t/")[1] for r in removed} and len(removed) == 17


def test_retained_versions_after_each_merge(spark, ws):
    store = PartitionedStore(spark, ws, buckets=4, retain_versions=1)
    first_load(store, SPEC, _src(spark, _base()), D1)
    for n, day in ((1, D2), (2, D3)):
        scd_load(store, SPEC, _src(spark, [(k, f"z{n}", b, c) for k, _, b, c in _base()]), day)
    assert store.read("t").count() == 600 and store.read_open("t").count() == 200


def test_empty_tables_and_sources(spark, ws):
    store = PartitionedStore(spark, ws, buckets=4)
    first_load(store, SPEC, _src(spark, []), D1)
    assert store.read("t").count() == 0
    assert scd_load(store, SPEC, _src(spark, []), D2).action == "no_change"
    scd_load(store, SPEC, _src(spark, _base(5)), D3)
    assert store.read("t").count() == 5 and store.read_closed("t").count() == 0


def test_compat_mode_keeps_its_own_layout(spark, ws):
    a, b = LakeStore(spark, f"{ws}/a"), PartitionedStore(spark, f"{ws}/b", buckets=4)
    for s in (a, b):
        first_load(s, SPEC, _src(spark, _base(20)), D1, scd2.COMPAT)
        scd_load(s, SPEC, _src(spark, [(3, "n", 3.0, 3), (99, "n", 3.0, 3)]), D2, scd2.COMPAT)
        scd_load(s, SPEC, _src(spark, [(4, "m", 3.0, 3)]), D3)
    assert _rows(a.read("t")) == _rows(b.read("t"))


def test_digest_is_equal_where_columns_are(spark):
    schema = "s string, d double, f float, t timestamp, x binary, n decimal(10,2), i int"
    now = dt.datetime(2022, 11, 6, 1, 30)
    values = [(None,) * 7, ("-", 0.0, 0.0, now, b"\xff", None, 1), ("-", -0.0, -0.0, now, b"\xff", None, 1), ("", math.nan, math.nan, now, b"", None, 1),
              ("1:a", 1.0, None, None, b"\xfe", None, 12), ("1", 1.0, None, None, b"\xfe", None, 12), ("a", 1.0, None, None, b"\xfe", None, None)]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "id int, " + schema)
    df = df.withColumn("h", row_digest(df.schema, df.columns[1:]))
    a, b = df.alias("a"), df.alias("b")
    equal = F.lit(True)
    for c in df.columns[1:-1]:
        equal = equal & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    pairs = a.join(b, F.col("a.id") <= F.col("b.id")).select(equal.alias("same"), (F.col("a.h") == F.col("b.h")).alias("digest")).collect()
    assert all(p.same == p.digest for p in pairs) and {p.same for p in pairs} == {True, False}
    with pytest.raises(TypeError):
        row_digest(spark.createDataFrame([], "m map<string,int>").schema, ["m"])


# ------------------------------------------------------------------ facts
def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT.schema)


def test_append_replaces_its_own_date_only(spark, ws):
    store = PartitionedStore(spark, ws)
    for n, day in enumerate((D1, D2, D3)):
        append_load(store, FACT, _fact(spark, [(n, "x"), (n, "y")]), day)
    files = set(store.read("f").inputFiles())
    append_load(store, FACT, _fact(spark, [(9, "z")]), D2)
    now = set(store.read("f").inputFiles())
    assert {f for f in files if "2022-11-02" not in f} == {f for f in now if "2022-11-02" not in f}
    assert sorted(map(tuple, store.read("f").collect())) == [(0, "x", D1), (0, "y", D1), (2, "x", D3), (2, "y", D3), (9, "z", D2)]


def test_append_prunes_partitions(spark, ws):
    store = PartitionedStore(spark, ws)
    for n, day in enumerate((D1, D2, D3)):
        append_load(store, FACT, _fact(spark, [(n, "x")]), day)
    text = plan(store.read("f").where(F.col("batched_at") == F.lit(D2)), "formatted")
    assert re.search(r"PartitionFilters: .*batched_at#\d+ = 2022-11-02", text)
    assert "PartitionFilters" in plan(store.read("f").agg(F.max("batched_at")), "formatted")


def test_append_in_progress_is_invisible(spark, ws):
    store = PartitionedStore(spark, ws)
    append_load(store, FACT, _fact(spark, [(1, "x")]), D1)
    store.stage("f", _fact(spark, [(2, "x")]).withColumn("batched_at", F.lit(D2)), APPEND, parse_batch_date("2022-11-02"))  # crash before publish
    assert store.read("f").count() == 1 and store.batch_mark("f") == D1


# ------------------------------------------------- batches of one day, discovery
def test_batches_of_one_day_load_in_order_and_once(spark, ws):
    reg, names = driver_registry(), ["batch_2022-11-01", "batch_2022-11-01T080000", "batch_2022-11-01T080000_b", "batch_2022-11-02"]
    for n, name in enumerate(names):
        src = derived.table(spark, SF, "orders").where(F.col("o_orderkey") % 4 == n)
        src.write.option("sep", "|").csv(f"{ws}/src/{name}/orders")
    assert list_batches(spark, f"{ws}/src") == names
    for store in (LakeStore(spark, f"{ws}/a"), PartitionedStore(spark, f"{ws}/b")):
        assert [r.status for r in replay(spark, store, reg, f"{ws}/src", "orders")] == ["loaded"] * 4
        assert [r.status for r in replay(spark, store, reg, f"{ws}/src", "orders")] == ["not_new"] * 4
        assert store.batch_mark("orders").token == "2022-11-02"
        got = {r["batched_at"]: r["count"] for r in store.read("orders").groupBy("batched_at").count().collect()}
        assert set(got) == {D1, D2} and sum(got.values()) == derived.table(spark, SF, "orders").count()
        append_load(store, reg["orders"], derived.table(spark, SF, "orders").where("o_orderkey % 4 = 1"), names[1])  # a retry of the second
        assert store.read("orders").count() >= sum(got.values())
    with pytest.raises(BatchNameError):
        list_batches(spark, f"{ws}/src", same_day=False)


def test_two_names_of_one_batch_stop_discovery(spark, ws):
    for name in ("batch_2022-11-01", "batches_2022-11-01"):
        fs.write_text(spark, f"{ws}/src/{name}/t/part-0", "1|a\n")
    with pytest.raises(BatchNameError):
        list_batches(spark, f"{ws}/src")


def test_discovery_finds_part_folders(spark, ws):
    for path in ("a/part-group=1/part-00000", "b/x/part-1/y/part-00000", "c/part-00000", "d/_tmp/part-00000", "e/part-empty/other"):
        fs.write_text(spark, f"{ws}/src/batch_2022-11-01/{path}", "1|a\n")
    assert {e.table: e.n_parts for e in manifest(spark, f"{ws}/src")} == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 0}
    found = manifest_scan(spark, f"{ws}/src")
    assert {r["table_name"]: (r["n_parts"], r["bytes"]) for r in found.collect()} == {"a": (1, 4), "b": (1, 4), "c": (1, 4)}
    assert "content" not in plan(found, "formatted")


def test_database_without_names_is_named(spark, ws):
    store, reg, db = LakeStore(spark, f"{ws}/lake"), driver_basic_registry(), f"bw_{random.Random().getrandbits(40):x}"
    derived.write_one_time_files(spark, SF, f"{ws}/src")
    assert bootstrap_database(spark, store, reg, f"{ws}/src", db)
    spark.sql(f"DROP VIEW {db}.nation")  # as if the first run had ended before naming it
    assert not bootstrap_database(spark, store, reg, f"{ws}/src", db)
    assert spark.table(f"{db}.nation").count() == 25
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_temporary_views_of_partitioned_tables(spark, store):
    assert register(spark, store, ["t"]) == ["t"]
    assert spark.table("t").count() == 200
    with pytest.raises(ValueError):
        register(spark, store, ["t"], database="x")
