"""Delimited text: CSV defaults with a declared schema, all part files."""

import os

from batchwright.sources import read_delimited, read_named_file


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def _local(ws):
    return ws.replace("file:", "", 1) if ws.startswith("file:") else ws


def test_edge_rows(spark, ws):
    d = f"{_local(ws)}/t"
    _write(d, "part-00000", '1|a|2.5\n2||x\n3|"q|r"|1\n4|b\n||\n\n  5|c|1|extra|more\n6|abc"d|2\n')
    rows = read_delimited(spark, d, "id int, s string, d double").collect()
    got = [tuple(r) for r in rows]
    assert got == [
        (1, "a", 2.5),
        (2, None, None),
        (3, "q|r", 1.0),
        (4, "b", None),
        (None, None, None),
        (None, "c", 1.0),
        (6, 'abc"d', 2.0),
    ]


def test_reads_every_part_and_skips_other_files(spark, ws):
    d = f"{_local(ws)}/t"
    _write(d, "part-00000", "1|a\n")
    _write(d, "part-00001", "2|b\n")
    _write(f"{d}/nested", "part-00002", "3|c\n")
    _write(d, "_SUCCESS", "")
    _write(d, ".part-00000.crc", "junk")
    _write(d, "notes.txt", "9|z\n")
    got = sorted(r.id for r in read_delimited(spark, d, "id int, s string").collect())
    assert got == [1, 2, 3]


def test_trailing_separator_is_harmless(spark, ws):
    d = f"{_local(ws)}/t"
    _write(d, "part-0", "1|a|\n2|b|\n")
    assert [tuple(r) for r in read_delimited(spark, d, "id int, s string").collect()] == [(1, "a"), (2, "b")]


def test_folder_without_parts_is_empty(spark, ws):
    d = f"{_local(ws)}/t"
    _write(d, "_SUCCESS", "")
    assert read_delimited(spark, d, "id int").count() == 0


def test_named_file(spark, ws):
    _write(_local(ws), "customer.dat", "1|x\n2|y\n")
    assert read_named_file(spark, ws, "customer.dat", "id int, s string").count() == 2


def test_record_check_counts_without_changing_rows(spark, ws):
    from batchwright.sources import record_check

    d = f"{_local(ws)}/rc"
    # good, bad number, short row, extra field, blank line, bad int key
    _write(d, "part-00000", "1|a|2.5\n2|b|x\n3|c\n4|d|1.0|extra\n\nzz|e|3.0\n")
    _write(d, "part-00001", "7|g|1.5\n")
    got = record_check(spark, d, "k int, s string, v double").collect()[0].asDict()
    assert got == {"rows": 6, "bad_records": 4, "null_fields": 3}
    # the loads still read every record the way Spark's defaults do
    assert read_delimited(spark, d, "k int, s string, v double").count() == 6


def test_check_records_reported_per_load(spark, ws):
    from batchwright.plans import derived, driver_registry, replay
    from batchwright.sinks import LakeStore

    from .conftest import SF

    root = f"{ws}/src"
    derived.write_batch_frame(derived.customer_malformed_batch(derived.table(spark, SF, "customer")), root, 1, "customer")
    store = LakeStore(spark, f"{ws}/lake")
    reports = replay(spark, store, driver_registry(), root, "orders", check_records=True)
    m = reports[0].loads[0].metrics
    n = derived.table(spark, SF, "customer").count()
    bad = derived.table(spark, SF, "customer").where("c_custkey % 13 = 0 or c_custkey % 17 = 0").count()
    assert m["source_rows"] == m["rows"] == n
    assert m["bad_records"] == bad > 0
    # unparsable fields load as NULL, as Spark's permissive default has it
    assert store.read("customer").where("c_acctbal is null").count() == derived.table(spark, SF, "customer").where("c_custkey % 13 = 0").count()
