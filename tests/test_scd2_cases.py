"""Decision table for SCD2 (one row per case), both modes, both strict forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from batchwright.operators import scd2

B0 = dt.date(2022, 11, 1)
B = dt.date(2022, 11, 2)
SRC = "k int, a int, b int"
TGT = "k int, a int, b int, start_date date, end_date date"
OPEN = None


def _t(*rows):
    """target rows: (k, a, b) open, or (k, a, b, start, end)."""
    out = []
    for r in rows:
        out.append(r if len(r) == 5 else (*r, B0, OPEN))
    return out


def _run(spark, target, source, mode, broadcast=None):
    t = spark.createDataFrame(target, TGT)
    s = spark.createDataFrame(source, SRC)
    if mode == "strict":
        cols = ["k", "a", "b", "start_date", "end_date"]
        history = t.where(F.col("end_date").isNotNull()).select(*cols)
        changes = scd2.scd2_strict_changes(s, t.where(F.col("end_date").isNull()), "k", ["a", "b"], B, broadcast_source=broadcast)
        inserted = changes.where(F.col("_op") == "insert").count()
        out = history.unionByName(changes.drop("_op"))
    else:
        changed = scd2.changed_rows(s, t, "k", ["a", "b"], "compat", broadcast_source=broadcast)
        inserted = changed.count()
        out = scd2.scd2_compat(s, t, "k", ["a", "b"], B, changed=changed)
    if inserted == 0:
        out = t  # no-op: the load keeps the target as it is
    return [tuple(r) for r in out.collect()], inserted


def _rows(*rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def _same(got, want):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


CASES = {
    # name: (target, source, strict result, compat result); None = no-op
    "no_change": (_t((1, 1, 1)), [(1, 1, 1)], None, None),
    "change": (
        _t((1, 1, 1)),
        [(1, 1, 2)],
        [(1, 1, 1, B0, B), (1, 1, 2, B, None)],
        [(1, 1, 1, B0, B), (1, 1, 2, B, B)],
    ),
    "new_key": (
        _t((1, 1, 1)),
        [(1, 1, 1), (2, 5, 5)],
        [(1, 1, 1, B0, None), (2, 5, 5, B, None)],
        [(1, 1, 1, B0, None), (2, 5, 5, B, B)],
    ),
    "key_missing_in_source": (_t((1, 1, 1), (2, 2, 2)), [(1, 1, 1)], None, None),
    "tuple_held_by_another_key": (
        _t((7, 1, 1)),
        [(7, 2, 2), (9, 1, 1)],
        [(7, 1, 1, B0, B), (7, 2, 2, B, None), (9, 1, 1, B, None)],
        [(7, 1, 1, B0, None), (9, 1, 1, B, B)],
    ),
    "null_in_change_column": (
        _t((1, 1, None)),
        [(1, 1, None)],
        None,
        [(1, 1, None, B0, B), (1, 1, None, B, B)],
    ),
    "back_to_old_value": (
        _t((1, 1, 1, B0, dt.date(2022, 10, 31)), (1, 2, 2)),
        [(1, 1, 1)],
        [(1, 1, 1, B0, dt.date(2022, 10, 31)), (1, 2, 2, B0, B), (1, 1, 1, B, None)],
        None,
    ),
    "untouched_closed_history": (
        _t((1, 1, 1, B0, dt.date(2022, 10, 31)), (1, 2, 2)),
        [(1, 2, 2), (3, 3, 3)],
        [(1, 1, 1, B0, dt.date(2022, 10, 31)), (1, 2, 2, B0, None), (3, 3, 3, B, None)],
        [(1, 1, 1, B0, None), (1, 2, 2, B0, None), (3, 3, 3, B, B)],
    ),
    "null_key_in_source": (_t((1, 1, 1)), [(None, 4, 4)], None, None),
    "null_key_in_target": (
        _t((None, 1, 1)),
        [(1, 1, 1)],
        [(None, 1, 1, B0, None), (1, 1, 1, B, None)],
        [(None, 1, 1, B0, None), (1, 1, 1, B, B)],
    ),
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("form", ["strict-shuffle", "strict-broadcast", "compat-shuffle", "compat-broadcast"])
def test_case(spark, name, form):
    target, source, strict_want, compat_want = CASES[name]
    mode = "compat" if form.startswith("compat") else "strict"
    broadcast = form.endswith("broadcast")
    got, inserted = _run(spark, target, source, mode, broadcast)
    want = compat_want if mode == "compat" else strict_want
    if want is None:
        assert inserted == 0
        _same(got, [tuple(r) for r in target])
    else:
        _same(got, want)


@pytest.mark.parametrize("broadcast", [False, True])
def test_strict_duplicate_source_key_fails(spark, broadcast):
    with pytest.raises(Exception, match="duplicate source key k=1"):
        _run(spark, _t((1, 1, 1)), [(1, 2, 2), (1, 3, 3)], "strict", broadcast)


def test_compat_duplicate_source_key_inserts_both(spark):
    got, _ = _run(spark, _t((1, 1, 1)), [(1, 2, 2), (1, 3, 3)], "compat")
    _same(got, [(1, 1, 1, B0, B), (1, 2, 2, B, B), (1, 3, 3, B, B)])


def test_end_date_stays_date(spark):
    t = spark.createDataFrame(_t((1, 1, 1)), TGT)
    s = spark.createDataFrame([(1, 1, 2)], SRC)
    for mode in scd2.MODES:
        out = scd2.scd2_merge(s, t, "k", ["a", "b"], B, mode)
        assert dict(out.dtypes)["end_date"] == "date"
        assert out.columns == ["k", "a", "b", "start_date", "end_date"]


def test_unknown_mode(spark):
    t = spark.createDataFrame(_t((1, 1, 1)), TGT)
    with pytest.raises(ValueError):
        scd2.scd2_merge(t.select("k", "a", "b"), t, "k", ["a"], B, "type3")
