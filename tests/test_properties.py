"""Property tests: join forms against plain-Python list forms."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchwright.operators import scd2

B0, B = dt.date(2022, 11, 1), dt.date(2022, 11, 2)
OLD = dt.date(2022, 10, 1)
SRC = "k int, a int, b int"
TGT = "k int, a int, b int, start_date date, end_date date"

val = st.one_of(st.none(), st.integers(0, 2))
key = st.one_of(st.none(), st.integers(0, 5))
src_rows = st.lists(st.tuples(key, val, val), max_size=8)
any_tgt = st.lists(st.tuples(key, val, val, st.sampled_from([None, OLD])), max_size=8)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _eq(x, y):
    return x is not None and y is not None and x == y


def compat_list_form(target, source):
    """The original algorithm: collect unchanged keys, filter by NOT IN,
    collect new keys, union, then set end_date with IN."""
    unchanged = {t[0] for t in target for s in source if _eq(t[1], s[1]) and _eq(t[2], s[2])}
    new = [s for s in source if s[0] is not None and s[0] not in unchanged]
    if not new:
        return None
    keys = {s[0] for s in new}
    rows = [t[:4] for t in target] + [(*s, B) for s in new]
    return [(*r, B if r[0] in keys else None) for r in rows]


def _norm(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@SETTINGS
@given(target=any_tgt, source=src_rows, broadcast=st.booleans())
def test_compat_join_form_equals_list_form(spark, target, source, broadcast):
    tgt = [(k, a, b, B0, end) for k, a, b, end in target]
    t = spark.createDataFrame(tgt, TGT)
    s = spark.createDataFrame(source, SRC)
    changed = scd2.changed_rows(s, t, "k", ["a", "b"], "compat", broadcast_source=broadcast)
    want = compat_list_form(tgt, source)
    if want is None:
        assert changed.count() == 0
        return
    got = [tuple(r) for r in scd2.scd2_compat(s, t, "k", ["a", "b"], B, changed=changed).collect()]
    assert _norm(got) == _norm(want)


@st.composite
def strict_state(draw):
    """Valid strict target (one open row per key, closed history) and a
    source with unique keys (NULL keys allowed)."""
    keys = draw(st.lists(st.integers(0, 6), unique=True, max_size=6))
    target = []
    for k in keys:
        for _ in range(draw(st.integers(0, 2))):
            target.append((k, draw(val), draw(val), dt.date(2022, 9, 1), OLD))
        if draw(st.booleans()):
            target.append((k, draw(val), draw(val), B0, None))
    if draw(st.booleans()):
        target.append((None, draw(val), draw(val), B0, None))
    skeys = draw(st.lists(st.integers(0, 8), unique=True, max_size=6))
    source = [(k, draw(val), draw(val)) for k in skeys]
    source += [(None, draw(val), draw(val)) for _ in range(draw(st.integers(0, 2)))]
    return target, source


def strict_py(target, source):
    open_rows = {t[0]: t for t in target if t[4] is None and t[0] is not None}
    inserted, closing = [], set()
    for s in source:
        if s[0] is None:
            continue
        t = open_rows.get(s[0])
        if t is None:
            inserted.append(s)
        elif (t[1], t[2]) != (s[1], s[2]):
            closing.add(s[0])
            inserted.append(s)
    out = [(*t[:4], B) if (t[4] is None and t[0] in closing) else t for t in target]
    return out + [(*s, B, None) for s in inserted], len(inserted)


def _strict(spark, target, source, broadcast):
    t = spark.createDataFrame(target, TGT)
    s = spark.createDataFrame(source, SRC)
    hist = t.where(F.col("end_date").isNotNull())
    ch = scd2.scd2_strict_changes(s, t.where(F.col("end_date").isNull()), "k", ["a", "b"], B, broadcast_source=broadcast)
    rows = [tuple(r) for r in ch.collect()]
    inserted = sum(1 for r in rows if r[-1] == "insert")
    return [tuple(r) for r in hist.collect()] + [r[:-1] for r in rows], inserted


@SETTINGS
@given(state=strict_state(), broadcast=st.booleans())
def test_strict_matches_model_and_invariants(spark, state, broadcast):
    target, source = state
    got, inserted = _strict(spark, target, source, broadcast)
    want, n_new = strict_py(target, source)
    assert _norm(got) == _norm(want)
    assert inserted == n_new
    assert len(got) == len(target) + inserted
    open_keys = [r[0] for r in got if r[4] is None and r[0] is not None]
    assert len(open_keys) == len(set(open_keys))  # at most one open row per key
    closed_before = _norm([t for t in target if t[4] is not None])
    closed_after = _norm([r for r in got if r[4] is not None and r[4] != B])
    assert closed_before == closed_after  # history untouched
    again, inserted_again = _strict(spark, got, source, broadcast)
    assert inserted_again == 0 and _norm(again) == _norm(got)  # re-applying is a no-op


@SETTINGS
@given(source=src_rows, broadcast=st.booleans())
def test_strict_guard_raises_iff_a_key_repeats(spark, source, broadcast):
    """The duplicate guard fails the merge exactly when a non-NULL key occurs
    twice in the source, in both physical forms; NULL keys never count."""
    t = spark.createDataFrame([(0, 0, 0, B0, None)], TGT)
    s = spark.createDataFrame(source, SRC)
    keys = [r[0] for r in source if r[0] is not None]
    out = scd2.scd2_strict_changes(s, t, "k", ["a", "b"], B, broadcast_source=broadcast)
    if len(keys) != len(set(keys)):
        try:
            out.collect()
        except Exception as exc:  # noqa: BLE001
            assert "duplicate source key k=" in str(exc)
        else:
            raise AssertionError("duplicate key not rejected")
    else:
        assert out.where(F.col("_op") == "insert").count() == sum(1 for k in set(keys) if k != 0) + (
            1 if 0 in keys and [r for r in source if r[0] == 0][0][1:] != (0, 0) else 0
        )
