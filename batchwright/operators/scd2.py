"""Slowly changing dimension, type 2, as joins.

Two definitions are kept apart (``mode``):

``strict`` (default; the documented intent)
    Compare each source row with the *open* version of the same key, NULLs
    equal to NULLs.  A differing key closes its open version (``end_date`` =
    batch date) and opens the source row; a new key opens the source row;
    everything else, including closed history and keys missing from the
    source, is left as it is.  A key twice in one source is an error.

``compat`` (parity with the original program)
    A target key is *unchanged* when its change-column tuple appears on any
    source row, compared with plain ``=`` (NULL never matches) and against
    every version, open or closed.  Source rows of other keys are new
    versions.  Then every row of a key that got a new version, the new
    version included, gets ``end_date`` = batch date and every other row gets
    NULL.

Source rows with a NULL key are dropped in both modes (count them with
:func:`null_key_count` or the load report).

Scale notes.  Strict runs as one full outer join on the key between the
source and the open versions only; each side is shuffled once and closed
history is not read.  Its duplicate-key check is an aggregate per key, combined
map-side, that the join reads the source through: a key that a batch repeats
reaches the join as one row, if at all.
Compat joins the target with the *distinct* source tuples (left semi, so no
fan-out; hot tuples collapse in the map-side distinct, and skewed target
partitions can be split by AQE), then marks rows with a join against the
distinct changed keys.  Rows with a NULL key bypass every join, so they never
pile up in one shuffle partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from ..functions.stamps import date_lit, parse_batch_date, with_scd_columns
from ..specs import END_DATE, START_DATE
from .bloom import prefilter, without_nulls

STRICT = "strict"
COMPAT = "compat"
MODES = (STRICT, COMPAT)

OP = "_op"
OP_KEEP = "keep"
OP_CLOSE = "close"
OP_INSERT = "insert"
OP_NULL_KEY = "null_key"


def _null_date() -> Column:
    return F.lit(None).cast("date")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown scd2 mode {mode!r}; expected one of {MODES}")


def target_columns(source_columns: Sequence[str]) -> list[str]:
    return [*source_columns, START_DATE, END_DATE]


def null_key_count(source: DataFrame, key: str) -> Column:
    """Aggregate: source rows that the merge drops for a NULL key."""
    return F.count_if(F.col(key).isNull())


# ---------------------------------------------------------------- compat
def unchanged_keys(source: DataFrame, target: DataFrame, key: str, change_cols: Sequence[str], bloom: bool = False) -> DataFrame:
    """Distinct target keys whose change tuple occurs anywhere in the source.

    Plain ``=`` on each change column: a NULL on either side never matches.
    The key itself is not compared (a key is "unchanged" if *another* source
    row carries its tuple).  ``bloom``: target rows first pass a Bloom filter of
    the source's tuples, under the broadcast bound, so that rows that cannot match
    are not shuffled; the semi join removes the few that pass by chance.
    """
    cols = list(change_cols)
    # all target keys, so no bound follows from the source: sort-merge, not
    # a broadcast chosen on an estimate
    tuples = without_nulls(source.select(*cols), cols).distinct().hint("merge")
    keyed = target.select(key, *cols).where(F.col(key).isNotNull())
    if bloom:
        keyed = prefilter(keyed, source.select(*cols), cols, broadcast_limit(source.sparkSession))
    return (
        keyed.join(tuples, on=cols, how="left_semi")
        .select(key)
        .distinct()
    )


def changed_rows(
    source: DataFrame,
    target: DataFrame,
    key: str,
    change_cols: Sequence[str],
    mode: str = STRICT,
    broadcast_source: bool | None = None,
) -> DataFrame:
    """Source rows that open a new version (NULL keys dropped).

    compat: keys not in :func:`unchanged_keys` (anti join, not an IN list).
    strict: rows with no open target version of the same key and tuple.
    ``broadcast_source`` (compat; ``None`` measures it with
    :func:`fits_broadcast`) picks the physical form, see :func:`_compat_changed`.
    """
    _check_mode(mode)
    src = source.where(F.col(key).isNotNull())
    if mode == COMPAT:
        return _compat_changed(source, src, target, key, list(change_cols), broadcast_source)
    cur = target.where(F.col(END_DATE).isNull() & F.col(key).isNotNull()).select(key, *change_cols).hint("merge")  # the open set: no proven bound
    cond = [src[key] == cur[key]] + [src[c].eqNullSafe(cur[c]) for c in change_cols]
    return src.join(cur, on=cond, how="left_anti").select(*source.columns)


def _compat_changed(
    source: DataFrame, src: DataFrame, target: DataFrame, key: str, cols: list[str], broadcast_source: bool | None
) -> DataFrame:
    """Compat change detection, in one of two physical forms.

    Only unchanged keys that occur in the source can remove a source row, so
    the target may first be cut to the source's keys.  With a source under a
    proven broadcast bound, the target streams through two broadcast semi
    joins (source keys, source change tuples) and is never shuffled; the
    unchanged keys left are at most the source's keys, so they are
    broadcast to the anti join after a small distinct.  Otherwise every
    join is a sort-merge join (the hint keeps Spark from broadcasting on an
    estimate): hot tuples collapse in the map-side distinct and AQE can split
    skewed target partitions."""
    if broadcast_source is None:
        broadcast_source = fits_broadcast(source)
    tuples = without_nulls(source.select(*cols), cols)
    cur = target.select(key, *cols).where(F.col(key).isNotNull())
    if broadcast_source:
        hit = cur.join(F.broadcast(src.select(key)), on=key, how="left_semi").join(F.broadcast(tuples), on=cols, how="left_semi")
        unchanged = F.broadcast(hit.select(key).distinct())
    else:
        hit = cur.join(tuples.distinct().hint("merge"), on=cols, how="left_semi")
        unchanged = hit.select(key).distinct().hint("merge")
    return src.join(unchanged, on=key, how="left_anti").select(*source.columns)


def scd2_compat(
    source: DataFrame,
    target: DataFrame,
    key: str,
    change_cols: Sequence[str],
    batch_date: str | dt.date,
    changed: DataFrame | None = None,
    changed_count: int | None = None,
) -> DataFrame:
    """New target in compat mode.  ``changed`` may be passed pre-computed
    (e.g. staged) from :func:`changed_rows`; an empty one means no change.

    With ``changed_count`` (rows of ``changed``, e.g. counted by the staging
    write) the distinct changed keys have a proven size bound: they are
    broadcast when it fits the threshold, and otherwise joined by sort-merge
    (AQE may still switch on measured shuffle sizes).  Without it Spark's
    planner decides."""
    b = date_lit(batch_date)
    cols = target_columns(source.columns)
    new = changed if changed is not None else changed_rows(source, target, key, change_cols, COMPAT)
    hits = new.select(key).distinct().withColumn("_hit", F.lit(True))
    if changed_count is not None:
        limit = broadcast_limit(source.sparkSession)
        per_key = 8 + 8 * 2 + _ENTRY_BYTES  # null bits, key and flag words, hash entry
        small = 0 <= limit and changed_count * per_key <= limit
        if small and not isinstance(new.schema[key].dataType, _FIXED):  # a key without a fixed width is measured
            small = fits_broadcast(new.select(key), limit - changed_count * 8)
        hits = F.broadcast(hits) if small else hits.hint("merge")
    rows = target.select(*cols).unionByName(with_scd_columns(new, batch_date).select(*cols))
    keyed = (
        rows.where(F.col(key).isNotNull())
        .join(hits, on=key, how="left")
        .withColumn(END_DATE, F.when(F.col("_hit"), b).otherwise(_null_date()))
        .select(*cols)
    )
    unkeyed = rows.where(F.col(key).isNull()).withColumn(END_DATE, _null_date()).select(*cols)
    return keyed.unionByName(unkeyed)


# ---------------------------------------------------------------- strict
def q(name: str) -> str:
    """Quoted identifier for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def _duplicate_error(key: str) -> str:
    """SQL that fails the job, naming the key."""
    return f"raise_error(concat('scd2 strict: duplicate source key {key}=', CAST({q(key)} AS STRING)))"


def duplicate_key_guard(source: DataFrame, key: str, schema: StructType) -> DataFrame:
    """Zero rows of ``schema``; evaluating it fails the job when a non-NULL
    key occurs twice in ``source`` (strict mode).

    Union it into the result that is written, so the check runs in the same
    job.  It is a count per key, combined map-side before its shuffle: a hot
    key reaches the reducer as one partial count per task, never as a group
    of rows, and the error is raised without buffering that group.  Only the
    key column is read for it."""
    k = q(key)
    return (
        source.select(key)
        .where(f"{k} IS NOT NULL")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(f"CASE WHEN _n > 1 THEN {_duplicate_error(key)} ELSE false END")
        .selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in schema.fields])
    )


def one_row_per_key(source: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """``source`` with one row a key; a non-NULL key that occurs twice fails the job.

    An aggregate per key combined map-side: of a key repeated any number of times
    each task hands on one row, so no shuffle partition and no later join holds
    more.  NULL keys become one row, counted in ``count`` if that column is named."""
    k, n = q(key), q(count or "_n")
    rest = [c for c in source.columns if c != key]
    row = "any_value(struct(" + ", ".join(q(c) for c in rest) + "))" if rest else "any_value(named_struct('_', 0))"
    one = source.groupBy(key).agg(F.count(F.lit(1)).alias(count or "_n"), F.expr(row).alias("_row"))
    one = one.where(f"CASE WHEN {k} IS NOT NULL AND {n} > 1 THEN {_duplicate_error(key)} ELSE true END")
    columns = [k if c == key else f"_row.{q(c)} AS {q(c)}" for c in source.columns]
    return one.selectExpr(*columns, *([n] if count else []))


def broadcast_limit(spark) -> int:
    """Bytes under which a join side may be broadcast (Spark's own setting;
    -1 disables broadcasting)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (what the planner compares with the
    broadcast threshold; file sources report their on-disk size)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


_FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)
_VAR = (T.StringType, T.BinaryType)
_ENTRY_BYTES = 32  # per row: hash-map slot and pointer, generously


def broadcast_bytes_bound(df: DataFrame) -> int | None:
    """An upper bound on the bytes a broadcast of ``df`` holds, measured by
    one aggregate over ``df`` (row count and exact byte length of every
    string / binary value).  Per row: null bits, one 8-byte word per
    column, a hash entry, and each variable-length value padded to 8 bytes.
    ``None`` for column types without such a bound (arrays, maps, structs,
    wide decimals): those are never broadcast."""
    fields = df.schema.fields
    var = []
    for f in fields:
        t = f.dataType
        if isinstance(t, _VAR):
            var.append(f.name)
        elif not (isinstance(t, _FIXED) or (isinstance(t, T.DecimalType) and t.precision <= 18)):
            return None
    lengths = [F.coalesce(F.octet_length(F.col(q(c))), F.lit(0)) for c in var]
    if lengths:
        agg = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(lengths[1:], lengths[0])).alias("var"))
    else:
        agg = df.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("var"))
    row = agg.first()  # one row
    n, var_bytes = int(row["n"]), int(row["var"] or 0)
    per_row = 8 * ((len(fields) + 63) // 64) + 8 * len(fields) + 8 * len(var) + _ENTRY_BYTES
    return n * per_row + var_bytes


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Broadcast only with a proven bound.  Catalyst's estimate (file bytes
    for file sources, unbounded for JDBC) first rules out anything that
    cannot be small without running a job; a candidate is then measured by
    :func:`broadcast_bytes_bound`, a cheap pass since its input is at most
    ``limit`` bytes."""
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    if limit < 0 or estimated_bytes(df) > limit:
        return False
    bound = broadcast_bytes_bound(df)
    return bound is not None and bound <= limit


def scd2_strict_changes(
    source: DataFrame,
    open_target: DataFrame,
    key: str,
    change_cols: Sequence[str],
    batch_date: str | dt.date,
    check_duplicates: bool = True,
    broadcast_source: bool | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """Open versions after the batch, plus the versions it closes.

    ``open_target`` holds the open versions only.  Output has the target
    columns and ``_op``: ``keep`` (open, untouched), ``close`` (closed by
    this batch), ``insert`` (new open version).  With ``keep_null_keys``
    the source rows dropped for a NULL key are added as ``null_key`` rows,
    so a caller can count them in the same pass and filter them out.

    Two physical forms, same result.  When the source passes the broadcast
    size check (``broadcast_source=None`` runs :func:`fits_broadcast`), the open
    versions are streamed once against the broadcast source and never
    shuffled; the keys of new rows come from a second, key-only pass.
    Otherwise one full outer join on the key shuffles each side once.
    """
    bdate = parse_batch_date(batch_date)
    b = f"DATE'{bdate.isoformat()}'"
    base = list(source.columns)
    cols = target_columns(base)
    k = q(key)
    src = source.select(*base).where(f"{k} IS NOT NULL")
    cur = open_target.select(*cols)

    # both sides renamed apart (t_*, s_*), each in one projection
    t = cur.where(f"{k} IS NOT NULL").selectExpr(*[f"{q(c)} AS {q('t_' + c)}" for c in cols], "true AS _t")
    s = src.selectExpr(*[f"{q(c)} AS {q('s_' + c)}" for c in base], "true AS _s")
    if broadcast_source is None:  # measured on exactly what would be broadcast
        broadcast_source = fits_broadcast(s)
    if broadcast_source:
        j = t.join(F.broadcast(s), t[f"t_{key}"] == s[f"s_{key}"], "left")
    else:
        if check_duplicates:  # the check, and one row a key before the join
            s = one_row_per_key(src, key).selectExpr(*[f"{q(c)} AS {q('s_' + c)}" for c in base], "true AS _s")
        j = t.join(s, t[f"t_{key}"] == s[f"s_{key}"], "full_outer")

    # each joined row yields its target version (kept or closed) and, when
    # the key is new or changed, the source row as a new open version
    differs = " OR ".join(f"NOT ({q('t_' + c)} <=> {q('s_' + c)})" for c in change_cols)
    changed = f"(_t IS NOT NULL AND _s IS NOT NULL AND ({differs}))"
    old = ", ".join(
        [f"'{c}', {q('t_' + c)}" for c in base]
        + [
            f"'{START_DATE}', {q('t_' + START_DATE)}",
            f"'{END_DATE}', CASE WHEN {changed} THEN {b} ELSE {q('t_' + END_DATE)} END",
            f"'{OP}', CASE WHEN {changed} THEN '{OP_CLOSE}' ELSE '{OP_KEEP}' END",
            "'_emit', _t IS NOT NULL",
        ]
    )
    new = ", ".join(
        [f"'{c}', {q('s_' + c)}" for c in base]
        + [
            f"'{START_DATE}', {b}",
            f"'{END_DATE}', CAST(NULL AS DATE)",
            f"'{OP}', '{OP_INSERT}'",
            f"'_emit', _s IS NOT NULL AND (_t IS NULL OR {changed})",
        ]
    )
    merged = j.selectExpr(f"inline(array(named_struct({old}), named_struct({new})))").where("_emit").drop("_emit")
    parts = [merged, cur.where(f"{k} IS NULL").selectExpr("*", f"'{OP_KEEP}' AS {OP}")]
    stamp = [f"{b} AS {START_DATE}", f"CAST(NULL AS DATE) AS {END_DATE}"]
    if broadcast_source:
        # keys of the open set that the batch touches, one row each: bounded by
        # the (already broadcast) source.  The same keyed counts, combined
        # map-side, hold the duplicate check, so only keys are shuffled, once.
        # A left join, as an anti join is planned once per branch of a union.
        keys = src.select(key)
        touched = cur.select(key).join(F.broadcast(keys), key, "left_semi")
        counts = (
            keys.selectExpr(k, "1L AS _new", "0L AS _old")
            .union(touched.selectExpr(k, "0L AS _new", "1L AS _old"))
            .groupBy(key)
            .agg(F.sum("_new").alias("_new"), F.max("_old").alias("_old"))
        )
        known = f"CASE WHEN _new > 1 THEN {_duplicate_error(key)} ELSE _old > 0 END" if check_duplicates else "_old > 0"
        seen = counts.where(known).selectExpr(f"{k} AS _k")
        fresh = src.join(F.broadcast(seen), src[key] == seen["_k"], "left").where("_k IS NULL")
        parts.append(fresh.selectExpr(*[q(c) for c in base], *stamp, f"'{OP_INSERT}' AS {OP}"))
    if keep_null_keys:
        dropped = source.where(f"{k} IS NULL")
        parts.append(dropped.selectExpr(*[q(c) for c in base], *stamp, f"'{OP_NULL_KEY}' AS {OP}"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)  # all parts share the column order of ``cols + [_op]``
    return out


def scd2_strict(
    source: DataFrame,
    target: DataFrame,
    key: str,
    change_cols: Sequence[str],
    batch_date: str | dt.date,
    check_duplicates: bool = True,
) -> DataFrame:
    """New target in strict mode: closed history untouched plus
    :func:`scd2_strict_changes` of the open versions."""
    cols = target_columns(source.columns)
    history = target.where(F.col(END_DATE).isNotNull()).select(*cols)
    current = target.where(F.col(END_DATE).isNull())
    changes = scd2_strict_changes(source, current, key, change_cols, batch_date, check_duplicates).drop(OP)
    return history.unionByName(changes)


def scd2_merge(
    source: DataFrame,
    target: DataFrame,
    key: str,
    change_cols: Sequence[str],
    batch_date: str | dt.date,
    mode: str = STRICT,
) -> DataFrame:
    """Whole new target for either definition (see module docstring)."""
    _check_mode(mode)
    if mode == STRICT:
        return scd2_strict(source, target, key, change_cols, batch_date)
    return scd2_compat(source, target, key, change_cols, batch_date)
