"""Dated batches derived from the driver's TPC-H shaped tables.

Every batch is a pure expression over a whole input table, so its size
follows the table's.  Batches b1..b3 are dated 2022-11-01..03:

* customer (SCD): b1 as is; b2 sets ``c_mktsegment`` to ``CHANGED`` on keys
  divisible by 10 and adds copies of keys below 7 as new keys (-1 - key,
  ``c_name`` = ``New#<key>``); b3 is b2 with the original segment back on
  keys divisible by 20.
* supplier (SCD): b1 as is; b2 adds 100 to ``s_acctbal`` on keys divisible
  by 4; b3 is b2 and also moves keys divisible by 6 to the next nation.
* part (truncate): b1 all, b2 ``p_size > 10``, b3 ``p_size > 20``.
* orders (append): split by ``o_orderdate``: before 1997, 1997-1998, from 1999
  or without a date; lineitem (append) likewise by ``l_shipdate``.
* nation, region (truncate): as is in every batch.

:func:`customer_malformed_batch` writes unparsable fields for the
bad-record count.

:func:`original_batch` fills the tables of the original programs, which have other
schemas, from the columns of these tables (two batches, see there).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.delimited import write_delimited
from ..specs import APPEND, SCD, TableSpec
from .pipeline import concurrently
from .registry import DRIVER_SCHEMAS, REFERENCE_BASIC_TABLES, REFERENCE_BATCH_TABLES

BATCH_DATES = (dt.date(2022, 11, 1), dt.date(2022, 11, 2), dt.date(2022, 11, 3))


def batch_name(n: int) -> str:
    return f"batch_{BATCH_DATES[n - 1].isoformat()}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with the registry's column types (dates as ``date``)."""
    cols = [c.strip().split(" ") for c in DRIVER_SCHEMAS[name].split(",")]
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*[F.col(c).cast(t).alias(c) for c, t in cols])


def _divisible(c: str, n: int) -> Column:
    return F.col(c) % n == 0


def customer_batch(base: DataFrame, n: int) -> DataFrame:
    if n == 1:
        return base
    seg = F.when(_divisible("c_custkey", 10), F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))
    if n == 3:
        seg = F.when(_divisible("c_custkey", 20), F.col("c_mktsegment")).otherwise(seg)
    changed = base.withColumn("c_mktsegment", seg)
    new_key = F.lit(-1) - F.col("c_custkey")  # cannot meet a key of the table
    added = base.where(F.col("c_custkey") < 7).select(
        new_key.alias("c_custkey"),
        F.concat(F.lit("New#"), new_key.cast("string")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )
    return changed.unionByName(added)


def customer_nulls_batch(base: DataFrame, n: int) -> DataFrame:
    """customer batches with NULLs: segment NULL on keys divisible by 7 in
    every batch; b2 adds copies of keys with remainder 1 mod 25 under a
    NULL key."""
    with_nulls = base.withColumn(
        "c_mktsegment", F.when(_divisible("c_custkey", 7), F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    )
    out = customer_batch(with_nulls, n)
    if n >= 2:
        out = out.unionByName(
            with_nulls.where(F.col("c_custkey") % 25 == 1).withColumn("c_custkey", F.lit(None).cast("bigint"))
        )
    return out


def customer_malformed_batch(base: DataFrame) -> DataFrame:
    """customer as text with unparsable fields: ``c_acctbal`` is ``n/a`` on
    keys divisible by 13 and ``c_nationkey`` is ``x`` on keys divisible by
    17 (both on keys divisible by 221).  Every row is kept."""
    text = {c: F.col(c).cast("string") for c in base.columns}
    text["c_acctbal"] = F.when(_divisible("c_custkey", 13), F.lit("n/a")).otherwise(text["c_acctbal"])
    text["c_nationkey"] = F.when(_divisible("c_custkey", 17), F.lit("x")).otherwise(text["c_nationkey"])
    return base.select(*[text[c].alias(c) for c in base.columns])


def supplier_batch(base: DataFrame, n: int) -> DataFrame:
    if n == 1:
        return base
    out = base.withColumn(
        "s_acctbal", F.when(_divisible("s_suppkey", 4), F.col("s_acctbal") + 100).otherwise(F.col("s_acctbal"))
    )
    if n == 3:
        out = out.withColumn(
            "s_nationkey",
            F.when(_divisible("s_suppkey", 6), (F.col("s_nationkey") + 1) % 25).otherwise(F.col("s_nationkey")),
        )
    return out


def part_batch(base: DataFrame, n: int) -> DataFrame:
    return base if n == 1 else base.where(F.col("p_size") > (10 if n == 2 else 20))


def orders_batch(base: DataFrame, n: int) -> DataFrame:
    d = F.col("o_orderdate")
    if n == 1:
        return base.where(d < F.lit(dt.date(1997, 1, 1)))
    if n == 2:
        return base.where((d >= F.lit(dt.date(1997, 1, 1))) & (d <= F.lit(dt.date(1998, 12, 31))))
    return base.where((d >= F.lit(dt.date(1999, 1, 1))) | d.isNull())


def lineitem_batch(base: DataFrame, n: int) -> DataFrame:
    return orders_batch(base.withColumn("o_orderdate", F.col("l_shipdate")), n).drop("o_orderdate")


BUILDERS = {
    "customer": customer_batch,
    "supplier": supplier_batch,
    "part": part_batch,
    "orders": orders_batch,
    "lineitem": lineitem_batch,
    "nation": lambda base, n: base,
    "region": lambda base, n: base,
}


def batch_frame(spark: SparkSession, sf_dir: str, name: str, n: int) -> DataFrame:
    return BUILDERS[name](table(spark, sf_dir, name), n)


def _write_side_by_side(
    spark: SparkSession, root: str, frames: dict[str, DataFrame], sep: str = "|", parallelism: int = 8, compressed: bool = False
) -> None:
    """Write each frame to its path below ``root``, as concurrent jobs: a small table's
    single task leaves the other cores to the other tables."""
    tasks = {path: lambda p=path, df=df: write_delimited(df, f"{root}/{p}", sep, compressed) for path, df in frames.items()}
    concurrently(spark, tasks, parallelism)


def write_batches(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    tables: tuple[str, ...] = ("customer", "supplier", "part", "nation", "region", "orders"),
    batches: tuple[int, ...] = (1, 2, 3),
    sep: str = "|",
) -> list[str]:
    """Write ``<root>/batch_<date>/<table>/part-*`` for the given batches."""
    _write_side_by_side(spark, root, {f"{batch_name(n)}/{t}": batch_frame(spark, sf_dir, t, n) for n in batches for t in tables}, sep)
    return [batch_name(n) for n in batches]


def write_one_time_files(spark: SparkSession, sf_dir: str, root: str, names=("customer", "nation", "region"), sep: str = "|") -> None:
    """One-time load inputs ``<root>/<table>.dat``."""
    for t in names:
        write_delimited(table(spark, sf_dir, t), f"{root}/{t}.dat", sep)


def write_batch_frame(df: DataFrame, root: str, n: int, name: str, sep: str = "|") -> None:
    write_delimited(df, f"{root}/{batch_name(n)}/{name}", sep)


#: Each original table is made of one test table; the integer that tells its rows apart.
ORIGINS = {
    "customer": ("customer", "c_custkey"),
    "customer_address": ("customer", "c_custkey"),
    "customer_demographics": ("supplier", "s_suppkey"),
    "household_demographics": ("customer", "c_custkey"),
    "date_dim": ("part", "p_partkey"),
    "item": ("part", "p_partkey"),
    "promotion": ("supplier", "s_suppkey"),
    "store": ("nation", "n_nationkey"),
    "time_dim": ("nation", "n_nationkey"),
    "store_sales": ("lineitem", "(l_orderkey * 7 + l_linenumber)"),
}
#: Filled in one row of thirty.
SPARSE = "c_login"


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of a flat DDL schema."""
    return [tuple(c.split()) for c in ddl.split(",")]


def original_select(spec: TableSpec, n: int, new_keys: bool = False) -> tuple[list[str], str]:
    """Batch ``n`` (1 or 2) of an original table as SQL: the select list and the condition on its origin.

    Integers are remainders of the row's number, strings and doubles go round the
    origin's columns of that type.  In batch 2 an SCD row whose number divides by ten
    differs in one change column, another one for each ten; ``new_keys`` gives its
    further rows, copies of those numbered below 7 under new keys.  Truncated tables
    lose every third row, facts are split by date."""
    origin, key = ORIGINS[spec.name]
    pools = {t: [c for c, ct in fields(DRIVER_SCHEMAS[origin]) if ct == t] for t in ("string", "double")}
    out = []
    for i, (c, t) in enumerate(fields(spec.schema)):
        if i == 0 and spec.load != APPEND:
            e = f"CAST({'-1 - ' if new_keys else ''}{key} AS INT)"
        elif pools.get(t):
            e = pools[t][i % len(pools[t])]
        else:
            e = f"CAST(({key} * {i + 1} + {i}) % 9973 AS INT)"
            e = {"int": e, "double": f"{e} / CAST(4 AS DOUBLE)", "string": f"CONCAT('{c}', CAST({e} AS VARCHAR(9)))"}[t]
        if c == SPARSE:
            e = f"CASE WHEN {key} % 30 = 0 THEN {e} END"
        if spec.load == SCD and n == 2 and not new_keys and c in spec.change_columns:
            turn, turns = spec.change_columns.index(c), len(spec.change_columns)
            changed = {"int": f"{e} + 1", "double": f"{e} + 0.5", "string": f"({e}) || '~'"}[t]
            e = f"CASE WHEN {key} % {10 * turns} = {10 * turn} THEN {changed} ELSE {e} END"
        out.append(f"{e} AS {c}")
    if new_keys:
        return out, f"{key} < 7"
    if spec.load == APPEND:
        early = "CAST(l_shipdate AS DATE) < DATE '1997-01-01'"
        return out, early if n == 1 else f"{early} IS NOT TRUE"
    return out, "TRUE" if n == 1 or spec.load == SCD else f"{key} % 3 <> 0"


def original_batch(spark: SparkSession, sf_dir: str, spec: TableSpec, n: int) -> DataFrame:
    base = table(spark, sf_dir, ORIGINS[spec.name][0])
    parts = [original_select(spec, n)] + ([original_select(spec, n, new_keys=True)] if spec.load == SCD and n == 2 else [])
    frames = [base.where(where).selectExpr(*exprs) for exprs, where in parts]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def write_original_batches(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Both batches of every table, the facts first, as they take longest; compressed, as
    their text is ten times the Parquet tables that it is made of."""
    specs = sorted(REFERENCE_BATCH_TABLES, key=lambda s: s.load != APPEND)
    frames = {f"{batch_name(n)}/{s.name}": original_batch(spark, sf_dir, s, n) for s in specs for n in (1, 2)}
    _write_side_by_side(spark, root, frames, compressed=True)


def write_original_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    _write_side_by_side(spark, root, {s.file_name: original_batch(spark, sf_dir, s, 1) for s in REFERENCE_BASIC_TABLES})
