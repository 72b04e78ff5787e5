"""Exact dedup with a heavy-hitter split, in DataFrame operations only.

Texts are equal when identical after replacing each run of spaces, TAB, LF, VT,
FF and CR by one space; null counts as empty.  Of equal texts the row with the
smallest doc_id stays.

Method: one pass reduces each text to its SHA-256 digest and stages (id, digest).
A frequent-items sketch (Spark's ``approx_top_k``, a Misra-Gries sketch with a
fixed number of counters, merged map-side) proposes digests; their exact counts
and winners are computed by a grouped aggregate, and only those that truly hold
at least ``1 / counters`` of the rows are kept as heavy.  There are at most
``candidates`` of them, so they are broadcast and their rows are settled
map-side.  The other digests go through an ordinary aggregate and join.

Defined results: an empty table gives no rows; null ids sort after every other
id and stay only where a group has no other id; rows that repeat both id and
text are all marked like the row that stays (``keep_rows`` counts them, and
:func:`drop_duplicates` keeps one of them); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, doc_columns, staged

COUNTERS = 1024
CANDIDATES = 256


def digest(text):
    """32-byte digest of the normalised text."""
    return F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), 256))


def heavy_digests(rows: DataFrame, counters: int = COUNTERS, candidates: int = CANDIDATES) -> DataFrame:
    """``(digest, keep_id, group_size, keep_rows)`` of verified heavy hitters, at most ``candidates`` rows."""
    found = rows.select(F.xxhash64("digest").alias("h")).selectExpr(
        f"approx_top_k(h, {candidates}, {counters}) AS top", "count(*) AS n"
    ).first()
    least = max(2, -(-found["n"] // counters))
    hashes = [x["item"] for x in found["top"] or [] if x["count"] * 2 >= least]
    exact = groups(rows.where(F.xxhash64("digest").isin(hashes)) if hashes else rows.limit(0))
    return staged(exact.where(F.col("group_size") >= least).orderBy(F.desc("group_size"), "digest").limit(candidates), "heavy")


def groups(rows: DataFrame) -> DataFrame:
    """Winner and size of each digest, combined map-side."""
    by_id = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return by_id.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("n").alias("n")))["n"].alias("keep_rows"),
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, candidates: int = CANDIDATES
) -> DataFrame:
    """One row per document: ``doc_id, digest, keep_id, group_size, keep_rows, kept``."""
    base = doc_columns(docs, id_col, text_col)
    rows = staged(base.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    heavy = F.broadcast(heavy_digests(rows, counters, candidates))
    rest = rows.join(heavy.select("digest"), "digest", "left_anti")
    out = rows.join(heavy, "digest").unionByName(rest.join(groups(rest).hint("merge"), "digest"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, one row of each text.

    Only groups of two or more rows are looked up; all columns stay as they are.
    The copies in the largest groups, at most :data:`CANDIDATES` of them, go map-side;
    what is left is joined in a shuffle, at every size.
    """
    names = docs.columns
    docs, (id_col, text_col) = aside(docs, id_col, text_col)
    info = exact_dedup(docs, id_col, text_col).where("group_size > 1")
    dups = staged(info.groupBy("digest").agg(F.first("keep_id").alias("keep_id"), F.first("keep_rows").alias("keep_rows"), F.count(F.lit(1)).alias("n")), "duplicates")
    heavy = staged(dups.orderBy(F.desc("n"), "digest").limit(CANDIDATES), "duplicates-heavy")
    heavy = heavy.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"), F.lit(True).alias("__heavy"))
    marked = docs.withColumn("__digest", digest(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    info = dups.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"), F.col("keep_rows").alias("__n"))
    stays = F.col(id_col).eqNullSafe(F.col("__keep"))
    marked = marked.join(F.broadcast(heavy), "__digest", "left").where(F.col("__heavy").isNull() | stays).drop("__keep", "__heavy")
    marked = marked.join(info.hint("merge"), "__digest", "left")
    single = marked.where(F.col("__n").isNull() | (stays & (F.col("__n") == 1)))
    if not dups.where("keep_rows > 1").isEmpty():
        single = single.unionByName(marked.where(stays & (F.col("__n") > 1)).dropDuplicates(["__digest"]))
    return single.select(*docs.columns).toDF(*names)
