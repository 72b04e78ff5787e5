"""SimHash near-dedup with multi-index hashing.

A text's fingerprint has a bit set where more than half of its shingles' XXH64
hashes have it set.  Documents link when their fingerprints differ in at most
``distance`` (3) bits, and components of links are the groups.

Method: equal fingerprints collapse first (one row each, with the smallest id),
so copies cost nothing further.  The 64 bits are split into two 32-bit segments;
two fingerprints within three bits agree within one bit in at least one segment.
Every fingerprint stands in a table under both segment values; the ball of radius
one around each value is enumerated, matched against the table, and complete
distances verified.  Values one bit apart differ in parity, so only values of
even parity enumerate their 32 neighbours: every pair is still met once a
segment.  Probes are first matched against bucket counts, which drops the vast
majority.

A bucket of more than ``BUCKET`` fingerprints is split by the same method once
more: within it the other segment's two 16-bit parts must agree within one bit in
one of them.  So a cloud of near copies does not make all pairs of a bucket, and
nothing is capped.  At that level 48 bits are fixed, which bounds any bucket by
the 65,536 values of the other 16, whatever the input.

Defined results: null and empty texts have fingerprint zero and link like any
other; fewer words than a shingle make one shingle; an empty table gives no
rows; null ids never name a component unless it has no other id; repeated rows
share a fingerprint; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import aside, components, doc_columns, ship, staged

SEED = 42
DISTANCE = 3
BUCKET = 64
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint as a signed integer."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    n = max(1, len(words) - shingle + 1)
    begins = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist() if len(words) >= shingle else [len(joined)]
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, BLOCK):
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(begins[k : k + BLOCK], stops[k : k + BLOCK])], np.uint64)
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.int64)[0])


def fingerprints(shingle: int = 3):
    """Pandas UDF from a text column to fingerprints."""

    @pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return udf


def _parts(value, width: int):
    """The two halves of an integer column, numbered."""
    mask = (1 << width) - 1
    return F.array(
        F.struct(F.lit(0).alias("s"), value.bitwiseAND(mask).alias("k"), F.shiftrightunsigned(value, width).bitwiseAND(mask).alias("o")),
        F.struct(F.lit(1).alias("s"), F.shiftrightunsigned(value, width).bitwiseAND(mask).alias("k"), value.bitwiseAND(mask).alias("o")),
    )


def _ball(key: str, width: int) -> str:
    """SQL for the values within one bit of ``key``: (value, distance)."""
    return f"concat(array(named_struct('k', {key}, 'd', 0)), transform(sequence(0, {width - 1}), i -> named_struct('k', {key} ^ shiftleft(1L, i), 'd', 1)))"


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints within ``distance`` (at most 3) bits.

    ``fps`` has one row for each fingerprint, column ``fp``.  A pair may come once
    for each segment."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one cover distances of 0 to 3")
    table = staged(fps.select("fp", F.explode(_parts(F.col("fp"), 32)).alias("p")).select("fp", "p.*"), "simhash-table")
    sizes = table.groupBy("s", "k").agg(F.count(F.lit(1)).alias("n"))
    even = "bit_count(k) % 2 = 0"
    probes = table.select("fp", "s", "o", F.explode(F.expr(f"if({even}, {_ball('k', 32)}, array(named_struct('k', k, 'd', 0)))")).alias("b")).select(
        "fp", "s", "o", "b.k", "b.d"
    )
    met = staged(probes.join(sizes, ["s", "k"]).where("d > 0 OR n > 1"), "simhash-probes")
    near = F.expr(f"bit_count(fp ^ gp) <= {distance}") & ((F.col("d") > 0) | (F.col("fp") < F.col("gp")))
    hit = met.select("s", "k", "n").distinct()
    there = staged(table.join(hit, ["s", "k"]).select("s", "k", "n", F.col("fp").alias("gp"), F.col("o").alias("go")), "simhash-met")
    few = met.where(F.col("n") <= bucket).join(there.where(F.col("n") <= bucket).drop("n"), ["s", "k"]).where(near)
    inner = met.where(F.col("n") > bucket).select("fp", "s", "k", "d", F.explode(_parts(F.col("o"), 16)).alias("p"))
    inner = inner.select("fp", "s", "k", "d", F.col("p.s").alias("t"), F.explode(F.expr(_ball("p.k", 16))).alias("b")).select(
        "fp", "s", "k", "d", "t", F.col("b.k").alias("j")
    )
    held = there.where(F.col("n") > bucket).select("gp", "s", "k", F.explode(_parts(F.col("go"), 16)).alias("p"))
    held = held.select("gp", "s", "k", F.col("p.s").alias("t"), F.col("p.k").alias("j"))
    many = inner.join(held, ["s", "k", "t", "j"]).where(near)
    return few.select(F.col("fp").alias("a"), F.col("gp").alias("b")).unionByName(many.select(F.col("fp").alias("a"), F.col("gp").alias("b")))


def groups(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``(fp, root, component_id)`` for each fingerprint of ``prints`` (``doc_id, fp``).

    ``root`` is the least fingerprint of the component, ``component_id`` its
    smallest doc_id."""
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    roots = components(links(fps, distance, bucket))
    named = staged(
        fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")),
        "simhash-roots",
    )
    least = named.where("linked").groupBy("root").agg(F.min("rep").alias("least"))
    return named.join(least, "root", "left").select("fp", "root", F.when(F.col("linked"), F.col("least")).otherwise(F.col("rep")).alias("component_id"))


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """One row per document: ``doc_id, fp, root, component_id``."""
    base = doc_columns(docs, id_col, text_col)
    prints = staged(base.select("doc_id", fingerprints(shingle)("text").alias("fp")), "simhash-prints")
    return prints.join(groups(prints, distance, bucket), "fp")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each group, that with the smallest id.

    Where several rows of a group share that id, one of them stays."""
    ship(docs.sparkSession)
    names = docs.columns
    docs, (id_col, text_col) = aside(docs, id_col, text_col)
    prints = staged(docs.withColumn("__fp", fingerprints(shingle)(F.col(text_col).cast("string"))), "simhash-docs")
    known = groups(prints.select(F.col(id_col).alias("doc_id"), F.col("__fp").alias("fp")), distance)
    known = staged(known.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), F.col("component_id").alias("__keep")), "simhash-groups")
    stays = prints.join(known, "__fp").where(F.col(id_col).eqNullSafe(F.col("__keep")))
    ids = prints.select(id_col, "__fp").join(known, "__fp").where(F.col(id_col).eqNullSafe(F.col("__keep")))
    twice = staged(ids.groupBy("__root").count().where("count > 1").select("__root"), "simhash-twice")
    if not twice.isEmpty():
        stays = stays.join(twice, "__root", "left_anti").unionByName(
            stays.join(twice, "__root", "left_semi").dropDuplicates(["__root"]), allowMissingColumns=True
        )
    return stays.select(*docs.columns).toDF(*names)
