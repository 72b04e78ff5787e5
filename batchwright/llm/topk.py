"""Exact top-k inner-product search by a three-phase uniform threshold.

The components of the vectors are dealt over ``lists``; a list knows its own part
of every vector, so its local score for a query is a partial inner product and
a score is the sum of the local ones.

1. Gather: every list reports each query's best local scores.  These candidates
   are scored exactly; the last place among a query's best is its cutoff.
2. Broadcast: the cutoff goes to all lists.  A score that reaches it has a local
   score of at least cutoff / lists in some list (otherwise the sum is below it,
   also with negative scores), so each list collects all entries that do.
3. Resolve: what an entry lacks is computed from the lists that did not report
   it, unless its upper bound stays below the cutoff, and the best are ranked.

Equal vectors are one vector with its ``k + 1`` first rows, which is all that a
query can ever need of them, so a vector that a third of the rows share costs
nothing more.  Vectors lie in blocks of bounded bytes, dealt by hash; queries are
blocked alike and every query block meets every vector block, one pair at a time
in a task.  Nothing but counts passes through the driver.

Scores are exact integers: float32 products where all sums stay below 2^24,
float64 below 2^53, else 64-bit integers; components that could overflow those
are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_type, ship, staged

#: Query vectors a block, bytes of vectors a block at most, vectors a block at least (below it a block is not worth a task).
QUERY_BLOCK, BLOCK_BYTES, LEAST_BLOCK = 1024, 16 << 20, 1024
#: Vectors scored at once within a block.
CHUNK = 8192
#: Parts that the rows of one query vector are joined in.
SALTS = 16
#: Cutoff of a query that has fewer candidates than places: everything is collected.
NO_CUTOFF = -(1 << 62)


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, row, vec``: floor(scale * x) of every component x, as long.

    Vectors that are null or hold null or non-finite components are left out."""
    x = F.col(vec_col)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    grid = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return rows.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).alias("vec_id"), F.monotonically_increasing_id().alias("row"), grid.alias("vec")
    )


def first_rows(found: DataFrame, n: int) -> DataFrame:
    """Per distinct vector its ``n`` first rows by ``vec_id`` (nulls last), cut down before the shuffle."""
    order = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    few = found.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= n)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("__place", "vec_id", "row"))).alias("members"))


def blocked(vectors: DataFrame, blocks: int) -> DataFrame:
    return vectors.withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int"))


class Shape:
    """Dimension, lists and number types that all blocks share."""

    def __init__(self, dim: int, top: int, lists: int):
        if dim * top * top >= 1 << 63:
            raise OverflowError(f"{dim} components up to {top}: scores do not fit 64 bits")
        edges = np.linspace(0, dim, min(lists, max(dim, 1)) + 1).astype(int)
        self.dim, self.parts = dim, list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        self.stored = np.dtype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)
        bound = dim * top * top
        self.exact = np.dtype(np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64)

    def matrix(self, data: bytes, i: int) -> np.ndarray:
        a, b = self.parts[i]
        n = len(data) // self.stored.itemsize // (b - a) if b > a else 0
        return np.frombuffer(data, self.stored).reshape(n, b - a)


def packed(placed: DataFrame, shape: Shape, members: bool) -> DataFrame:
    """One row a block: ``block, n, lists`` (a matrix per list) and, flat, its vectors' first rows."""

    def pack(df: pd.DataFrame) -> pd.DataFrame:
        if "at" in df.columns:
            df = df.sort_values("at")
        data = np.zeros((len(df), shape.dim), shape.stored)  # shorter vectors: zeros
        for i, v in enumerate(df["vec"]):
            data[i, : len(v)] = v
        out = {"block": [int(df["block"].iloc[0])], "n": [len(df)], "lists": [[np.ascontiguousarray(data[:, a:b]).tobytes() for a, b in shape.parts]]}
        if members:
            flat = [m for ms in df["members"] for m in ms]
            out["sizes"] = [np.array([len(ms) for ms in df["members"]], np.int32).tobytes()]
            out["nulls"] = [np.array([m["vec_id"] is None for m in flat], bool).tobytes()]
            out["ids"] = [np.array([m["vec_id"] or 0 for m in flat], np.int64).tobytes()]
            out["rows"] = [np.array([m["row"] for m in flat], np.int64).tobytes()]
        return pd.DataFrame(out)

    fields = "block int, n int, lists array<binary>" + (", sizes binary, nulls binary, ids binary, rows binary" if members else "")
    return placed.groupBy("block").applyInPandas(pack, fields)


def met(queries: DataFrame, vectors: DataFrame, blocks: int) -> DataFrame:
    """Every query block beside every vector block, list by list."""
    asked = queries.select("qb", F.posexplode("lists").alias("l", "asked"), *[c for c in ("cuts",) if c in queries.columns])
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("xb"))
    held = vectors.select(F.col("block").alias("xb"), F.posexplode("lists").alias("l", "held"))
    return asked.join(held.hint("merge"), ["l", "xb"])


def _local(shape: Shape, l: int, asked: np.ndarray, held: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Local scores of all queries of a block, for the next ``CHUNK`` vectors at a time."""
    asked = asked.astype(shape.exact)
    for start in range(0, len(held), CHUNK):
        yield start, asked @ held[start : start + CHUNK].astype(shape.exact).T


def gather(pairs: DataFrame, shape: Shape, places: int) -> DataFrame:
    """Phase 1: per list and query the ``places`` best local scores, over all blocks."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                asked, held = shape.matrix(r.asked, r.l), shape.matrix(r.held, r.l)
                score, at = np.empty((len(asked), 0), shape.exact), np.empty((len(asked), 0), np.int64)
                for start, s in _local(shape, r.l, asked, held):
                    score = np.concatenate([score, s], axis=1)
                    at = np.concatenate([at, np.broadcast_to(np.arange(start, start + s.shape[1]), s.shape)], axis=1)
                    if score.shape[1] > places:
                        pick = np.argpartition(-score, places - 1, axis=1)[:, :places]
                        score, at = np.take_along_axis(score, pick, 1), np.take_along_axis(at, pick, 1)
                n, m = score.shape
                yield pd.DataFrame(
                    {"l": r.l, "qb": r.qb, "xb": r.xb, "qi": np.repeat(np.arange(n, dtype=np.int32), m), "xi": at.ravel().astype(np.int32), "local": score.ravel().astype(np.int64)}
                )

    out = pairs.mapInPandas(best, row_type("l int,qb int,xb int,qi int,xi int,local long"))
    order = Window.partitionBy("l", "qb", "qi").orderBy(F.col("local").desc(), "xb", "xi")
    return out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= places).drop("place")


def by_pair(candidates: DataFrame) -> DataFrame:
    """Candidates of :func:`gather` packed as :func:`collect` packs entries."""

    def pack(df: pd.DataFrame) -> pd.DataFrame:
        out = [
            {"qb": g["qb"].iloc[0], "xb": g["xb"].iloc[0], "chunk": 0, "l": l, "qi": g["qi"].to_numpy(np.int32).tobytes(), "xi": g["xi"].to_numpy(np.int32).tobytes(), "local": g["local"].to_numpy(np.int64).tobytes()}
            for l, g in df.groupby("l")
        ]
        return pd.DataFrame(out)

    return candidates.groupBy("qb", "xb").applyInPandas(pack, row_type("qb int,xb int,chunk int,l int,qi binary,xi binary,local binary"))


def collect(pairs: DataFrame, shape: Shape) -> DataFrame:
    """Phase 2: per list all entries that reach their query's share of the cutoff.

    One row per list, query block and chunk of vectors, the entries packed."""

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                cuts = np.frombuffer(r.cuts, np.int64)
                share = (-(-cuts // len(shape.parts))).astype(shape.exact)  # least whole local score that reaches it
                for start, s in _local(shape, r.l, shape.matrix(r.asked, r.l), shape.matrix(r.held, r.l)):
                    qi, xi = np.nonzero(s >= share[:, None])
                    if len(qi):
                        yield pd.DataFrame(
                            {"qb": [r.qb], "xb": [r.xb], "chunk": [start], "l": [r.l], "qi": [qi.astype(np.int32).tobytes()], "xi": [(xi + start).astype(np.int32).tobytes()], "local": [s[qi, xi].astype(np.int64).tobytes()]}
                        )

    return pairs.mapInPandas(reach, row_type("qb int,xb int,chunk int,l int,qi binary,xi binary,local binary"))


def resolve(entries: DataFrame, queries: DataFrame, vectors: DataFrame, shape: Shape, members: bool) -> DataFrame:
    """Phase 3: exact scores of the entries, what is known taken, the rest computed.

    With ``members`` only scores that reach the cutoff are returned, one row for
    each of the vector's first rows; otherwise one row per entry."""
    known = entries.groupBy("qb", "xb", "chunk").agg(F.collect_list(F.struct("l", "qi", "xi", "local")).alias("known"))
    asked = known.join(queries.withColumnRenamed("lists", "asked").hint("merge"), "qb")
    both = asked.join(vectors.withColumnRenamed("block", "xb").withColumnRenamed("lists", "held").drop("n").hint("merge"), "xb")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                yield one(r)

    def one(r) -> pd.DataFrame:
        m = len(shape.parts)
        reports = [(k["l"], np.frombuffer(k["qi"], np.int32).astype(np.int64) << 32 | np.frombuffer(k["xi"], np.int32), np.frombuffer(k["local"], np.int64)) for k in r.known]
        codes = np.unique(np.concatenate([c for _, c, _ in reports]))
        total, seen = np.zeros(len(codes), np.int64), np.zeros((m, len(codes)), bool)
        for l, code, local in reports:
            at = np.searchsorted(codes, code)
            total[at] += local
            seen[l, at] = True
        cuts = np.frombuffer(r.cuts, np.int64)[codes >> 32] if members else None
        if members:  # a list that did not report an entry has less than its share of the cutoff
            share, lacking = -(-cuts // m), (~seen).sum(axis=0)
            live = (cuts == NO_CUTOFF) | (total + lacking * (share - 1) >= cuts)
            codes, total, seen, cuts = codes[live], total[live], seen[:, live], cuts[live]
        for l in range(m):
            lacks = np.flatnonzero(~seen[l])
            asked, held = shape.matrix(r.asked[l], l), shape.matrix(r.held[l], l)
            for i in range(0, len(lacks), 1 << 18):
                part = lacks[i : i + (1 << 18)]
                a, b = asked[codes[part] >> 32].astype(np.int64), held[codes[part] & 0xFFFFFFFF].astype(np.int64)
                total[part] += np.einsum("ij,ij->i", a, b)
        qi, xi = codes >> 32, codes & 0xFFFFFFFF
        if not members:
            return pd.DataFrame({"qb": np.full(len(codes), r.qb, np.int32), "qi": qi.astype(np.int32), "score": total})
        hit = total >= cuts
        qi, xi, total = qi[hit], xi[hit], total[hit]
        sizes = np.frombuffer(r.sizes, np.int32).astype(np.int64)
        starts, n = np.cumsum(sizes) - sizes, sizes[xi]
        at = np.repeat(starts[xi] - np.cumsum(n) + n, n) + np.arange(n.sum())
        ids = pd.Series(np.frombuffer(r.ids, np.int64)[at], dtype="Int64").mask(np.frombuffer(r.nulls, bool)[at])
        return pd.DataFrame(
            {"qb": np.full(len(at), r.qb, np.int32), "qi": np.repeat(qi, n).astype(np.int32), "score": np.repeat(total, n), "vec_id": ids, "row": np.frombuffer(r.rows, np.int64)[at]}
        )

    return both.mapInPandas(finish, row_type("qb int,qi int,score long" + (",vec_id long,row long" if members else "")))


def cutoffs(scores: DataFrame, places: int) -> DataFrame:
    """Per query block the score on each query's last place, packed (``NO_CUTOFF`` where places stay empty)."""
    order = Window.partitionBy("qb", "qi").orderBy(F.col("score").desc())
    last = scores.withColumn("place", F.row_number().over(order)).where(F.col("place") <= places)
    cut = last.groupBy("qb", "qi").agg(F.when(F.count(F.lit(1)) == places, F.min("score")).otherwise(F.lit(NO_CUTOFF)).alias("cut"))
    return cut.groupBy("qb").agg(F.sort_array(F.collect_list(F.struct("qi", "cut"))).alias("cut"))


def with_cutoffs(queries: DataFrame, cuts: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            df["cuts"] = [np.array([c["cut"] for c in r], np.int64).tobytes() for r in df["cut"]]
            yield df[["qb", "lists", "cuts"]]

    return queries.join(cuts.hint("merge"), "qb").select("qb", "lists", "cut").mapInPandas(pack, "qb int, lists array<binary>, cuts binary")


def exact_top_k(
    rows: DataFrame, is_query: Callable[[Column], Column], k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, lists: int = 2
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's ``k`` best other rows.

    ``is_query`` tells from an id whether its row is a query; a null id is none.
    Ties go to the smaller id, null ids last, then to the earlier row.  Rows are
    told apart by position, not by id: of repeated ids each row is a query and a
    candidate of its own.  Vectors that are null or hold null or non-finite
    components take no part; of vectors of different lengths the shorter count as
    filled up with zeros.  Columns other than the two are not read.  Empty tables
    give no rows.
    """
    spark, places = rows.sparkSession, k + 1  # one place more, for the query itself
    ship(spark)
    found = staged(integer_vectors(rows, id_col, vec_col, scale), "topk-rows")
    asking = found.where(F.coalesce(is_query(F.col("vec_id")), F.lit(False)))
    size = found.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"), F.max(F.array_max(F.transform("vec", F.abs))).alias("top")).first()
    asked_rows = asking.count()
    if not asked_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shape = Shape(max(size["dim"], 1), size["top"] or 0, lists)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-size["n"] * shape.dim * shape.stored.itemsize // BLOCK_BYTES), min(-(-size["n"] // LEAST_BLOCK), parallel))
    vectors = staged(packed(blocked(first_rows(found, places), blocks), shape, members=True), "topk-vectors")
    in_block = Window.partitionBy("block").orderBy("vec")
    distinct = blocked(asking.select("vec").distinct(), -(-asked_rows // QUERY_BLOCK))
    asked = staged(distinct.withColumn("at", (F.row_number().over(in_block) - 1).cast("int")), "topk-queries")
    queries = staged(packed(asked, shape, members=False).select(F.col("block").alias("qb"), "lists"), "topk-query-blocks")

    candidates = by_pair(gather(met(queries, vectors, blocks), shape, places))
    cuts = cutoffs(resolve(candidates, queries, vectors, shape, members=False), places)
    queries = staged(with_cutoffs(queries, cuts), "topk-cutoffs")
    entries = staged(collect(met(queries, vectors, blocks), shape), "topk-entries")
    scored = resolve(entries, queries, vectors, shape, members=True)

    order = Window.partitionBy("qb", "qi").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    best = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= places)
    lists_of = best.groupBy("qb", "qi").agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id", "row"))).alias("best"))
    by_vector = lists_of.join(asked.select("vec", F.col("block").alias("qb"), F.col("at").alias("qi")), ["qb", "qi"])
    by_vector = by_vector.select("vec", "best", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    asking = asking.select("vec", F.col("vec_id").alias("query_id"), F.col("row").alias("own"), F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    others = F.slice(F.filter("best", lambda b: b["row"] != F.col("own")), 1, k)
    return (
        asking.join(by_vector.hint("merge"), ["vec", "salt"])
        .select("query_id", F.posexplode(others).alias("rank", "b"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
    )
