"""Merkle manifest of a dataset, with a proof per row and its check.

Rows are leaves, in one tree per value of ``tree_col`` ordered by id; the trees'
roots, ordered by that value, are the leaves of one more tree.  A run of ``ARITY``
nodes becomes their hash until one node is left.

Places come from a range shuffle by (tree, id) and a running count over its
partitions, so a tree that holds a third of all rows is spread like any other.
The tree is cut into superblocks of ``ARITY ** height`` consecutive nodes:

* up: each superblock is reduced to its top node; these are the next, far smaller
  level, until every tree has one node;
* down: the nodes of a level and the outer nodes that their superblock needs on
  its way to the root are cogrouped by superblock (whole superblocks, some to a
  bucket).  Each group finishes the reduction, joins inner and outer siblings to
  proofs, and at the leaves folds what was received up to the root.

Only counts pass through the driver; a task holds a few superblocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, staged

ARITY, LEVELS = 3, 7
#: Nodes a bucket on average (whole superblocks).
BUCKET = 4096


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def _hash(nodes: str) -> str:
    return hashlib.sha256(nodes.encode("ascii")).hexdigest()


def depth(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def reduced(nodes: list[str], total: int, height: int) -> list[list[str]]:
    """The levels of one superblock of a tree of ``total`` nodes, its own nodes first.

    A lone superblock ends at the tree's root, others ``height`` levels up."""
    levels = [nodes]
    for _ in range(min(depth(total), height)):
        nodes = [_hash("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
        levels.append(nodes)
    return levels


def inner_path(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Siblings left and right of node ``i``, level by level within its superblock."""
    path = []
    for nodes in levels[:-1]:
        start = i // ARITY * ARITY
        path.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + ARITY])))
        i //= ARITY
    return path


def write_path(path: list[tuple[str, str]]) -> str:
    return "/".join(f"{left}|{right}" for left, right in path)


def read_path(text: str) -> list[tuple[str, str]]:
    return [tuple(x.split("|")) for x in text.split("/")] if text else []


def fold(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = _hash(left + node + right)
    return node


def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``i``, the place within ``tree`` in the order of ``by``, and ``n``, the tree's size.

    ``by`` orders all rows of one tree; ties fall as the range shuffle leaves them."""
    sorted_rows = rows.repartitionByRange("tree", *by).sortWithinPartitions("tree", *by)
    placed = staged(sorted_rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle-sorted")
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns(
        {"before": F.coalesce(F.sum("size").over(before), F.lit(0)), "n": F.sum("size").over(Window.partitionBy("tree"))}
    ).drop("size")
    return placed.join(runs, ["tree", "part"]).withColumn("i", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def bucketed(nodes: DataFrame, buckets: int, block: Column) -> DataFrame:
    """Adds ``block``, the node's superblock, and ``bucket``, where it is worked on."""
    return nodes.withColumn("block", block).withColumn("bucket", F.pmod(F.xxhash64("tree", "block"), F.lit(buckets)))


def _superblocks(df: pd.DataFrame):
    """``tree, block, total, rows`` of each superblock of a bucket, rows in order."""
    for (tree, block), rows in df.sort_values(["tree", "i"]).groupby(["tree", "block"], sort=False):
        yield tree, block, int(rows["n"].iloc[0]), rows


def climb(nodes: DataFrame, buckets: int, height: int) -> DataFrame:
    """The next level: ``tree, i, n, node``, one node per superblock."""

    def tops(df: pd.DataFrame) -> pd.DataFrame:
        out = [
            (tree, block, -(-total // ARITY**height), reduced(rows["node"].tolist(), total, height)[-1][0])
            for tree, block, total, rows in _superblocks(df)
        ]
        return pd.DataFrame(out, columns=["tree", "i", "n", "node"])

    keyed = bucketed(nodes.select("tree", "i", "n", "node"), buckets, F.expr(f"i div {ARITY**height}"))
    return keyed.groupBy("bucket").applyInPandas(tops, "tree string, i long, n long, node string")


def tower(leaves: DataFrame, count: int, largest: int, height: int) -> list[tuple[DataFrame, int]]:
    """The levels of all trees and their buckets, up to one node a tree."""
    levels = [(leaves, max(1, count // BUCKET))]
    while largest > 1:
        nodes = staged(climb(*levels[-1], height), "merkle-level")
        levels.append((nodes, max(1, nodes.count() // BUCKET)))
        largest = -(-largest // ARITY**height)
    return levels


def descend(nodes: DataFrame, buckets: int, outer: DataFrame, height: int, finish, result: str) -> DataFrame:
    """Cogroups a level's nodes with the outer path of their superblock.

    ``outer`` has ``tree, i`` (of the superblock), ``path, subroot, root``.  ``finish``
    gets a superblock's rows, levels and outer row, and returns rows of ``result``."""

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        above = {(r.tree, r.block): r for r in right.itertuples(index=False)}
        out = []
        for tree, block, total, rows in _superblocks(left):
            out += finish(rows, reduced(rows["node"].tolist(), total, height), above[tree, block])
        return pd.DataFrame(out, columns=names)

    names = [f.split()[0] for f in result.split(",")]
    mine = bucketed(nodes, buckets, F.expr(f"i div {ARITY**height}")).groupBy("bucket")
    theirs = bucketed(outer, buckets, F.col("i")).groupBy("bucket")
    return mine.cogroup(theirs).applyInPandas(join, result)


PATHS = "tree string, i long, path string, subroot string, root string"


def _paths(rows: pd.DataFrame, levels: list[list[str]], above) -> list[tuple]:
    outer = read_path(above.path)
    out = []
    for tree, i, j in zip(rows["tree"], rows["i"], range(len(rows))):
        out.append((tree, i, write_path(inner_path(levels, j) + outer), above.subroot, above.root))
    return out


def outer_paths(levels: list[tuple[DataFrame, int]], top: DataFrame, height: int) -> DataFrame:
    """Paths of the nodes of the second level, which is what the first one's superblocks need."""
    for nodes, buckets in reversed(levels[1:]):
        top = staged(descend(nodes, buckets, top, height, _paths, PATHS), "merkle-paths")
    return top


LEAVES = "key string, leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(written: bool, rows: pd.DataFrame, levels: list[list[str]], above) -> list[tuple]:
    outer, folded = read_path(above.path), {}
    joined = "".join(a + b for a, b in outer)
    out = []
    for j, (key, leaf, received) in enumerate(zip(rows["key"], rows["node"], rows["received"])):
        path = inner_path(levels, j)
        top = fold(received, path)
        if top not in folded:
            folded[top] = fold(top, outer)
        siblings = "".join(a + b for a, b in path) + joined
        out.append((key, leaf, above.subroot, above.root, write_path(path + outer) if written else None, _hash(siblings), folded[top], folded[top] == above.root))
    return out


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    received: Mapping[str, Column] | None = None,
    id_col: str = "doc_id",
    tree_col: str = "source",
    proofs: bool = True,
    height: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``id, leaf, subroot, root, proof, proof_sha256,
    folded_root, verified``.

    A leaf hashes ``columns`` in order.  ``received`` gives columns as they
    arrived (default: unchanged); ``folded_root`` is folded from the leaf of the
    received row and the original siblings.  ``proof`` lists the siblings left and
    right of the way to the root, ``left|right`` a level, levels divided by ``/``
    (null unless ``proofs``: it is many times as long as the rest).  ``height`` sets
    the superblocks' size, not the result.

    A null id comes first in its tree and hashes as ``-``, as does any null; a
    null ``tree_col`` is a tree of its own, the first.  Rows with equal ids are in
    the order of their leaves; wholly equal rows are leaves of their own.  A lone
    leaf is its tree's root.  Columns not named are not read.  No rows, no result.
    """
    spark = docs.sparkSession
    ship(spark)
    leaf = leaf_hash([F.col(c) for c in columns])
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(id_col).cast("string").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.concat(F.lit("s"), F.col(tree_col).cast("string")), F.lit("n")).alias("tree"),  # n sorts before s
        leaf.alias("node"),
        (leaf_hash([received.get(c, F.col(c)) for c in columns]) if received else leaf).alias("received"),
    )
    # staged, as the range shuffle also samples its input; equal rows differ in ``row``
    leaves = staged(ranked(staged(rows, "merkle-rows"), ["id", "node", "row"]), "merkle-leaves")
    sizes = leaves.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("largest")).first()
    if not sizes["rows"]:
        return _result(spark.createDataFrame([], LEAVES), docs.schema[id_col].dataType)
    levels = tower(leaves, sizes["rows"], sizes["largest"], height)
    roots = levels[-1][0].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    forest = staged(ranked(roots, ["of"]), "merkle-roots")
    trees = forest.count()
    above = tower(forest, trees, trees, height)
    crown = above[-1][0].select("tree", "i", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    crown = outer_paths(above, crown, height)

    def of_trees(rows: pd.DataFrame, levels: list[list[str]], outer) -> list[tuple]:
        paths = _paths(rows, levels, outer)
        return [(of, 0, p[2], node, p[4]) for of, node, p in zip(rows["of"], rows["node"], paths)]

    top = staged(descend(forest, above[0][1], crown, height, of_trees, PATHS), "merkle-paths")
    proven = descend(leaves, levels[0][1], outer_paths(levels, top, height), height, partial(_proofs, proofs), LEAVES)
    return _result(proven, docs.schema[id_col].dataType)


def _result(rows: DataFrame, id_type: T.DataType) -> DataFrame:
    return rows.select(F.col("key").cast(id_type).alias("id"), *rows.columns[1:])
