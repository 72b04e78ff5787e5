"""The Merkle manifest against a plain tree and SQL."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from batchwright.llm import merkle, queries
from tests.conftest import SF

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(row, fields=FIELDS):
    return h("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        s = i // 3 * 3
        out.append(("".join(nodes[s:i]), "".join(nodes[i + 1 : s + 3])))
        i //= 3
    return out


def slow(rows, received=lambda r: r):
    """(doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of every row."""
    trees = defaultdict(list)
    for r in rows:
        trees[(r["source"] is not None, (r["source"] or "").encode())].append(r)
    trees = {k: sorted(v, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for k, v in sorted(trees.items())}
    inner = [climb([leaf(r) for r in v]) for v in trees.values()]
    outer = climb([x[-1][0] for x in inner])
    out = []
    for t, v in enumerate(trees.values()):
        for i, r in enumerate(v):
            path = way(inner[t], i) + way(outer, t)
            node = leaf(received(r))
            for left, right in path:
                node = h(left + node + right)
            proof = "/".join(f"{a}|{b}" for a, b in path)
            out.append((r["doc_id"], leaf(r), inner[t][-1][0], outer[-1][0], proof, h("".join(a + b for a, b in path)), node, node == outer[-1][0]))
    return sorted(out, key=str)


def made(spark, n):
    """``n`` rows, most of one source, some null, with repeated rows and ids."""
    rows = [
        (i if i % 17 else None, None if i % 11 == 0 else "big" if i % 4 else f"sü\U0001f600{i % 9}", "en" if i % 3 else None, i if i % 5 else None, None if i % 13 == 0 else f"t\n{i} é\n" if i % 2 else "")
        for i in range(n)
    ]
    rows += [(3, "big", "en", 3, "same")] * (n // 3)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return df.withColumns({c: F.lit(c) for c in ("tree", "node", "i", "n", "id", "key", "row", "block", "bucket", "part", "received", "root")}).repartition(4)


def received():
    return {"text": F.replace("text", F.lit("\n"), F.lit(""))}


def strip(r):
    return {**r, "text": None if r["text"] is None else r["text"].replace("\n", "")}


@pytest.mark.parametrize(("n", "levels"), [(0, 7), (1, 7), (2, 1), (100, 7), (60, 1), (700, 2)])
def test_manifest(spark, monkeypatch, n, levels):
    monkeypatch.setattr(merkle, "BUCKET", 64)
    docs = made(spark, n).cache()
    rows = [r.asDict() for r in docs.collect()]
    assert sorted(map(tuple, merkle.merkle_manifest(docs, received=received(), height=levels).collect()), key=str) == slow(rows, strip)


def test_odd_documents(odd, empty):
    rows = [r.asDict() for r in odd.collect()]
    out = merkle.merkle_manifest(odd)
    assert sorted(map(tuple, out.collect()), key=str) == slow(rows)
    assert all(r["verified"] for r in out.collect())
    assert merkle.merkle_manifest(empty).collect() == []
    assert merkle.merkle_manifest(empty).schema == out.schema


def test_many_sources(spark):
    """Each row a tree of its own: the roots' tree is the large one."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), "id").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("x").alias("text"))
    rows = [r.asDict() for r in docs.collect()]
    assert sorted(map(tuple, merkle.merkle_manifest(docs).collect()), key=str) == slow(rows)


def test_against_sql(spark):
    out = queries.queries()["op12_merkle_manifest"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    theirs = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()['op12_merkle_manifest']})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(theirs)
    assert {r["verified"] for r in out.collect()} == {True, False}
