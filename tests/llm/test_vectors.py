"""Exact top-k and vector codes against brute force and SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from batchwright.llm import queries, topk, vector_codes
from tests.conftest import SF

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, row string, block string, score string, code string, error string, vec string, place string"


def table(spark, rows):
    """``rows`` of (id, vector, label) beside columns named like the operators' own."""
    return spark.createDataFrame([(*r, *"abcdefg") for r in rows], SCHEMA).repartition(3)


def odd_rows(n=400, dim=32, seed=3):
    """Random vectors of which a third are one and the same, with ties, repeated ids, nulls and bad components."""
    rng = random.Random(seed)
    hot = [rng.gauss(0, 0.2) for _ in range(dim)]
    rows = [(i, list(hot) if i % 3 == 0 else [rng.gauss(0, 0.2) for _ in range(dim)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(50, rows[50][1], 1), (50, rows[7][1], 1), (None, rows[7][1], None), (100, [0.0] * dim, 3)]
    rows += [(150, None, 1), (200, [*hot[:-1], None], 1), (250, [*hot[:-1], NAN], 1), (300, [*hot[:-1], -INF], 1), (350, hot[: dim // 2], 1), (1000, [], 2)]
    return rows


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def integers(rows, width):
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r[1])] = [math.floor(256 * x) for x in r[1]]
    return out


def slow_top(rows, k=5):
    rows = usable(rows)
    x = integers(rows, max((len(r[1]) for r in rows), default=0))
    out = []
    for q, r in enumerate(rows):
        if r[0] is None or r[0] % 50:
            continue
        others = sorted((-int(x[q] @ x[i]), rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if i != q)
        out += [(r[0], n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(others[:k])]
    return sorted(out, key=str)


def found_top(df, **options):
    return sorted(map(tuple, topk.exact_top_k(df, lambda i: i % 50 == 0, **options).collect()), key=str)


@pytest.mark.parametrize("lists", [1, 2, 5])
def test_top_k_odd_rows(spark, lists):
    rows = odd_rows()
    assert found_top(table(spark, rows), lists=lists) == slow_top(rows)


def test_top_k_in_many_small_blocks(spark, monkeypatch):
    """More queries than a block holds, vectors in several blocks and chunks."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "LEAST_BLOCK", 40)
    rows = odd_rows(700, dim=6, seed=5)
    assert found_top(table(spark, rows), k=3) == slow_top(rows, 3)


def test_top_k_large_components(spark):
    """Beyond float32: exact in float64 and in integers; beyond 64 bits an error."""
    for size in (40.0, 3e5):
        rows = [(i, [size * x for x in v], 0) for i, v, _ in usable(odd_rows(120))]
        assert found_top(table(spark, rows)) == slow_top(rows)
    with pytest.raises(OverflowError):
        found_top(table(spark, [(0, [1e15], 0), (1, [1e15], 0)]))


def test_top_k_few_and_none(spark):
    assert found_top(table(spark, [])) == []
    assert found_top(table(spark, [(50, None, 1)])) == []
    assert found_top(table(spark, [(50, [1.0], 1)])) == []
    rows = [(50, [1.0, -1.0], 1), (50, [1.0, -1.0], 1), (3, [-2.0, 0.5], 1)]
    assert found_top(table(spark, rows)) == slow_top(rows)
    rows = [(i, [], 0) for i in range(60)]
    assert found_top(table(spark, rows)) == slow_top(rows)


def slow_codes(rows, parts, entries, rounds):
    rows = sorted(usable(rows), key=lambda r: (r[0] is None, r[0] or 0, [math.floor(256 * x) for x in r[1]]))
    width = max(1, -(-max((len(r[1]) for r in rows), default=0) // parts))
    x = integers(rows, parts * width).reshape(len(rows), parts, width)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        near, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[near[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    near, error = nearest()
    total = error.sum(1)
    sums = {}
    for r, e in zip(rows, total):
        sums[r[2]] = sums.get(r[2], 0) + int(e)
    return sorted(((r[0], "".join(f"{c:02x}" for c in near[i]), int(total[i]), r[2], sums[r[2]]) for i, r in enumerate(rows)), key=str), books


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 16, 2), (16, 64, 3), (5, 7, 1), (1, 256, 2)])
def test_codes_odd_rows(spark, parts, entries, rounds):
    rows = odd_rows(1500)
    coded, books = vector_codes.vector_codes(table(spark, rows), parts, entries, rounds)
    expected, slow_books = slow_codes(rows, parts, entries, rounds)
    assert (books == slow_books).all()
    assert sorted(map(tuple, coded.collect()), key=str) == expected


def test_codes_few_and_none(spark):
    coded, books = vector_codes.vector_codes(table(spark, []))
    assert coded.collect() == [] and books.size == 0
    rows = [(None, [0.5, 1.0], None), (3, [], None)]
    coded, books = vector_codes.vector_codes(table(spark, rows), parts=2)
    assert sorted(map(tuple, coded.collect()), key=str) == slow_codes(rows, 2, 64, 2)[0]


def test_codes_label_errors_with_light_and_heavy_labels(spark):
    rows = [(i, v, i if i % 2 else None) for i, (_, v, _) in enumerate(usable(odd_rows(600, dim=8)))]
    coded, _ = vector_codes.vector_codes(table(spark, rows), parts=4, entries=8)
    assert sorted(map(tuple, coded.collect()), key=str) == slow_codes(rows, 4, 8, 2)[0]


def test_shortlists_hold_the_nearest_entry():
    rng = np.random.default_rng(1)
    points, book = rng.integers(-300, 300, (5000, 4)), rng.integers(-300, 300, (64, 4))
    blocks = vector_codes.Blocks.of(points)
    listed = blocks.shortlists(book)
    near = ((blocks.points[:, None] - book[None]) ** 2).sum(-1).argmin(1)
    assert listed[np.repeat(np.arange(len(blocks.sizes)), blocks.sizes), near].all()
    assert listed.mean() < 0.75  # of 64 entries


def test_hilbert_neighbours_are_adjacent():
    """All cells of a grid in curve order: each differs from the next by one step."""
    for dims, side in ((2, 16), (3, 8), (4, 4)):
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims)
        keys = vector_codes.hilbert_keys(cells)
        assert len(set(keys.tolist())) == len(cells)
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
        assert (steps == 1).all()


@pytest.mark.parametrize("name", ["op11_exact_top_k", "op13_vector_codes"])
def test_against_sql(spark, name):
    out = queries.queries()[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    theirs = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(theirs)
    assert out.where(F.col(out.columns[0]).isNull()).count() == 0
