"""Exact dedup, SimHash near-dedup and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from batchwright.llm import exact_dedup, queries, simhash, substring
from batchwright.llm.common import components
from tests.conftest import SF
from tests.llm.conftest import ODD

MASK = (1 << 64) - 1


def normal(t):
    return re.sub("[ \t-\r]+", " ", t or "")


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        self[self.find(a)] = self.find(b)


def slow_fingerprint(text):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_exact_against_sql(spark):
    mine = sorted(map(tuple, queries.queries()["op8_exact_dedup"](spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert mine == sorted(con.execute(queries.oracle_sql()["op8_exact_dedup"]).fetchall())


def test_exact_heavy_and_light_agree(spark, documents):
    """Every split between broadcast winners and the shuffle gives the same rows."""
    columns = ["doc_id", "keep_id", "group_size", "keep_rows", "kept"]
    outs = [sorted(map(tuple, exact_dedup.exact_dedup(documents, counters=c, candidates=k).select(columns).collect())) for c, k in ((1024, 256), (8, 1), (2, 1))]
    assert outs[0] == outs[1] == outs[2]


def test_exact_odd_rows(odd, empty):
    groups = defaultdict(list)
    for i, t in ODD:
        groups[normal(t)].append(i)
    want = Counter()
    for ids in groups.values():
        keep = min((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep) for i in ids)
    got = exact_dedup.exact_dedup(odd).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert Counter(map(tuple, got)) == want
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], normal(r["text"])) for r in kept.collect()]
    assert Counter(t for _, t in rows) == Counter(list(groups))  # one of each text
    assert all(i == min((x for x in groups[t] if x is not None), default=None) for i, t in rows)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


def test_fingerprints(documents):
    for (t,) in documents.select("text").limit(60).collect():
        assert simhash.fingerprint(t) & MASK == slow_fingerprint(t)
    for t in ("", None, "One", "One two", "One two three", "One two three four", "É É É É"):
        assert simhash.fingerprint(t) & MASK == slow_fingerprint(t)


def brute_components(prints):
    u, fps = Union(), sorted({p for _, p in prints})
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                u.join(a, b)
    least = {}
    for i, p in prints:
        r = u.find(p)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return {(i, p): least[u.find(p)] for i, p in prints}


def test_simhash_against_all_pairs(documents):
    got = simhash.simhash_dedup(documents).collect()
    want = brute_components([(r["doc_id"], r["fp"] & MASK) for r in got])
    assert {(r["doc_id"], r["fp"] & MASK): r["component_id"] for r in got} == want


@pytest.mark.parametrize("bucket", [0, 4, 10_000])
def test_links_in_a_cloud(spark, bucket):
    """Every pair within three bits is found, whether buckets are split or not."""
    rng = random.Random(5)
    fps = {0, MASK}
    for _ in range(6):
        centre, loose = rng.getrandbits(64), rng.sample(range(64), 9)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in loose if rng.random() < 0.4))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=bucket).collect()
    found = {frozenset((r["a"] & MASK, r["b"] & MASK)) for r in got}
    assert found == {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    least = {}
    for x in list(u):
        least[u.find(x)] = min(x, least.get(u.find(x), x))
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: least[u.find(x)] for x in list(u) if any(x in e and e[0] != e[1] for e in edges)}


def test_simhash_odd_rows(odd, empty):
    got = simhash.simhash_dedup(odd).collect()
    assert len(got) == len(ODD)
    assert Counter((r["doc_id"], r["fp"] & MASK) for r in got) == Counter((i, slow_fingerprint(t)) for i, t in ODD)
    want = brute_components([(r["doc_id"], r["fp"] & MASK) for r in got])
    assert all(r["component_id"] == want[r["doc_id"], r["fp"] & MASK] for r in got)
    kept = simhash.keep_one_each(odd)
    assert kept.columns == odd.columns
    root = {r["fp"] & MASK: r["root"] for r in got}
    assert Counter(root[slow_fingerprint(r["text"])] for r in kept.collect()) == Counter(set(root.values()))
    assert simhash.simhash_dedup(empty).count() == 0 and simhash.keep_one_each(empty).count() == 0


# ---------------------------------------------------------------- substring
def words(rng, n):
    return ["".join(rng.choices("abcdefghijkl", k=rng.randint(3, 7))) for _ in range(n)]


def test_planted_passages(spark):
    """Exact, edited and hot passages are found where they lie; clean texts are left alone."""
    rng = random.Random(11)
    passage = words(rng, 70)
    edited = [w if i % 17 else "changed" for i, w in enumerate(passage)]
    hot = words(rng, 55)
    short = words(rng, 40)
    texts, where = {}, {}
    for d in range(60):
        before, after = words(rng, rng.randint(0, 80)), words(rng, rng.randint(0, 80))
        middle = passage if d in (1, 2) else edited if d == 3 else hot if 10 <= d < 50 else short if d in (50, 51) else []
        texts[d] = " ".join(before + middle + after)
        if middle and middle is not short:
            start = len(" ".join(before)) + bool(before)
            where[d] = (start, start + len(" ".join(middle)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = substring.substring_dedup(df).collect()
    assert {r["doc_id"] for r in got} == set(where)
    for r in got:
        start, end = where[r["doc_id"]]
        # the edited copy differs in its first word and in the last but one, so its edges may stay outside
        assert abs(r["start"] - start) <= 20 and abs(r["end"] - end) <= 20
        same = (1, 2, 3) if r["doc_id"] < 10 else range(10, 50)
        assert r["partner_id"] in same and r["partner_id"] != r["doc_id"]
        assert r["identity"] >= 0.8


def test_every_long_common_run_is_found(spark, documents):
    """Brute force: a document that shares 50 words in a row with another one has a passage."""
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    runs = defaultdict(set)
    for i, t in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        for k in range(len(w) - 49):
            runs[hashlib.md5(b" ".join(w[k : k + 50])).digest()].add(i)
    want = {i for ids in runs.values() if len(ids) > 1 for i in ids}
    got = {r["doc_id"] for r in substring.substring_dedup(documents).collect()}
    assert want <= got


def test_runs_that_no_representative_of_a_seed_holds(spark):
    """Two texts share 60 words; the first and the last rows of each seed hold 35 of them."""
    rng = random.Random(4)
    run = words(rng, 60)
    middles = [run[:35], run[25:], run, run, run[:35], run[25:]]
    texts = [(d, " ".join(words(rng, 30) + m + words(rng, 30))) for d, m in enumerate(middles)]
    got = substring.substring_dedup(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    assert {r["doc_id"]: (r["partner_id"], r["n_words"], r["identity"]) for r in got} == {2: (3, 60, 1.0), 3: (2, 60, 1.0)}
    for r in got:
        assert texts[r["doc_id"]][1][r["start"] : r["end"]] == " ".join(run)


@pytest.mark.parametrize("n", [2, 40])
def test_pieces_that_different_representatives_hold(spark, n):
    """Two texts share a passage of two runs; ``n`` texts before and after them hold the one or the other only."""
    rng = random.Random(5)
    one, two = words(rng, 30), words(rng, 30)
    middles = [one, two] * n + [one + [w] + two for w in ("left", "right")] + [one, two] * n
    texts = [(d, " ".join(words(rng, 30) + m + words(rng, 30))) for d, m in enumerate(middles)]
    got = substring.substring_dedup(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    assert {r["doc_id"]: (r["partner_id"], r["n_words"], r["n_partners"]) for r in got} == {2 * n: (2 * n + 1, 61, 1), 2 * n + 1: (2 * n, 61, 1)}


def test_pieces_that_many_texts_hold_by_twos(spark):
    """Two texts share three runs; any two of the runs are held by many others, before and after them."""
    rng = random.Random(6)
    a, b, c = (words(rng, 20) for _ in range(3))
    other = lambda: [a + ["x"] + b, b + ["y"] + c, a + words(rng, 22) + c]
    middles = [m for _ in range(20) for m in other()] + [a + [v] + b + [w] + c for v, w in ("lr", "pq")] + [m for _ in range(20) for m in other()]
    texts = [(d, " ".join(words(rng, 30) + m + words(rng, 30))) for d, m in enumerate(middles)]
    got = substring.substring_dedup(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    assert {r["doc_id"]: (r["partner_id"], r["n_words"], r["n_partners"]) for r in got} == {60: (61, 62, 1), 61: (60, 62, 1)}


def test_passages_of_long_words_are_whole(spark):
    """The text that an alignment sees is bounded in words, not in characters."""
    rng = random.Random(8)
    long = lambda n: ["".join(rng.choices("abcdefghijkl", k=90)) for _ in range(n)]
    texts, where = [], {}
    for d in range(0, 20, 2):
        run = long(52)
        for i in (d, d + 1):
            before = long(rng.randint(5, 40))
            texts.append((i, " ".join(before + run + long(30))))
            where[i] = (len(" ".join(before)) + 1, len(" ".join(before + run)))
    got = substring.substring_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["start"], r["end"]) for r in got} == where


def test_least_in_windows():
    h = np.random.default_rng(1).integers(0, 9, 300).astype(np.uint64)
    for window in (1, 2, 5, 20, 43):
        views = np.lib.stride_tricks.sliding_window_view(h, window)
        assert (substring.least_in(h, window) == views.argmin(axis=1) + np.arange(len(views))).all()


def test_equal_runs_outside_the_best_chain(spark):
    """A run that the alignment of its chain cuts off is a passage too."""
    rng = random.Random(6)
    first, second = words(rng, 50), words(rng, 50)
    texts = [(d, " ".join(words(rng, 40) + first + words(rng, 32) + second + words(rng, 40))) for d in range(2)]
    got = substring.substring_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    for d, t in texts:
        spans = [(r["start"], r["end"]) for r in got if r["doc_id"] == d]
        for part in (first, second):
            at = t.index(" ".join(part))
            assert any(a <= at and at + len(" ".join(part)) <= b for a, b in spans)


def test_framed_blocks_are_difflibs():
    rng = random.Random(9)
    framed = 0
    for _ in range(5000):
        letters = [bytes([65 + i]) for i in range(rng.choice([2, 4, 12, 60]))]
        front, back = (rng.choices(letters, k=rng.randint(0, 6)) for _ in range(2))
        middle = lambda: rng.choices([b"%d" % rng.randint(0, 9), letters[0]], k=rng.randint(0, 3))
        a, b = front + middle() + back, front + middle() + back
        if a != b and (got := substring.framed(a, b)):
            framed += 1
            p, s = got
            want = [(m.a, m.b, m.size) for m in SequenceMatcher(None, a, b, False).get_matching_blocks() if m.size]
            assert want == [m for m in ((0, 0, p), (len(a) - s, len(b) - s, s)) if m[2]]
    assert framed > 1000


def test_blocks_are_difflibs():
    rng = random.Random(8)
    for n in range(3000):
        kinds = rng.choice([1, 2, 4, 30])
        one, two = ([rng.randrange(kinds) for _ in range(rng.randrange(25))] for _ in "ab")
        if n % 2:
            two = [w for w in one if rng.random() < 0.9]
        m = SequenceMatcher(None, one, two, False)
        assert substring.matching_blocks(one, two) == [tuple(b) for b in m.get_matching_blocks() if b.size]
        assert substring.longest(substring.equal_diagonals(one, two)) == tuple(m.find_longest_match())


def test_left_occurrences_meet_once(spark):
    """However many keys two occurrences share they meet once; a key in a passage found brings nobody."""
    keys = [(r, 5, 7, h, 20, 10 * h, 10 * h + 9, 0, 900) for r in range(6) for h in range(30)]
    keys += [(r, 5, 8, 50, 20, 10, 19, 0, 900) for r in (7, 8)] + [(9, 5, 7, 99, 20, 10, 19, 0, 900)]
    wide = spark.createDataFrame(keys, "row long, pos int, seed long, h long, at int, start int, end int, begin int, stop int")
    found = spark.createDataFrame([(r, 0, 0, 300, 60, 1.0) for r in (1, 2, 3, 4, 5, 7, 8)], "first long, partner long, start long, stop long, n_words int, identity double")
    met = [(r.x.row, r.y.row) for r in substring.left_meetings(wide, found).collect()]
    assert sorted(met) == [(0, r) for r in range(1, 6)]
    pairs = substring.left_pairs(wide, found).collect()
    assert sorted((r.a, r.b, len(r.matches)) for r in pairs) == [(0, r, 1) for r in range(1, 6)]


def test_overlapping_passages_of_a_pair_leave_as_one():
    """Two alignments that overlap on both sides of a pair make one row a side."""
    rng = random.Random(10)
    run = words(rng, 120)
    text = " ".join(run)
    chain = lambda a: dict(a0=a, b0=a, begin_a=0, stop_a=len(text), begin_b=0, stop_b=len(text), pa=np.array([0]), pb=np.array([0]))
    changed = " ".join([*run[:60], "other", "words", *run[62:]])
    align = substring.align_udf(8, 50, 0.8, 320).func
    (rows,) = align(pd.Series([text]), pd.Series([0]), pd.Series([changed]), pd.Series([0]), pd.Series([np.array([chain(5), chain(100)], object)]))
    assert [r[:4] for r in rows] == [(0, 0, len(text), 120), (1, 0, len(changed), 120)]
    assert substring.merged([(5, 9, 2, 0.8), (0, 6, 3, 0.9), (9, 12, 1, 1.0)]) == [(0, 9, 3, 0.9), (9, 12, 1, 1.0)]


def test_only_texts_of_shared_seeds_are_passed_on(spark):
    base = spark.createDataFrame([(i, f"text {i // 2}", bytes([i // 2])) for i in range(8)], "doc_id long, text string, own binary")
    member = spark.createDataFrame([(i, bytes([i // 2]), i // 2 * 2) for i in range(8)], "row long, digest binary, least_id long")
    each = spark.createDataFrame([(7, 2), (8, 2), (7, 4)], "h long, row long")
    assert sorted(r["doc_id"] for r in substring.texts_of(each, member, base).collect()) == [2, 4]


def test_substring_odd_rows(odd, empty):
    got = substring.substring_dedup(odd, least=50).collect()
    assert not [r for r in got if r["doc_id"] in (1, 2, 3, 4, 9, 10)]
    assert substring.substring_dedup(empty).count() == 0
    twice = substring.substring_dedup(odd.union(odd)).where("doc_id = 8").collect()
    assert [(r["start"], r["partner_id"], r["n_partners"]) for r in twice] == [(0, 8, 1)] * 2


def link_score(p, q):
    ga, gb = q[0] - p[0], q[1] - p[1]
    return min(8, ga, gb) - substring.SKEW_COST * abs(ga - gb) - substring.GAP_COST * min(ga, gb)


@pytest.mark.parametrize("matches, span", [(25, 60), (25, 300), (120, 90), (300, 600), (300, 80)])
def test_chains_against_quadratic(matches, span):
    """The best chain scores what comparing every match with every other gives, gaps
    beyond the limit and predecessors out of order included."""
    rng = random.Random(matches + span)
    for _ in range(40 if matches < 100 else 8):
        anchors = sorted({(rng.randint(0, span), rng.randint(0, span)) for _ in range(rng.randint(1, matches))})
        best = {}
        for q in anchors:
            linked = [s + link_score(p, q) for p, s in best.items() if p[0] < q[0] and p[1] < q[1] and min(q[0] - p[0], q[1] - p[1]) <= substring.GAP]
            best[q] = max([8.0, *linked])
        found = substring.chains(anchors)
        points = [anchors[i] for i in found[0]]
        assert all(p[0] < q[0] and p[1] < q[1] and min(q[0] - p[0], q[1] - p[1]) <= substring.GAP for p, q in zip(points, points[1:]))
        assert 8 + sum(map(link_score, points, points[1:])) == pytest.approx(max(best.values()), abs=1e-9)
        assert sorted(i for c in found for i in c) == list(range(len(anchors)))


def test_chain_of_a_plain_run():
    run = [(i * 5, 100 + i * 5) for i in range(30)]
    assert substring.chains(run + [(3, 400), (300, 2)])[0] == list(range(30))
