"""Language-model scores, toxicity and url filters."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchwright.llm import lm, queries, toxicity, urls
from tests.conftest import SF
from tests.llm.conftest import ODD


# ----------------------------------------------------------------------- lm
def tokens(t):
    return [*re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""]


def out(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def slow_base(source):
    c = Counter(w for i, t in source if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for i, t in source:
        w = tokens(t)
        yield i, out(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)


@pytest.mark.parametrize("head", [64, 4096])
def test_base_scores(documents, head):
    source = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows = lm.lm_scores(documents, classes=50, dim=4, head=head).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(source)
    for i, held, n, known, total, base in slow_base(source):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)


def test_lm_odd_rows(odd, empty):
    rows = lm.lm_scores(odd, classes=20, dim=4, head=64).collect()
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6))
    got = sorted(key((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])) for r in rows)
    assert got == sorted(map(key, slow_base(ODD)))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm.lm_scores(empty).count() == 0


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    matrix = lm.Params.start(np.full(30, 1 / 30), 4)
    matrix += rng.normal(0, 0.5, matrix.shape)
    a, b, z = lm.tables(matrix, 4)
    for w1, w2 in ((0, 0), (3, 7), (29, 1)):
        assert (10 ** (a[w1].astype(float) + b[w2] - z[w1, w2])).sum() == pytest.approx(1, abs=1e-4)


def words_of(n, classes):
    known = lm.Words([f"w{i}".encode() for i in range(n)], [10_000 // (i + 1) for i in range(n)], 500, classes)
    left = [0, 0, 1] if known.hashed > 1 else [0, 0, 0]
    known.beyond(sorted(set(left)), [left.count(x) * 7 for x in sorted(set(left))], [left.count(x) for x in sorted(set(left))])
    return known


@pytest.mark.parametrize("n, classes", [(3, 5), (200, 40), (2000, 40), (30, 3)])
def test_each_word_has_a_class_and_a_share(n, classes):
    """The shares of a class's words, with one unseen word in each hashed class, add up to
    one; more frequent words share with fewer; the classes are as many as asked for at most."""
    known = words_of(n, classes)
    assert known.size <= classes and len(known.of) == n + 1 and (np.diff(known.of) >= 0).all()
    totals = np.bincount(known.of, 10 ** known.shares, known.size)
    rest = 10**-known.divisors * (known.mass[known.rest :] + 0.1 * (np.round((10**known.divisors - known.mass[known.rest :]) / 0.1)))
    assert np.concatenate([totals[: known.rest], rest]) == pytest.approx(1)
    assert known.unigram().sum() == pytest.approx(1) and known.mass.sum() == pytest.approx(known.counts.sum() + 21)
    sizes = np.bincount(known.of)[known.leading + 1 :]
    if len(sizes) > 2:
        assert sizes[0] < sizes[-1]


def test_scores_against_plain_sums(documents):
    """Each token's probability taken by itself: softmax over the classes, then the share of the word."""
    known = words_of(200, 40)
    rng = np.random.default_rng(3)
    matrix = lm.Params.start(known.unigram(), 4) + rng.normal(0, 0.3, (known.size + 1, 9))
    p = lm.Params(matrix, 4)
    texts = ["w0 w3 W199 unseen w0", "", "other words only", "w5 " * 30]
    for text, got in zip(texts, lm.score_texts(texts, known, matrix, 4)):
        total, rare, before = 0.0, Counter(), [0, 0]
        for word in tokens(text):
            at = known.index.get(word.encode())
            cls = known.of[at] if at is not None else known.rest + zlib.crc32(word.encode()) % known.hashed
            logits = (p.c[0] * p.r[before[1]] + p.c[1] * p.r[before[0]]) @ p.q.T + p.b
            total += (logits[cls] - np.log(np.exp(logits).sum())) / np.log(10)
            total += known.shares[at] if at is not None else -known.divisors[cls - known.rest]
            rare[word] += at is None
            before = [before[1], cls]
        assert got[3] == pytest.approx(total, abs=1e-3)
        assert dict(got[4]) == {w: n for w, n in rare.items() if n}


def test_training_learns_a_pattern():
    """On a sequence where each word fixes the next one the model beats its own unigram."""
    known = lm.Words([b"a", b"b", b"c"], [300, 300, 300], 100, 5)
    texts = ["a b c " * 30] * 400
    p = np.array([400, 12000, 12000, 12000, 0.1])
    p /= p.sum()
    start = lm.Params.start(p, 8)
    matrix, seen = lm.train_batches(lm.contexts(texts, known), start, p, 8, 1)
    assert seen == 400 * 91
    before, after = (next(lm.score_texts(["a b c a b c"], known, m, 8))[3] for m in (start, matrix))
    assert after > before + 1


def test_scores_do_not_depend_on_the_file_layout(documents):
    one, many = ({r["doc_id"]: r["score"] for r in lm.lm_scores(documents.repartition(n), classes=64, dim=4).collect()} for n in (1, 24))
    assert one == pytest.approx(many, abs=1e-6) and len(one) == documents.count()


def test_scores_beat_base_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.lm_scores(docs, classes=512).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


# ----------------------------------------------------------------- toxicity
def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").dropDuplicates(["doc_id"])
    rows = queries.queries()["op4_toxicity"](spark, sf).cache()
    assert rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    got = rows.join(labels, "doc_id").where("held_out").select("toxic", "score", "predicted").toPandas()
    assert got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5) == got["predicted"]).all()
    toxic = got["toxic"] == 1
    assert got[toxic]["predicted"].mean() > 0.5
    assert got[~toxic]["predicted"].mean() < 0.03


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, int(i == 11)) for i in range(1, 12)] + [(None, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, labels).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in ODD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    clean = toxicity.toxicity(odd, labels.withColumn("toxic", F.lit(0))).collect()
    assert {r["score"] for r in clean} == {0.0}
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == len(ODD)


def test_risk_is_corrected():
    """Trained from positives and a mixture only, the score separates the hidden classes."""
    rng = np.random.default_rng(1)
    draw = lambda toxic, n: (rng.random((n, 20)) < (np.where(np.arange(20) < 5, 0.6, 0.3) if toxic else np.where(np.arange(20) < 5, 0.02, 0.3))).astype(np.uint8)
    bits = lambda x: np.packbits(x, axis=1)
    w, b = toxicity.train(bits(draw(True, 400)), bits(np.concatenate([draw(True, 300), draw(False, 2700)])), 20, 0.1)
    assert ((draw(True, 500) @ w + b) > 0).mean() > 0.75
    assert ((draw(False, 500) @ w + b) > 0).mean() < 0.05


# --------------------------------------------------------------------- urls
def slow_judge(url):
    m = re.search("://", url or "")
    rest = url[m.end() :] if m else ""
    raw = re.match("[^/?#]*", rest)[0]
    host, path = re.sub("[A-Z]", lambda x: x[0].lower(), raw), re.match("[^?#]*", rest[len(raw) :])[0]
    fit = [(h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit, key=lambda x: len(x[0])) if fit else (None, None))


def test_url_rules(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    more = [(900001, None, None), (900002, "no scheme", "<a href=x>"), (900003, "HTTP://A.Example.NET/en/x?q#f", ""), (900004, "http://net", ""), (900005, "x://org/fr/", None), (900005, "x://org/fr/", None), (900006, "a://b://example.com/de/", "")]
    pages = pages.select("page_id", "url", "html").unionByName(spark.createDataFrame(more, "page_id long, url string, html string")).withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    rows = urls.url_filter(pages, queries.URL_RULES).collect()
    assert len(rows) == pages.count()
    source = defaultdict(list)
    for r in pages.collect():
        source[r["page_id"]].append(r["url"])
    for r in rows:
        host, path, rule, says = slow_judge(source[r["page_id"]][0])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (says or r["verdict"]) and r["verdict"] in ("allow", "block")
        if not host:
            assert r["verdict"] == "allow"
    assert urls.url_filter(pages.limit(0), queries.URL_RULES).count() == 0


def slow_walk(edges, seeds, damping):
    hosts = sorted({x for e in edges for x in e[:2]} | set(seeds))
    total = defaultdict(float)
    for a, _, n in edges:
        total[a] += n
    rank = dict.fromkeys(hosts, 0.0) | seeds
    for _ in range(300):
        new, sent = defaultdict(float), 0.0
        for a, b, n in edges:
            new[b] += damping * rank[a] * n / total[a]
            sent += damping * rank[a] * n / total[a]
        rank = {h: new[h] + (1 - sent) * seeds.get(h, 0.0) for h in hosts}
    return rank


def test_walks_against_power_iteration(spark):
    rng = np.random.default_rng(9)
    edges = [(f"h{a}", f"h{b}", int(n)) for a, b, n in {(int(a), int(b), 1 + int(a + b) % 3) for a, b in rng.integers(0, 25, (60, 2))} if a != b]
    seeds = {"h1": 0.5, "h2": 0.25, "lonely": 0.25}
    frame = spark.createDataFrame([("trust", *e) for e in edges], "walk string, src string, dst string, n long")
    ranks = urls.walks(frame, spark.createDataFrame([("trust", h, m) for h, m in seeds.items()], "walk string, host string, mass double"), tolerance=1e-4)
    got = {r["host"]: r["rank"] for r in ranks.collect()}
    for h, x in slow_walk(edges, seeds, urls.DAMPING).items():
        assert got.get(h, 0.0) == pytest.approx(x, abs=1e-3)


def test_links_spread_distrust(spark):
    """A host without a rule that links only to blocked ones is blocked; who is linked from trusted ones is not."""
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">x</a>' for h in hosts)
    rows = [(1, "http://bad.net/a", ""), (2, "http://farm.com/a", link("bad.net", "bad.net", "Bad.NET")), (3, "http://good.org/fr/a", link("friend.com")), (4, "http://friend.com/a", ""), (5, "http://far.com/", "")]
    got = {r["page_id"]: r for r in urls.url_filter(spark.createDataFrame(rows, "page_id long, url string, html string"), queries.URL_RULES).collect()}
    assert {i: r["verdict"] for i, r in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}
    assert got[2]["distrust"] > 0 and got[4]["trust"] > 0


def test_toxicity_sample_is_bounded_by_rows(spark):
    """One toxic id with 50,000 equal rows, one with 20,000 texts, and a repeated clean row."""
    same = spark.range(50_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("you fool").alias("text"))
    many = spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("you fool "), "id").alias("text"))
    clean = spark.range(50_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("good day").alias("text"))
    docs = same.unionByName(many).unionByName(clean)
    labels = spark.createDataFrame([(1, 1), (3, 1), (7, 0)], "doc_id long, toxic int")
    rows, prior = toxicity.sample(docs, labels, positives=300, unlabelled=300, folds=5)
    counted = {r["p"]: r["count"] for r in rows.groupBy("p").count().collect()}
    assert 0 < counted[True] < 900 and counted.get(False, 0) < 900 and prior == 2 / 3
