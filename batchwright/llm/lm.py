"""Language-model scoring: a base unigram and a log-bilinear neural model.

Base: add-0.1 unigram over the words of the training documents and one end token
a document.

Model: log-bilinear over ``classes`` classes, in two steps.  The end token and the
most frequent training words have a class each.  The other words of the ``head`` are
cut, by falling count, into classes of about equal mass, so the more frequent a word,
the fewer share its class; words beyond the head, unseen ones too, share classes by
their CRC-32.  So every word has learnt vectors, as a target and as context.  The score
of a class after two previous ones is ``(c1*r1 + c2*r2) . q + b``; a word takes its
class's probability times its add-0.1 unigram share in the class (an unseen word is one
more word of its class).  Training is noise-contrastive estimation in numpy, one pass
over the training documents in ``ROUNDS`` rounds: in each, learners run over documents
dealt by a hash of id and text from common starting values, and their results are
averaged, weighted by tokens, to start the next one.  What a learner sees follows from
the documents alone, not from the files they lie in.  Because the score adds up over the two context
positions, one product of two ``classes x classes`` matrices gives the normaliser of
every context, so token log-probabilities are exactly normalised.

Scale: counts of training words are aggregated map-side and grow with the corpus.
The ``head`` most frequent words' counts (a fixed number) go to the tasks; words
beyond, which are rare by definition, are joined by word in a shuffle and summed
per row.  Of those, and of the model, only sums by class are gathered; the number of
classes is fixed, so a class holds more words as the vocabulary grows.

Defined results: null and empty texts are the end token alone; without a training
document the base is the uniform value of its formula and the model knows only its
starting values; an empty table gives no rows; repeated rows score alike (each row
is scored by itself, whatever its id); columns other than id and text are not
read.  Null ids are held out.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import doc_columns, row_type, staged

CLASSES = 2048
DIM = 16
HEAD = 1 << 17
FOLDS = 10
#: Words counted in a task before they are passed on.
FLUSH = 1_000_000
BATCH = 4096
NOISE = 32
#: Rounds of training, each on a part of the documents from the averaged values of the last.
ROUNDS = 4
#: Tokens that a learner sees in a round, on average, and the most learners (beyond, each sees more).
SHARE = 1_000_000
LEARNERS = 8192
RATE = 0.05
END = 0
END_WORD = ""  # no word is empty

COUNTS = row_type("word string, c long")
PARAMS = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("tokens", T.DoubleType()), T.StructField("v", T.ArrayType(T.FloatType()))])
SUMS = T.StructType([*PARAMS.fields[:2], T.StructField("v", T.ArrayType(T.DoubleType()))])

_TABLES: dict[bytes, tuple] = {}


def lower_words(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def count_words(batches):
    seen: Counter = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            seen.update(lower_words(text))
            seen[b""] += 1
            if len(seen) > FLUSH:
                yield _counted(seen)
                seen = Counter()
    if seen:
        yield _counted(seen)


def _counted(seen: Counter) -> pd.DataFrame:
    return pd.DataFrame({"word": [w.decode("utf-8") for w in seen], "c": list(seen.values())})


def most_frequent(vocab: DataFrame, head: int) -> tuple[pd.DataFrame, DataFrame]:
    """At most ``head`` words, none less frequent than one left out, the most frequent first; and
    all those left out.

    The least count that fits is read off a histogram of at most a thousand steps
    of counts, so nothing is sorted and no more than the result reaches the driver."""
    step = F.floor(16 * F.log2(F.col("c").cast("double")))
    sizes = vocab.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    least, taken = None, 0
    for s in sizes:
        taken += s["n"]
        if taken > head:
            break
        least = s["step"]
    taken = step >= least if least is not None else F.lit(False)
    top = vocab.where(taken).toPandas()
    return top.sort_values(["c", "word"], ascending=[False, True]), vocab.where(~taken)


class Params:
    """Rows: one for each class (r, q, b), and a last one with the context weights c1, c2."""

    def __init__(self, matrix: np.ndarray, dim: int):
        self.r, self.q, self.b = matrix[:-1, :dim], matrix[:-1, dim : 2 * dim], matrix[:-1, 2 * dim]
        self.c = matrix[-1, : 2 * dim].reshape(2, dim)

    @staticmethod
    def start(unigram: np.ndarray, dim: int, seed: int = 7) -> np.ndarray:
        rng = np.random.default_rng(seed)
        matrix = rng.normal(0, 0.1, (len(unigram) + 1, 2 * dim + 1))
        matrix[:-1, 2 * dim] = np.log(unigram)
        matrix[-1] = 1.0
        return matrix


class Words:
    """The most frequent words: an index for each, the end token first, and counts; and
    the class of every word.

    Class 0 is the end token's, the next ones belong to the first ``leading`` words; then
    come classes of about equal mass of the other words here, and last, from ``rest`` on,
    ``hashed`` classes of the words that are not here."""

    def __init__(self, words: list[bytes], counts: list[int], end: int, classes: int):
        self.index = {b"": 0} | {w: i + 1 for i, w in enumerate(words)}
        self.counts = np.array([end, *counts], np.float64)
        self.hashed = max(1, classes // 8)
        room = classes - 1 - self.hashed
        self.leading = len(words) if len(words) <= room else room * 4 // 7
        self.of = np.arange(len(words) + 1)
        shared = self.counts[self.leading + 1 :] + 0.1
        if len(shared):
            before = (np.cumsum(shared) - shared) / shared.sum()
            _, at = np.unique((before * (room - self.leading)).astype(np.int64), return_inverse=True)
            self.of[self.leading + 1 :] = self.leading + 1 + at
        self.rest = int(self.of.max()) + 1
        self.size = self.rest + self.hashed
        self.beyond([], [], [])

    def beyond(self, which: list[int], counts: list[int], words: list[int]) -> None:
        """Takes the sum of counts and the number of training words of each of the hashed classes."""
        mass, n = np.bincount(self.of, self.counts, self.size), np.bincount(self.of, minlength=self.size) * 1.0
        at = self.rest + np.asarray(which, np.int64)
        mass[at], n[at] = counts, words
        n[self.rest :] += 1  # any unseen word
        self.mass, divisor = mass, np.log10(mass + 0.1 * n)
        self.shares = np.log10(self.counts + 0.1) - divisor[self.of]
        self.divisors = divisor[self.rest :]

    def unigram(self) -> np.ndarray:
        weight = self.mass + 0.1
        return weight / weight.sum()

    def find(self, words: list[bytes]) -> np.ndarray:
        """Index of each word (not here: -1 less its hashed class), then that of the end token."""
        get, out = self.index.get, np.zeros(len(words) + 1, np.int64)
        if words:
            out[:-1] = [get(w, -1) for w in words]
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = -1 - zlib.crc32(words[i]) % self.hashed
        return out

    def classes(self, at: np.ndarray) -> np.ndarray:
        """Two end tokens, then the class of each index."""
        out = np.full(len(at) + 2, END, np.int64)
        out[2:] = np.where(at >= 0, self.of[np.maximum(at, 0)], self.rest - 1 - at)
        return out


def _add(target: np.ndarray, cache: np.ndarray, at: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """Adagrad step on the rows ``at`` (repeats added up first)."""
    order = np.argsort(at, kind="stable")
    rows, first = np.unique(at[order], return_index=True)
    g = np.add.reduceat(grad[order], first, axis=0)
    cache[rows] += g * g
    target[rows] -= rate * g / np.sqrt(cache[rows])


def train_batches(streams, matrix: np.ndarray, unigram: np.ndarray, dim: int, seed: int) -> tuple[np.ndarray, int]:
    """One pass of noise-contrastive estimation over arrays of (w2, w1, w)."""
    p = Params(matrix.copy().astype(np.float64), dim)
    r, q, b, c = (np.ascontiguousarray(x, np.float32) for x in (p.r, p.q, p.b, p.c))
    b = b[:, None]
    caches = [np.full_like(x, 1.0) for x in (r, q, b, c)]
    rng, log_noise = np.random.default_rng(seed), np.log(NOISE * unigram).astype(np.float32)
    cdf = np.cumsum(unigram)
    seen = 0
    for w2, w1, w in streams:
        n = len(w)
        seen += n
        noise = np.minimum(np.searchsorted(cdf, rng.random(NOISE) * cdf[-1]), len(cdf) - 1)
        r1, r2, qw, qn = r[w1], r[w2], q[w], q[noise]
        h = r1 * c[0] + r2 * c[1]
        good = np.einsum("ij,ij->i", h, qw) + b[w, 0] - log_noise[w]
        bad = h @ qn.T + (b[noise, 0] - log_noise[noise])
        g = -1 / (1 + np.exp(np.clip(good, -30, 30)))  # d/dscore of -log sigmoid
        e = 1 / (1 + np.exp(-np.clip(bad, -30, 30)))
        dh = g[:, None] * qw + e @ qn
        _add(q, caches[1], np.concatenate([w, noise]), np.concatenate([g[:, None] * h, e.T @ h]), RATE)
        _add(b, caches[2], np.concatenate([w, noise]), np.concatenate([g, e.sum(0)])[:, None], RATE)
        _add(r, caches[0], np.concatenate([w1, w2]), np.concatenate([dh * c[0], dh * c[1]]), RATE)
        dc = np.stack([(dh * r1).sum(0), (dh * r2).sum(0)])
        caches[3] += dc * dc
        c -= RATE * dc / np.sqrt(caches[3])
    out = np.ones_like(matrix)
    out[:-1] = np.concatenate([r, q, b], axis=1)
    out[-1, : 2 * dim] = c.ravel()
    return out, seen


def contexts(texts, known: Words, batch: int = BATCH):
    """Batches of (w2, w1, w) over whole texts."""
    held, n = [], 0
    for text in texts:
        x = known.classes(known.find(lower_words(text)))
        held.append((x[:-2], x[1:-1], x[2:]))
        n += len(x) - 2
        if n >= batch:
            joined = [np.concatenate(part) for part in zip(*held)]
            cut = n - n % batch
            for k in range(0, cut, batch):
                yield tuple(j[k : k + batch] for j in joined)
            held, n = [tuple(j[cut:] for j in joined)], n - cut
    if n:
        yield tuple(np.concatenate(part) for part in zip(*held))


def add_up(batches):
    """Each row's steps times tokens, and tokens, summed; no more is held than the model's size."""
    sums: dict[int, np.ndarray] = {}
    for pdf in batches:
        if pdf.empty:
            continue
        weight = pdf["tokens"].to_numpy()[:, None]
        rows, at = np.unique(pdf["row"].to_numpy(), return_inverse=True)
        v = np.hstack([np.stack(pdf["v"].to_numpy()).astype(np.float64) * weight, weight])
        added = np.zeros((len(rows), v.shape[1]))
        np.add.at(added, at, v)
        for row, x in zip(rows.tolist(), added):
            sums[row] = sums[row] + x if row in sums else x
    if sums:
        yield pd.DataFrame({"row": list(sums), "tokens": [x[-1] for x in sums.values()], "v": [x[:-1] for x in sums.values()]})


def train(docs: DataFrame, known: Words, unigram: np.ndarray, tokens: int, dim: int = DIM, rounds: int = ROUNDS, share: int = SHARE) -> np.ndarray:
    """Parameters after one pass over ``docs`` (``doc_id, text``), a part of them in each round.

    A learner tells the steps of the rows that it moved; their mean over all tokens is
    the step of the round."""
    out, h = Params.start(unigram, dim), F.xxhash64("doc_id", "text")
    learners = min(max(1, -(-tokens // (rounds * share))), LEARNERS)
    for n in range(rounds):

        def run(batches, start=out, seed=11 + n):
            texts = (t for pdf in batches for t in pdf["text"])
            matrix, seen = train_batches(contexts(texts, known), start, unigram, dim, seed)
            if seen:
                steps = (matrix - start).astype(np.float32)
                steps[-1, 2 * dim] = 1  # a place without a parameter: this row comes from every learner
                moved = np.flatnonzero(steps.any(1))
                yield pd.DataFrame({"row": moved.astype(np.int32), "tokens": float(seen), "v": list(steps[moved])})

        part = docs.select("text", h.alias("h")).where(F.pmod("h", F.lit(rounds)) == n)
        told = part.repartition(learners, "h").sortWithinPartitions("h").select("text").mapInPandas(run, PARAMS)
        got = told.repartition("row").mapInPandas(add_up, SUMS).toPandas()  # a row a class
        if not got.empty:
            steps = np.zeros_like(out)
            steps[got["row"]] = np.stack(got["v"]) / got["tokens"].max()  # the tokens of all learners
            steps[-1, 2 * dim] = 0
            out = out + steps
    return out


def tables(matrix: np.ndarray, dim: int = DIM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``A, B, Z``: log10 P(w | w2, w1) = A[w1, w] + B[w2, w] - Z[w1, w2]."""
    p = Params(matrix, dim)
    a = ((p.r * p.c[0]) @ p.q.T + p.b).astype(np.float32)
    b = ((p.r * p.c[1]) @ p.q.T).astype(np.float32)
    ma, mb = a.max(1, keepdims=True), b.max(1, keepdims=True)
    z = np.log(np.exp(a - ma) @ np.exp(b - mb).T) + ma + mb.T
    return tuple(np.ascontiguousarray(x / np.log(10), np.float32) for x in (a, b, z))


SCORED = T.StructType(
    [*row_type("n_tokens long, n_known long, base double, score double").fields,
     T.StructField("rare", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.IntegerType())])))]
)


def score_texts(texts, known: Words, matrix: np.ndarray, dim: int):
    """Rows of SCORED: sums over the tokens that are in ``known``, and the words that are not.

    ``base``: sum of log10(c + 0.1); ``score``: the model's sum, without the same sum
    over the words that are not."""
    key = hashlib.sha256(matrix.tobytes()).digest()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = tables(matrix, dim)
    a, b, z = _TABLES[key]
    logs = np.log10(known.counts + 0.1)
    for text in texts:
        words = lower_words(text)
        at = known.find(words)
        x = known.classes(at)
        w2, w1, w = x[:-2], x[1:-1], x[2:]
        here = at[at >= 0]
        rare = Counter(words[i] for i in np.flatnonzero(at < 0).tolist())
        score = float(a[w1, w].sum(dtype=np.float64) + b[w2, w].sum(dtype=np.float64) - z[w1, w2].sum(dtype=np.float64))
        score += float(known.shares[here].sum()) - float(known.divisors[-1 - at[at < 0]].sum())
        yield len(at), int((known.counts[here] > 0).sum()), float(logs[here].sum()), score, [(r.decode("utf-8"), n) for r, n in rare.items()]


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, classes: int = CLASSES, dim: int = DIM, head: int = HEAD) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    if not 2 < classes <= head:
        raise ValueError("classes must be more than 2 and at most head")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(True))
    base = doc_columns(docs, id_col, text_col)
    learn = base.where(~out)
    vocab = staged(learn.select("text").mapInPandas(count_words, COUNTS).groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    total, distinct = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top, left = most_frequent(vocab, head)
    end = int(top.loc[top["word"] == END_WORD, "c"].sum())
    if not end:  # only when the head is smaller than the number of words more frequent than documents
        end = int(vocab.where(F.col("word") == END_WORD).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    top = top[top["word"] != END_WORD]
    known = Words([w.encode("utf-8") for w in top["word"]], top["c"].tolist(), end, classes)
    hashed = (F.crc32(F.col("word").cast("binary")) % known.hashed).alias("at")
    sums = left.where(F.col("word") != END_WORD).groupBy(hashed).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).toPandas()  # a row a class
    known.beyond(sums["at"], sums["c"], sums["n"])
    matrix = train(learn, known, known.unigram(), int(total), dim)
    per_token = math.log10(total + 0.1 * (distinct + 1))

    @pandas_udf(SCORED)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(score_texts(texts, known, matrix, dim)), columns=SCORED.names)

    rows = base.select("doc_id", out.alias("held_out"), run("text").alias("s"), F.monotonically_increasing_id().alias("row"))
    rows = staged(rows.select("doc_id", "held_out", "row", "s.*"), "lm-rows")
    words = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    found = words.join(vocab.where(F.col("word") != END_WORD), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("sum")
    )
    done = rows.drop("rare").join(found, "row", "left").na.fill({"more": 0, "sum": 0.0})
    return done.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more")).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("sum") - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("score") + F.col("sum")).alias("score"),
    )
