"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Confirmed toxic examples and unlabelled text train a numpy classifier; rows
labelled clean serve as unlabelled text like any other.  The risk of a scorer
``f`` is ``prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])`` with the
logistic loss ``l``: the corrected second term estimates the risk on clean text,
and where a batch makes it negative the step only undoes that.  Labels are read
from training rows alone (``crc32(id) % folds != 0``), and so is the class prior,
the toxic share of the labelled training rows.

Features are character 4-grams inside words (word edges included), present or
not, over the whole text; they need no language.  The bounded training sample
(``positives`` and ``unlabelled`` rows on average, taken by a hash of the id)
fixes the ``features`` grams that tell the two sides apart best, counted in Spark,
and the weights.  Every document is then scored whole in one pass, with an
Aho-Corasick automaton over the grams and no shuffle.

Defined results: null and empty texts have no grams and score the bias alone;
without a toxic training row every score is 0.0; an empty table gives no rows;
repeated rows score alike; rows of labels that repeat an id count once, as toxic
if any of them is; rows with a null id are held out; columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, DoubleType

from .common import doc_columns, row_type, staged

POSITIVES = 8192
UNLABELLED = 16384
FEATURES = 2048
GRAM = 4
EPOCHS = 100
BATCH = 1024
RATE = 0.05
DECAY = 3e-4
#: A gram is taken when so many rows of the sample hold it, and its share among
#: positive rows lies so many standard errors above that among unlabelled ones.
LEAST_ROWS = 3
LEAST_Z = 4.0

_WORD = re.compile(r"\w+")
_AUTOMATA: dict[tuple, ahocorasick.Automaton] = {}


def remainder(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def spaced(text: str | None) -> str:
    """Lower-case words between single spaces."""
    return f" {' '.join(_WORD.findall(text.lower()))} " if text else ""


def grams(text: str | None) -> set[str]:
    """Distinct grams of a text, each inside one word and its two edges."""
    out: set[str] = set()
    for word in set(spaced(text).split()):
        word = f" {word} "
        out.update(word[i : i + GRAM] for i in range(max(1, len(word) - GRAM + 1)))
    return out


def present(texts: pd.Series, names: tuple[str, ...]):
    """For each text the sorted indices of the grams that it holds."""
    if not names:
        yield from ([] for _ in texts)
        return
    auto = _AUTOMATA.get(names)
    if auto is None:
        auto = ahocorasick.Automaton()
        for i, name in enumerate(names):
            auto.add_word(name, i)
        auto.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[names] = auto
    for text in texts:
        yield sorted({i for _, i in auto.iter(spaced(text))})


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    weights: np.ndarray
    bias: float
    prior: float


def sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int, folds: int) -> tuple[DataFrame, float]:
    """Training rows ``(text, p)``, ``p`` true for confirmed toxic ones, and the class prior.

    About ``positives`` and ``unlabelled`` rows, however often ids or rows repeat:
    rows equal in id and text count once, and of ids with many texts a share is drawn."""
    known = labels.where(remainder(F.col("doc_id"), folds) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.count("toxic"), F.sum("toxic")).first()
    if not share[1]:
        return docs.limit(0).select("text", F.lit(True).alias("p")), 0.0
    spot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1 << 30))
    toxic = known.where("toxic = 1").where(spot < int(min(1.0, positives / share[1]) * (1 << 30))).select("doc_id")
    train = docs.where(remainder(F.col("doc_id"), folds) != 0)
    rows = train.count()
    spot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    share_of = lambda bound, n: spot < int(min(1.0, bound / max(1, n)) * (1 << 30))
    some = train.where(share_of(unlabelled, rows)).dropDuplicates(["doc_id", "text"])
    found = staged(train.join(F.broadcast(toxic), "doc_id").dropDuplicates(["doc_id", "text"]), "toxicity-confirmed")  # at most about `positives` ids
    found = found.where(share_of(2 * positives, found.count()))
    return found.select("text", F.lit(True).alias("p")).unionByName(some.select("text", F.lit(False).alias("p"))), share[1] / share[0]


def choose(rows: DataFrame, features: int) -> list[str]:
    """The grams whose share among positive rows lies furthest above that among unlabelled ones."""

    def count(batches):
        seen, n = Counter(), [0, 0]
        for pdf in batches:
            for text, p in zip(pdf["text"], pdf["p"]):
                n[p] += 1
                seen.update((g, bool(p)) for g in grams(text))
        yield pd.DataFrame([(None, 0, n[False], n[True])] + [(g, 1, 0 if p else c, c if p else 0) for (g, p), c in seen.items()], columns=COUNTED.names)

    counted = rows.mapInPandas(count, COUNTED).groupBy("gram", "kind").agg(F.sum("u").alias("u"), F.sum("p").alias("p"))
    totals = counted.where("kind = 0").select(F.col("u").alias("nu"), F.col("p").alias("np"))
    pu, pp = (F.col("u") + 0.5) / (F.col("nu") + 1), (F.col("p") + 0.5) / (F.col("np") + 1)
    best = (
        counted.where((F.col("kind") == 1) & (F.col("p") + F.col("u") >= LEAST_ROWS))
        .crossJoin(F.broadcast(totals))  # one row
        .select("gram", ((pp - pu) / F.sqrt(pu * (1 - pu) / F.col("np") + 1e-12)).alias("z"))
        .where(F.col("z") > LEAST_Z)
        .orderBy(F.desc("z"), "gram")
        .limit(features)
    )
    return sorted(r["gram"] for r in best.collect())


COUNTED = row_type("gram string, kind int, u long, p long")


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model | None:
    """Model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``); None without positives."""
    rows, prior = sample(docs, labels, positives, unlabelled, folds)
    if not prior:
        return None
    names = tuple(choose(rows, features))

    @pandas_udf(BinaryType())
    def held(texts: pd.Series) -> pd.Series:
        """A bit for each gram."""
        out = []
        for at in present(texts, names):
            row = np.zeros(len(names), np.uint8)
            row[at] = 1
            out.append(np.packbits(row).tobytes())
        return pd.Series(out, dtype=object)

    got = rows.select("p", held("text").alias("x")).toPandas()  # at most about (positives + unlabelled) * features / 8 bytes
    p = got["p"].to_numpy(bool)
    if not names or not p.any() or p.all():
        return None
    x = np.frombuffer(b"".join(got["x"]), np.uint8).reshape(len(got), -1)
    weights, bias = train(x[p], x[~p], len(names), prior)
    return Model(names, weights, bias, prior)


def train(pos: np.ndarray, unl: np.ndarray, features: int, prior: float, epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam on mini-batches.

    ``pos`` and ``unl`` hold a bit for each feature (``numpy.packbits`` by row)."""
    rows = lambda bits: np.unpackbits(bits, axis=1, count=features).astype(np.float32)
    rng = np.random.default_rng(seed)
    w = np.zeros(features + 1, np.float32)
    w[-1] = math.log(prior / (1 - prior)) if prior < 1 else 0.0
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -40, 40)))
    rounds = max(1, len(unl) // BATCH)
    for _ in range(max(epochs, 300 // rounds)):
        order = rng.permutation(len(unl))
        for part in np.array_split(order, rounds):
            u = rows(unl[part])
            q = rows(pos[rng.integers(0, len(pos), min(len(pos), BATCH))])
            fu, fp = u @ w[:-1] + w[-1], q @ w[:-1] + w[-1]
            clean = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            du, dp = sigmoid(fu) / len(fu), prior * sigmoid(fp) / len(fp)
            if clean >= 0:
                dp = -prior * sigmoid(-fp) / len(fp) - dp
            else:
                du, dp = -du, dp
            grad = np.append(du @ u + dp @ q, du.sum() + dp.sum())
            grad[:-1] += DECAY * w[:-1]
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad**2
            w -= RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1].copy(), float(w[-1])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (``doc_id, text``) with ``score`` from 0 to 1, one pass over whole texts."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    names, weights, bias = model.names, model.weights, model.bias

    @pandas_udf(DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        sums = np.array([weights[i].sum() if i else 0.0 for i in present(texts, names)])
        return pd.Series(1 / (1 + np.exp(-np.clip(sums + bias, -40, 40))))

    return docs.select("doc_id", run("text").alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, **bounds) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    base = doc_columns(docs, id_col, text_col)
    model = fit(base, labels.select(F.col(id_col).alias("doc_id"), "toxic"), folds, **bounds)
    held = F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(True))
    return score(base, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
