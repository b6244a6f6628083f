"""Toxicity by a classifier chain of linear models.

The chain has one logistic model per category, in order. Each sees the words of the text
(present or not, hashed) and the probabilities of the categories before it. While
training, those probabilities are out-of-fold predictions, so a later model learns how
far the earlier ones can be trusted on texts they have not seen.

The first category, ``low_quality``, and the last, ``toxic``, are learnt from the labels.
The ones between have no labels of their own; a labelled text belongs to one if it is toxic
and uses one of its SEEDS.
Training takes a bounded sample, at most SAMPLE texts of each label value spread over the
hash range of doc_id, weighted back to the shares that all labels have. Each fit keeps
its FEATURES most telling words. Prediction is one pass over the whole texts.

Defined results: null text and text without a word have no word features and get the
chain's base rates; a text is toxic from THRESHOLD on; without labels every probability
is 0; a category that no sample text belongs to has probability 0 throughout; labels that
are null or lack a document teach nothing; where labels of one document differ, toxic wins,
and low quality does; labels without a quality leave that category at probability 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from purchaseflow.llm.hashing import words

SAMPLE = 2048
FOLDS = 5
FEATURES = 1024
LOG2_BUCKETS = 18
THRESHOLD = 0.4  # on held-out labels it catches more than 0.5 and no more clean texts
TOXIC = "toxic"
LOW_QUALITY = "low_quality"
PENALTY = 1e-4

# Words that mark a category among toxic texts.
SEEDS = {
    "insult": ["idiot", "moron", "stupid", "clown", "loser", "fool", "dumb", "imbecile"],
    "demeaning": ["trash", "scum", "worthless", "pathetic", "disgusting", "garbage", "vermin"],
}


def buckets(text: str | None) -> np.ndarray:
    """The hash buckets of the words of a text, each once."""
    found = words(text or "", "isalnum", inside=True)
    return np.unique(found >> np.uint64(64 - LOG2_BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Linear:
    """Logistic model: weights of the word ``features``, of earlier categories, and bias."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def probability(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        return _logistic(x @ self.weights + before @ self.earlier + self.bias)


def _logistic(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _dense(rows: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    place = np.full(1 << LOG2_BUCKETS, -1)
    place[features] = np.arange(len(features))
    x = np.zeros((len(rows), len(features)), np.float32)
    for i, row in enumerate(rows):
        at = place[row]
        x[i, at[at >= 0]] = 1
    return x


def fit_linear(
    rows: list[np.ndarray], before: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> Linear | None:
    """Logistic regression on the most telling words; None if ``y`` has one value only."""
    if y.all() or not y.any():
        return None
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    size = [len(r) for r in rows]
    count = 1 << LOG2_BUCKETS
    hit = np.bincount(flat, np.repeat(weight * y, size), count)
    miss = np.bincount(flat, np.repeat(weight * ~y, size), count)
    seen = np.bincount(flat, minlength=count)
    positive, negative = (weight * y).sum(), (weight * ~y).sum()
    tell = np.abs(hit / positive - miss / negative) * np.sqrt(seen)
    tell[seen < 5] = 0
    best = np.argsort(-tell, kind="stable")[:FEATURES]
    features = np.sort(best[tell[best] > 0])
    x = np.hstack([_dense(rows, features), before, np.ones((len(rows), 1))]).astype(np.float32)
    share = (weight / weight.sum()).astype(np.float32)
    probe = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        probe = x.T @ (share * (x @ probe))
        length = np.linalg.norm(probe)
        probe /= length
    step = 1.0 / (length / 4 + PENALTY)
    w = ahead = np.zeros(x.shape[1], np.float32)
    still = np.full(x.shape[1], PENALTY, np.float32)
    still[-1] = 0
    for i in range(250):
        slope = x.T @ (share * (_logistic(x @ ahead) - y)) + still * ahead
        new = (ahead - step * slope).astype(np.float32)
        ahead = new + np.float32(i / (i + 3)) * (new - w)
        w = new
    k = len(features)
    return Linear(features, w[:k], w[k:-1], float(w[-1]))


@dataclass(frozen=True)
class Chain:
    """Categories in order, each with its model (None: probability 0)."""

    models: tuple[tuple[str, Linear | None], ...]

    def predictor(self):
        """A function from bucket arrays to a matrix of probabilities."""
        fitted = [m.features for _, m in self.models if m is not None]
        union = np.unique(np.concatenate(fitted)) if fitted else np.zeros(0, np.int64)
        weights = np.zeros((len(union), len(self.models)), np.float32)
        for k, (_, model) in enumerate(self.models):
            if model is not None:
                weights[np.searchsorted(union, model.features), k] = model.weights
        place = np.full(1 << LOG2_BUCKETS, -1)
        place[union] = np.arange(len(union))

        def predict(rows: list[np.ndarray]) -> np.ndarray:
            margins = np.zeros((len(rows), len(self.models)))
            for i, row in enumerate(rows):
                at = place[row]
                margins[i] = weights[at[at >= 0]].sum(axis=0)
            found = np.zeros_like(margins)
            for k, (_, model) in enumerate(self.models):
                if model is not None:
                    rest = found[:, :k] @ model.earlier + model.bias
                    found[:, k] = _logistic(margins[:, k] + rest)
            return found

        return predict


def train(
    rows: list[np.ndarray],
    seeded: Mapping[str, np.ndarray],
    toxic: np.ndarray,
    weight: np.ndarray,
    fold: np.ndarray,
    first: Mapping[str, np.ndarray] | None = None,
) -> Chain:
    """The chain over the categories of ``first``, of ``seeded`` and, last, ``toxic``."""
    targets = dict(first or {}) | {name: used & toxic for name, used in seeded.items()}
    targets[TOXIC] = toxic
    before = np.zeros((len(rows), 0))
    models = []
    for name, y in targets.items():
        models.append((name, fit_linear(rows, before, y, weight)))
        out = np.zeros(len(rows))
        for k in range(FOLDS):
            inside, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            part = fit_linear([rows[i] for i in inside], before[inside], y[inside], weight[inside])
            if part is not None and held.size:
                x = _dense([rows[i] for i in held], part.features)
                out[held] = part.probability(x, before[held])
        before = np.hstack([before, out[:, None]])
    return Chain(tuple(models))


def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([buckets(t).astype(np.int32).tobytes() for t in texts], dtype=object)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    quality: str = "quality",
    sample: int = SAMPLE,
    seeds: Mapping[str, list[str]] = SEEDS,
) -> Chain:
    """Learns from at most ``sample`` labelled documents of each label value."""
    nothing = Chain(tuple((name, None) for name in (LOW_QUALITY, *seeds, TOXIC)))
    low = F.col(quality) == 0 if quality in labels.columns else F.lit(None).cast("boolean")
    known = (
        labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(
            F.max((F.col(toxic) > 0).cast("int")).alias("__toxic"),
            F.coalesce(F.max(low.cast("int")), F.lit(0)).alias("__low"),
        )
    )
    chosen = (
        known.groupBy("__toxic", F.pmod(F.xxhash64("__id"), F.lit(sample)).alias("__bucket"))
        .agg(
            F.min(F.struct("__id", "__low")).alias("__one"),
            F.count(F.lit(1)).alias("__stands_for"),
        )
        .select("__one.*", "__toxic", "__stands_for")
    )
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    # at most two times ``sample`` ids, so small enough to send to every task
    found = (
        rows.join(F.broadcast(chosen), "__id")
        .dropDuplicates(["__id"])
        .select(
            "__id",
            "__toxic",
            "__low",
            "__stands_for",
            F.pmod(F.xxhash64(F.lit(1), "__id"), F.lit(FOLDS)).alias("__fold"),
            F.pandas_udf(_features, "binary")("__text").alias("__x"),
        )
        .toArrow()
        .sort_by("__id")
    )
    if not found.num_rows:
        return nothing
    lists = [np.frombuffer(v, np.int32).astype(np.int64) for v in found["__x"].to_pylist()]
    y = found["__toxic"].to_numpy() > 0
    marks = {name: buckets(" ".join(seed)) for name, seed in seeds.items()}
    seeded = {n: np.array([np.isin(m, r).any() for r in lists]) for n, m in marks.items()}
    weight = found["__stands_for"].to_numpy().astype(float)
    first = {LOW_QUALITY: found["__low"].to_numpy() > 0}
    return train(lists, seeded, y, weight, found["__fold"].to_numpy(), first)


def score(
    df: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, ``p_<category>`` for each category, and ``toxic``."""
    names = [f"p_{name}" for name, _ in chain.models]

    @F.pandas_udf(", ".join(f"{name} double" for name in names))
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = chain.predictor()
        for texts in batches:
            yield pd.DataFrame(predict([buckets(t) for t in texts]), columns=names)

    return df.select(F.col(doc_id).alias("doc_id"), predicted(F.col(text)).alias("p")).select(
        "doc_id", "p.*", (F.col(f"p.p_{TOXIC}") >= THRESHOLD).alias(TOXIC)
    )
