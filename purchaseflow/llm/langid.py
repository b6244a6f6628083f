"""Language identification in two steps: the family first, then the language within it.

Features are counts of letter runs of one to three, hashed to BUCKETS, as unit vectors of
their square roots. Linear support vector machines (squared hinge) tell the families
apart, one against the rest; within the chosen family one machine for each pair of
languages votes. Languages are those of the labels; FAMILIES names the family of common
ones, and those it does not name form families of their own, learnt by halving them by
their mean vectors until none has more than FAMILY_SIZE. So the number of machines grows
with the languages, not with their square.

Training takes a bounded sample: of the rows that may teach, those in the LANGUAGES most
frequent languages (of equals the first by name), at most SAMPLE per language and
ALTOGETHER, spread over the hash range of doc_id. A label column of any number of values
thus costs the driver no more. The sample is found from ids alone, so only its texts move,
as vectors of fixed size. Prediction is one pass over the whole texts without a shuffle.

Defined results: null text, and text without a letter, is ``und`` with score 0; so is
every text if there was nothing to learn from. Ties go to the language with the higher
sum of pairwise scores, then to the first by name. Rows without an id don't teach. The
score is the logistic of the family margin times the mean logistic of the pair margins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from purchaseflow.llm.hashing import letter_grams

UNKNOWN = "und"
SAMPLE = 512  # rows of a language that teach, at most
ALTOGETHER = 16_384  # rows that teach, at most
LANGUAGES = 256  # that are learnt, at most
FAMILY_SIZE = 8  # of a learnt family, at most
LOG2_BUCKETS = 12
BUCKETS = 1 << LOG2_BUCKETS
STEEPNESS = 3.0  # of the logistic that turns a margin into a score
COST = 10.0

# The family of a language by its ISO 639-1 code.
FAMILIES = {
    **dict.fromkeys(["en", "de", "nl", "sv", "da", "no", "nb", "is"], "germanic"),
    **dict.fromkeys(["fr", "es", "pt", "it", "ro", "ca", "gl"], "romance"),
    **dict.fromkeys(["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"], "slavic"),
    **dict.fromkeys(["fi", "et", "hu"], "uralic"),
    **dict.fromkeys(["hi", "ur", "bn", "fa"], "indo-iranian"),
    **dict.fromkeys(["ar", "he"], "semitic"),
    **dict.fromkeys(["tr", "az", "kk"], "turkic"),
}


def vector(text: str) -> np.ndarray | None:
    """The unit feature vector of a text, or None without a letter."""
    counts = letter_grams(text, LOG2_BUCKETS)
    return _unit(counts) if counts.any() else None


def _unit(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def _svm(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights and bias (last) of a linear SVM by accelerated gradient descent.

    Both classes weigh alike.
    """
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    mean = x.mean(axis=0)
    z = np.ones((len(x), x.shape[1] + 1), np.float32)
    np.subtract(x, mean, out=z[:, :-1])
    scale = COST * len(x) * weight.astype(np.float32)
    probe = np.random.default_rng(0).standard_normal(z.shape[1]).astype(np.float32)
    for _ in range(12):
        probe = z.T @ (scale * (z @ probe))
        length = np.linalg.norm(probe)
        probe /= length
    step = 1.0 / (1.0 + 2.2 * length)
    w = ahead = np.zeros(z.shape[1], np.float32)
    for i in range(200):
        lack = np.maximum(0.0, 1.0 - y * (z @ ahead))
        new = ahead - step * (ahead - 2.0 * (z.T @ (scale * y * lack)))
        ahead = new + i / (i + 3.0) * (new - w)
        w = new
    return np.append(w[:-1], w[-1] - w[:-1] @ mean).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``families``: (name, its languages, weights against the rest or None if alone).
    ``pairs``: weights by (family, i, j), positive where language i is meant."""

    families: tuple[tuple[str, tuple[str, ...], np.ndarray | None], ...]
    pairs: Mapping[tuple[int, int, int], np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        x = vector(text) if text and self.families else None
        if x is None:
            return UNKNOWN, 0.0
        margins = [0.0 if w is None else w[:-1] @ x + w[-1] for _, _, w in self.families]
        chosen = int(np.argmax(margins))
        _, languages, w = self.families[chosen]
        score = 1.0 if w is None else _logistic(margins[chosen])
        votes = np.zeros((len(languages), 2))
        for i, j in combinations(range(len(languages)), 2):
            v = self.pairs[chosen, i, j]
            p = _logistic(v[:-1] @ x + v[-1])
            votes[i] += (p >= 0.5, p)
            votes[j] += (p < 0.5, 1 - p)
        best = max(range(len(languages)), key=lambda i: (*votes[i], -i))
        if len(languages) > 1:
            score *= votes[best, 1] / (len(languages) - 1)
        return languages[best], float(score)


def _logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-STEEPNESS * np.clip(margin, -30, 30))))


def learnt_families(names: list[str], means: np.ndarray) -> dict[str, str]:
    """Families of at most FAMILY_SIZE languages with similar mean vectors.

    Groups that are too large are halved around two means far from each other, by some
    rounds of two-means; a half that would be empty takes the second half by name.
    """
    groups, done = [list(range(len(names)))], []
    while groups:
        group = groups.pop()
        if len(group) <= FAMILY_SIZE:
            done += [group] if group else []
            continue
        x = means[group]
        far = int(np.square(x - x.mean(axis=0)).sum(axis=1).argmax())
        centres = x[[far, int(np.square(x - x[far]).sum(axis=1).argmax())]]
        for _ in range(20):
            away = np.stack([np.square(x - c).sum(axis=1) for c in centres])
            second = away[1] < away[0]
            if second.all() or not second.any():
                second = np.arange(len(group)) >= len(group) // 2
            centres = np.stack([x[~second].mean(axis=0), x[second].mean(axis=0)])
        groups += [[g for g, s in zip(group, second) if s == side] for side in (True, False)]
    done.sort()
    if len(done) == 1:
        return dict.fromkeys(names, "other")
    return {names[i]: f"other {names[group[0]]}" for group in done for i in group}


def train(x: np.ndarray, lang: np.ndarray, families: Mapping[str, str] = FAMILIES) -> Model:
    """The model of feature vectors ``x`` (one a row) in the languages ``lang``."""
    others = sorted(set(lang) - set(families))
    means = np.stack([x[lang == name].mean(axis=0) for name in others]) if others else x[:0]
    learnt = learnt_families(others, means) | dict(families)
    family = np.array([learnt[name] for name in lang], dtype=object)
    names = sorted(set(family))
    listed, pairs = [], {}
    for k, name in enumerate(names):
        languages = sorted(set(lang[family == name]))
        listed.append((name, tuple(languages), _svm(x, family == name) if len(names) > 1 else None))
        for i, j in combinations(range(len(languages)), 2):
            both = (lang == languages[i]) | (lang == languages[j])
            pairs[k, i, j] = _svm(x[both], lang[both] == languages[i])
    return Model(tuple(listed), pairs)


def _packed(texts: pd.Series) -> pd.Series:
    """The counts of each text, compressed to some KB, or None without a letter."""
    found = (letter_grams(text, LOG2_BUCKETS) for text in texts)
    packed = [zlib.compress(c.astype("<i8").tobytes(), 1) if c.any() else None for c in found]
    return pd.Series(packed, dtype=object)


def fit(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    families: Mapping[str, str] = FAMILIES,
) -> Model:
    """Learns from at most ``sample`` rows of ``df`` per language."""
    known = df.filter(F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    counted = known.groupBy(lang).agg(F.count(F.lit(1)).alias("__rows"))
    frequent = counted.orderBy(F.desc("__rows"), lang).limit(LANGUAGES).collect()
    if not frequent:
        return Model((), {})
    known = known.filter(F.col(lang).isin([r[lang] for r in frequent]))
    sample = max(1, min(sample, ALTOGETHER // len(frequent)))
    chosen = (
        known.select(F.col(doc_id).alias("__id"), F.col(lang).alias("__lang"))
        .groupBy("__lang", F.pmod(F.xxhash64("__id"), F.lit(sample)).alias("__bucket"))
        .agg(F.min("__id").alias("__id"))
        .select("__id")
        .distinct()
    )
    rows = known.select(
        F.col(doc_id).alias("__id"), F.col(lang).alias("__lang"), F.col(text).alias("__text")
    )
    # at most ALTOGETHER ids, so small enough to send to every task
    texts = (
        rows.filter(F.col("__text").isNotNull())
        .join(F.broadcast(chosen), "__id", "left_semi")
        .dropDuplicates(["__id"])
    )
    packed = F.pandas_udf(_packed, "binary")("__text").alias("__x")
    # those without a letter go here: Spark would count all letters a second time for a filter,
    # in a second Python worker a task, which stays with the executor after
    found = texts.select("__lang", packed).toArrow()
    found = found.filter(found["__x"].is_valid())
    if not found.num_rows:
        return Model((), {})
    # counts come compressed, so that beside the matrix of vectors there is room to train
    x = np.empty((found.num_rows, BUCKETS), dtype=np.float32)
    for row, value in zip(x, found["__x"], strict=True):
        row[:] = _unit(np.frombuffer(zlib.decompress(value.as_py()), dtype="<i8"))
    lang_of = np.array(found["__lang"].to_pylist(), dtype=object)
    del found
    # the order rows arrive in differs from run to run
    order = sorted(range(len(x)), key=lambda i: (lang_of[i], x[i].tobytes()))
    x, lang_of = x[order], lang_of[order]
    return train(x, lang_of, families)


def predictor(model: Model):
    """A column function: text to struct (lang_pred, score)."""

    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            # a few rows at a time, so that no more texts are Python objects than needed
            for start in range(0, len(texts), 256):
                rows += map(model.predict, texts.slice(start, 256).to_pylist())
            names, scores = zip(*rows, strict=True) if rows else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["lang_pred", "score"],
            )

    return F.arrow_udf(predicted, "lang_pred string, score double")


def may_teach(doc_id: str | Column) -> Column:
    """False for the held-out third of the documents, by the checksum of the id."""
    ident = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(ident.cast("string")) % 3 != 1, F.lit(True))


def identify(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; learnt from the rows not held out."""
    model = fit(df.filter(may_teach(doc_id)), doc_id, text, lang)
    return df.select(
        F.col(doc_id).alias("doc_id"),
        (~may_teach(doc_id)).alias("held_out"),
        predictor(model)(F.col(text)).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language can be told stay, those ``und`` go."""
    model = fit(docs)
    told = predictor(model)(F.col("text"))["lang_pred"]
    return docs.filter(told != UNKNOWN)
