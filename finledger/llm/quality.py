"""Quality classifier: Bradley-Terry ranking of documents from preference pairs, cut at a score quantile.

Every labelled pair (good, bad) is a won comparison. The strength of a document is linear in features of its text, so
the chance that ``a`` beats ``b`` is ``sigmoid(w . (f(a) - f(b)))`` and the weights minimise the logistic loss on feature
differences. The cut is the quantile of the strengths of the training rows at the share of bad ones among them; the
returned score is a logistic curve that passes ``threshold`` exactly at the cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from math import log, log1p
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import labelled_sample

FEATURES = [
    "symbols", "digits", "shouted", "loose_marks", "exclamations", "repeated_next", "variety", "repeated_lines",
    "word_length", "long_words", "length",
]
SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")
DIGIT = re.compile(r"\d")
LOOSE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")


def text_features(text: str) -> list[float]:
    """Features of a whole text; an empty one has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    letters = sum(map(len, words))
    distinct = set(words)
    return [
        len(SYMBOL.findall(text)) / size,
        len(DIGIT.findall(text)) / size,
        sum(map(str.isupper, words)) / n,
        len(LOOSE.findall(text)) / n,
        text.count("!") / n,
        sum(map(eq, words, islice(words, 1, None))) / n,
        log(len(distinct)) / log(n) if n > 1 else 1.0,
        1 - len(set(lines)) / max(1, len(lines)),
        min(letters / n, 30.0),
        sum(len(w) > 25 for w in distinct) / n,
        log1p(n),
    ]


@dataclass
class QualityModel:
    """Weights on standardised features, and the curve from strength to score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float
    threshold: float

    def strength(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        at_cut = log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip((self.strength(features) - self.cut) / self.spread + at_cut, -500, 500)))


def fit_pairs(
    features: np.ndarray, good: np.ndarray, threshold: float, rivals: int, ridge: float, seed: int = 7
) -> QualityModel:
    """Newton steps on the logistic loss of feature differences; every row meets ``rivals`` rows of the other label.

    With one label only there is no comparison: all strengths are equal and every document passes.
    """
    width = features.shape[1] if features.size else len(FEATURES)
    wins, losses = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(wins) or not len(losses):
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), -1.0, 1.0, threshold)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.clip((features - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    first = np.concatenate([np.repeat(wins, rivals), rng.choice(wins, len(losses) * rivals)])
    second = np.concatenate([rng.choice(losses, len(wins) * rivals), np.repeat(losses, rivals)])
    diff = x[first] - x[second]
    w = np.zeros(width)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (1 - p) / len(diff) - ridge * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    strengths = np.sort(x @ w)
    low = len(losses)  # the quantile at the share of bad rows
    cut = (strengths[low - 1] + strengths[low]) / 2
    return QualityModel(mean, scale, w, float(cut), float(max(strengths.std(), 1e-6)), threshold)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    label: str = "quality",
    threshold: float = 0.3,
    sample_rows: int = 20_000,
    rivals: int = 5,
    ridge: float = 1e-3,
) -> QualityModel:
    """Fit on at most ``sample_rows`` labelled training rows; only their features, a bounded table, are fetched."""
    sample = labelled_sample(docs, labels, label, training, sample_rows)
    rows = sample.select(feature_column("text").alias("f"), "label").collect()
    features = np.array([r["f"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit_pairs(features, np.array([r["label"] for r in rows]), threshold, rivals, ridge)


def feature_column(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_features(t or "") for t in texts])

    return features(F.col(text))


def quality_score(model: QualityModel, text: str = "text") -> Column:
    """The score of a text, 0 to 1, as one narrow step; null counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if len(texts):
                yield pd.Series(model.score(np.array([text_features(t or "") for t in texts])))
            else:
                yield pd.Series([], dtype="float64")

    return score(F.col(text))


def score_quality(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score and prediction of every row: repeated rows are scored alike, null and empty texts get the score of
    zero features, other columns are left behind."""
    scored = docs.select(F.col(key), quality_score(model, text).alias("score"))
    return scored.select(key, "score", (F.col("score") >= model.threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows that the classifier accepts, with all their columns."""
    return docs.filter(quality_score(model, text) >= model.threshold)
