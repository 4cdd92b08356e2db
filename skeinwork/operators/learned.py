"""A learned reranker: sparse features from DataFrames, and a logistic regression fitted on a bounded set of labels.

Labels are few by nature (reviewed by hand); ``most_rows`` bounds what the driver takes. Vocabulary counts and the
scoring of candidates run over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.text import tokens

#: columns from which the answer could be read off
LEAKS = ("label", "false_positive_category", "label_notes", "source_url", "source_id", "subreddit")


@dataclass(frozen=True)
class Features:
    vocabulary: tuple[str, ...]
    numeric: tuple[str, ...]

    def __post_init__(self) -> None:
        if bad := set(self.numeric) & set(LEAKS):
            raise ValueError(f"features that give the label away: {sorted(bad)}")

    def names(self) -> list[str]:
        return [*[f"token:{t}" for t in self.vocabulary], *self.numeric]


def vocabulary(rows: DataFrame, text: str, least: int, most: int) -> list[str]:
    """The most frequent tokens by documents, of those in at least ``least`` of them; ties by name."""
    words = rows.select(F.explode(F.array_distinct(tokens(F.lower(F.coalesce(text, F.lit("")))))).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return [r["token"] for r in counts.orderBy(F.desc("n"), "token").limit(most).collect()]


def with_features(rows: DataFrame, text: str, spec: Features) -> DataFrame:
    """``rows`` with the array ``features``: 1 or 0 for each token, then the numbers (null as 0)."""
    found = rows.withColumn("_words", tokens(F.lower(F.coalesce(text, F.lit("")))))
    flags = [F.array_contains("_words", t).cast("double") for t in spec.vocabulary]
    return found.withColumn("features", F.array(*flags, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in spec.numeric])).drop("_words")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probability``, computed in the JVM."""
        total = F.aggregate(F.zip_with("features", F.array(*[F.lit(float(w)) for w in self.weights]), lambda x, w: x * w), F.lit(float(self.bias)), lambda a, b: a + b)
        return rows.withColumn("probability", 1 / (1 + F.exp(-total)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(x @ self.weights + self.bias)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 400, rate: float = 0.5, l2: float = 0.01, tolerance: float = 1e-7, patience: int = 25) -> Model:
    """Full-batch gradient descent from zero; the penalty is on weights only and no part of the loss. The same rows in the
    same order give the same model. Ends, after the step of that round, when the loss no longer falls."""
    w, b, best, waited = np.zeros(x.shape[1]), 0.0, np.inf, 0
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        error = p - y
        w = w - rate * (x.T @ error / len(y) + l2 * w)
        b -= rate * float(error.mean())
        sure = np.clip(p, 1e-12, 1 - 1e-12)
        loss = -np.mean(y * np.log(sure) + (1 - y) * np.log(1 - sure))
        if best - loss > tolerance:
            best, waited = loss, 0
            continue
        waited += 1
        if waited >= patience:
            break
    return Model(w, b)


def matrix(rows: DataFrame, key: Sequence[str], most_rows: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled rows in order of ``key``; more than ``most_rows`` are refused."""
    found = rows.select("features", F.col("label").cast("double").alias("label"), *key).orderBy(*key).limit(most_rows + 1).collect()
    if len(found) > most_rows:
        raise ValueError(f"more than {most_rows} labelled rows")
    return np.array([r["features"] for r in found], float), np.array([r["label"] for r in found], float)


def choose_threshold(y: np.ndarray, p: np.ndarray, least_precision: float, undecided: np.ndarray | None = None, retained: np.ndarray | None = None) -> dict[str, float | bool]:
    """The threshold from which ``undecided`` rows (all, if not given) are promoted beside those ``retained`` already: highest
    recall among those that reach the precision, then highest precision, then the highest threshold, from nothing
    (infinity) to all (minus infinity). Where none reaches it, ``selected`` is false and nothing is promoted."""
    undecided = np.ones(len(y), bool) if undecided is None else undecided
    retained = np.zeros(len(y), bool) if retained is None else retained
    positives = max(1.0, float((y == 1).sum()))
    best = None
    for t in [np.inf, *sorted(set(p[undecided].tolist())), -np.inf]:
        chosen = retained | (undecided & (p >= t))
        if not chosen.any():
            continue
        hit = float((y[chosen] == 1).sum())
        key = (hit / positives, hit / float(chosen.sum()), t)
        if key[1] >= least_precision and (best is None or key > best):
            best = key
    if best is None:
        return {"threshold": np.inf, "precision": 0.0, "recall": 0.0, "selected": False}
    return {"threshold": best[2], "precision": best[1], "recall": best[0], "selected": True}


def cross_validate(x: np.ndarray, y: np.ndarray, folds: int = 5, least_precision: float = 0.75) -> dict[str, float]:
    """Pooled figures over folds by row number, each fold judged by the model and threshold of the others."""
    kept = np.zeros(len(y), bool)
    fold = np.arange(len(y)) % folds
    for k in range(folds):
        train, test = fold != k, fold == k
        model = fit(x[train], y[train])
        at = choose_threshold(y[train], model.predict(x[train]), least_precision)
        kept[test] = model.predict(x[test]) >= at["threshold"]
    hit = float((y[kept] == 1).sum())
    return {"precision": hit / kept.sum() if kept.any() else 0.0, "recall": hit / max(1.0, float((y == 1).sum())), "kept": int(kept.sum())}


def promote(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows of decision ``evaluate`` that reach the threshold become ``retain``; nothing else changes."""
    up = (F.col("decision") == "evaluate") & (F.col("probability") >= threshold)
    return scored.withColumns({"promoted": up, "decision": F.when(up, "retain").otherwise(F.col("decision"))})
