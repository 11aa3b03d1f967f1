"""Quality by naive Bayes support vectors.

Features are the byte n-grams of a text, present or not, hashed to ``BUCKETS``. Each is
scaled by its log-count ratio: how much more often documents of class 1 have it than those
of class 0. On the scaled features, brought to length one, a linear hinge-loss model is
fitted by dual coordinate descent, and its margins are calibrated on labelled documents
that the weights were not fitted to.

The fit reads at most about ``SAMPLE_ROWS`` labelled documents, whole ones, and runs on the
driver; scoring runs in tasks on whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import bounded_sample
from telmart.llm.toxicity import fit_sigmoid, sigmoid

SAMPLE_ROWS = 4_000
BUCKETS = 1 << 17
LONGEST = 4  # bytes of an n-gram
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 15
VALIDATION_SHARE = 0.25
THRESHOLD = 0.7
SEED = 5
_PIECE = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams that a text has, of 1 to ``LONGEST`` bytes."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    present = np.zeros(BUCKETS, bool)
    for start in range(0, len(data), _PIECE):
        part = data[start : start + _PIECE + LONGEST - 1].astype(np.uint64)
        code = np.zeros(len(part), np.uint64)
        for length in range(1, LONGEST + 1):
            if len(part) < length:
                break
            code = code[: len(part) - length + 1] * np.uint64(257) + part[length - 1 :] + np.uint64(1)
            present[((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)).astype(np.int64)] = True
    return np.flatnonzero(present).astype(np.int32)


@dataclass
class NbSvm:
    """Squared ratios give a text's length; weights already hold the ratios."""

    ratios: np.ndarray
    weights: np.ndarray
    constant: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt((self.ratios[found] ** 2).sum()))
        return (float(self.weights[found].sum()) / norm if norm else 0.0) + self.constant

    def probability(self, margin: float) -> float:
        return float(sigmoid(self.slope * margin + self.offset))


def log_count_ratios(texts: list[np.ndarray], labels: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    counts = np.full((2, BUCKETS), smoothing)
    for found, label in zip(texts, labels):
        counts[int(label), found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def train(texts: list[np.ndarray], labels: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> NbSvm:
    """Dual coordinate descent for the hinge loss: one dual variable a document, 0 to ``cost``.

    The rarer class costs more, so that both weigh the same.
    """
    ratios = log_count_ratios(texts, labels)
    rows = []
    for found in texts:
        values = ratios[found]
        norm = np.sqrt((values**2).sum())
        rows.append(values / norm if norm else values)
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.clip(np.mean(labels > 0), 1e-3, 1 - 1e-3) if len(labels) else 0.5
    limit = np.where(labels > 0, cost / (2 * share), cost / (2 * (1 - share)))
    squared = np.array([v @ v for v in rows]) + 1.0  # 1 for the constant
    alpha, weights, constant = np.zeros(len(texts)), np.zeros(BUCKETS), 0.0
    random = np.random.default_rng(SEED)
    for _ in range(epochs):
        for k in random.permutation(len(texts)):
            found, values = texts[k], rows[k]
            gradient = sign[k] * (weights[found] @ values + constant) - 1
            new = min(max(alpha[k] - gradient / squared[k], 0.0), limit[k])
            change = (new - alpha[k]) * sign[k]
            if change:
                weights[found] += change * values
                constant += change
                alpha[k] = new
    return NbSvm(ratios, weights * ratios, constant)


def fit(labelled: DataFrame, label_col: str = "label", id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> NbSvm:
    """Fit and calibrate on rows with a text and a label of 0 or 1."""
    sample = bounded_sample(labelled.where(F.col(label_col).isin(0, 1)), id_col, sample_rows)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "found": found})

    rows = (
        sample.select(
            F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text")
        )
        .mapInPandas(hashed, "id string, label int, found binary")
        .collect()
    )
    rows.sort(key=lambda r: (zlib.crc32((r["id"] or "").encode()), r["id"] or "", r["label"]))
    texts = [np.frombuffer(r["found"], np.int32) for r in rows]
    labels = np.array([r["label"] for r in rows], np.float64)
    cut = int(len(rows) * VALIDATION_SHARE)
    model = train(texts[cut:], labels[cut:])
    if cut:
        margins = np.array([model.margin(t) for t in texts[:cut]])
        model.slope, model.offset = fit_sigmoid(margins, labels[:cut])
    return model


def quality(text: Column, model: NbSvm) -> Column:
    """Probability that a text is of quality 1; for null or empty texts that of a text without n-grams."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.probability(model.margin(features(t))) for t in texts], dtype="float64")

    return F.pandas_udf(score, "double")(text)


def classify(
    docs: DataFrame, model: NbSvm, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """id, score and predicted; the score depends on the text alone.

    Repeated rows get equal answers; other columns are not looked at.
    """
    scored = docs.select(id_col, quality(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
