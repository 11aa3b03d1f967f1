"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two hashed ones, of the word and of its first bytes, so that
inflected forms share what was learned. Filters of several widths slide over the
word sequence; each filter's largest response over the whole text goes into one logistic
unit. Its output is calibrated on labelled documents that the weights were not fitted to,
and there a threshold is chosen for each language.

The fit reads at most about ``SAMPLE_ROWS`` labelled documents, whole ones, and runs on the
driver; scoring runs in tasks on whole texts, in pieces that overlap by a filter's width.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import bounded_sample

SAMPLE_ROWS = 8_000
BUCKETS = 1 << 17  # bucket 0 is for padding
PREFIX_BYTES = 4
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS = 10
BATCH = 32
RATE = 0.05
VALIDATION_SHARE = 0.25
THRESHOLD = 0.3
PRIOR_POSITIVES = 10  # what all languages together count for in each language's threshold
BINS = 1_000  # of scores, in which labelled rows are counted for thresholds
SEED = 11
_PIECE = 1 << 15  # words scored at once
_ASCII_WORD = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def word_buckets(text: str | None) -> np.ndarray:
    """Two buckets a word, of all of it and of its start; words are lower-case, ASCII punctuation separates them."""
    words = text.lower().encode().translate(_ASCII_WORD).split() if text else []
    hashed = np.empty((len(words), 2), np.uint32)
    hashed[:, 0] = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    # Another start value tells a short word from the start of a longer one.
    starts = (zlib.crc32(w[:PREFIX_BYTES], 1) for w in words)
    hashed[:, 1] = np.fromiter(starts, np.uint32, len(words))
    return (1 + hashed % (BUCKETS - 1)).astype(np.int32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels, by Newton steps."""
    positives, count = labels.sum(), len(labels)
    # Targets drawn in a little, so that separable margins don't need an infinite slope.
    target = np.where(labels > 0, (positives + 1) / (positives + 2), 1 / (count - positives + 2))
    x = np.stack([margins, np.ones(count)], axis=1)
    theta = np.array([1.0, 0.0])

    def loss(t):
        z = x @ t
        return np.sum(np.logaddexp(0, z) - target * z) + 1e-4 * t @ t

    for _ in range(50):
        p = sigmoid(x @ theta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-4 * np.eye(2), x.T @ (p - target) + 2e-4 * theta)
        size = 1.0
        while size > 1e-4 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


@dataclass
class TextCnn:
    """Weights: embeddings, one filter bank per place in a window, and the output unit."""

    embedding: np.ndarray
    banks: list[list[np.ndarray]]  # by width, by place: DIMENSIONS x FILTERS
    bias: np.ndarray
    output: np.ndarray
    constant: float
    slope: float = 1.0
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    general: float = THRESHOLD  # for languages without labelled rows
    trained_ids: list[str] = field(default_factory=list)

    @classmethod
    def new(cls) -> TextCnn:
        random = np.random.default_rng(SEED)
        draw = lambda *shape: random.standard_normal(shape).astype(np.float32)
        embedding = draw(BUCKETS, DIMENSIONS) * 0.03
        embedding[0] = 0
        banks = [[draw(DIMENSIONS, FILTERS) * (0.5 / np.sqrt(w)) for _ in range(w)] for w in WIDTHS]
        return cls(embedding, banks, np.zeros(len(WIDTHS) * FILTERS, np.float32), draw(len(WIDTHS) * FILTERS) * 0.1, 0.0)

    def responses(self) -> np.ndarray:
        """What each bucket adds to each filter at each place: a table for scoring."""
        return self.embedding @ np.hstack([bank for place in self.banks for bank in place])

    def windows(self, table: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Responses of all filters at all words; ``ids`` ends with max(WIDTHS) - 1 paddings."""
        rows = table[ids[:, 0]]
        rows += table[ids[:, 1]]
        size = len(ids) - max(WIDTHS) + 1
        out = np.empty((size, len(WIDTHS) * FILTERS), np.float32)
        column = 0
        for n, width in enumerate(WIDTHS):
            mine = out[:, n * FILTERS : (n + 1) * FILTERS]
            mine[:] = self.bias[n * FILTERS : (n + 1) * FILTERS]
            for place in range(width):
                mine += rows[place : place + size, column : column + FILTERS]
                column += FILTERS
        return out

    def margin(self, table: np.ndarray, ids: np.ndarray) -> float:
        ids = _padded(ids)
        pooled = np.full(len(WIDTHS) * FILTERS, 0, np.float32)
        overlap = max(WIDTHS) - 1
        for start in range(0, len(ids) - overlap, _PIECE):
            pooled = np.maximum(pooled, self.windows(table, ids[start : start + _PIECE + overlap]).max(axis=0))
        return float(pooled @ self.output) + self.constant

    def probability(self, margin: float) -> float:
        return float(sigmoid(self.slope * margin + self.offset))


def _padded(ids: np.ndarray) -> np.ndarray:
    return np.concatenate([ids, np.zeros((max(WIDTHS) - (len(ids) > 0), 2), np.int32)])


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> TextCnn:
    """Minibatch AdaGrad on logistic loss; gradients pass only through the largest responses."""
    model, random = TextCnn.new(), np.random.default_rng(SEED)
    padded = [_padded(ids) for ids in texts]
    size = len(WIDTHS) * FILTERS
    squares = {k: np.full_like(v, 1e-3) for k, v in (("e", model.embedding), ("o", model.output), ("b", model.bias))}
    bank_squares = [[np.full_like(b, 1e-3) for b in place] for place in model.banks]
    constant_square = 1e-3
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(padded)), max(1, len(padded) // BATCH)):
            filters = np.hstack([bank for place in model.banks for bank in place])
            best, pooled = np.zeros((len(batch), size), np.int64), np.zeros((len(batch), size), np.float32)
            for row, k in enumerate(batch):
                ids = padded[k]
                local, where = np.unique(ids, return_inverse=True)
                responses = model.windows(model.embedding[local] @ filters, where.reshape(ids.shape))
                best[row] = responses.argmax(axis=0)
                pooled[row] = responses[best[row], np.arange(size)]
            active = pooled > 0
            pooled = np.where(active, pooled, 0)
            error = (sigmoid(pooled @ model.output + model.constant) - labels[batch]).astype(np.float32) / len(batch)
            through = error[:, None] * model.output[None, :] * active
            touched, gradients = [], []
            for n, width in enumerate(WIDTHS):
                mine = slice(n * FILTERS, (n + 1) * FILTERS)
                for place in range(width):
                    ids = np.stack([padded[k][best[row, mine] + place] for row, k in enumerate(batch)])
                    bank = model.banks[n][place]
                    gradient = (through[:, mine, None] * bank.T[None]).reshape(-1, DIMENSIONS)
                    for column in (0, 1):
                        touched.append(ids[..., column].ravel())
                        gradients.append(gradient)
                    inputs = model.embedding[ids[..., 0]] + model.embedding[ids[..., 1]]
                    step = np.einsum("nfd,nf->df", inputs, through[:, mine])
                    bank_squares[n][place] += step**2
                    bank -= RATE * step / np.sqrt(bank_squares[n][place])
            rows, where = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(rows), DIMENSIONS), np.float32)
            np.add.at(total, where, np.concatenate(gradients))
            total[rows == 0] = 0
            squares["e"][rows] += total**2
            model.embedding[rows] -= RATE * total / np.sqrt(squares["e"][rows])
            for key, values, step in (("o", model.output, error @ pooled), ("b", model.bias, through.sum(axis=0))):
                squares[key] += step**2
                values -= RATE * step / np.sqrt(squares[key])
            constant_square += float(error.sum()) ** 2
            model.constant -= RATE * float(error.sum()) / constant_square**0.5
    return model


def _best_threshold(counts: np.ndarray) -> float:
    """The threshold with the best F1 by counts of (label, bin); the middle of equally good ones."""
    hits, rows = np.cumsum(counts[1][::-1])[::-1], np.cumsum(counts.sum(axis=0)[::-1])[::-1]
    f1 = 2 * hits / (rows + counts[1].sum())
    last = BINS - 1 - int(np.argmax(f1[::-1]))
    first = last
    while first and counts[:, first - 1].sum() == 0:
        first -= 1
    return (first + last) / 2 / BINS


def _set_thresholds(model: TextCnn, counts: dict[str, np.ndarray]) -> None:
    """A threshold for every language with labelled rows.

    Prior: all rows together, weighted as ``PRIOR_POSITIVES`` positives, are added to each
    language's counts, so few labels move a threshold a little and many decide it. Without
    any positive row all languages keep ``THRESHOLD``.
    """
    total = sum(counts.values(), np.zeros((2, BINS)))
    positives = total[1].sum()
    model.thresholds, model.general = {}, THRESHOLD
    if positives:
        model.general = _best_threshold(total)
        prior = total * (PRIOR_POSITIVES / positives)
        model.thresholds = {lang: _best_threshold(c + prior) for lang, c in counts.items()}


def fit(labelled: DataFrame, label_col: str = "label", id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> TextCnn:
    """Fit and calibrate on rows with a text and a label of 0 or 1."""
    sample = bounded_sample(labelled.where(F.col(label_col).isin(0, 1)), id_col, sample_rows)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [word_buckets(t).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "lang": batch["lang"], "label": batch["label"], "ids": ids})

    rows = (
        sample.select(
            F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"),
            F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text"),
        )
        .mapInPandas(hashed, "id string, lang string, label int, ids binary")
        .collect()
    )
    rows.sort(key=lambda r: (zlib.crc32((r["id"] or "").encode()), r["id"] or "", r["label"]))
    texts = [np.frombuffer(r["ids"], np.int32).reshape(-1, 2) for r in rows]
    labels = np.array([r["label"] for r in rows], np.float64)
    cut = int(len(rows) * VALIDATION_SHARE)
    model = train(texts[cut:], labels[cut:]) if len(rows) > cut else TextCnn.new()
    if cut:
        table = model.responses()
        margins = np.array([model.margin(table, t) for t in texts[:cut]])
        model.slope, model.offset = fit_sigmoid(margins, labels[:cut])
        scores = sigmoid(model.slope * margins + model.offset)
        counts: dict[str, np.ndarray] = {}
        for row, score in zip(rows[:cut], scores):
            found = counts.setdefault(row["lang"] or "", np.zeros((2, BINS)))
            found[row["label"], min(int(score * BINS), BINS - 1)] += 1
        _set_thresholds(model, counts)
    model.trained_ids = sorted({r["id"] for r in rows[cut:] if r["id"] is not None})
    return model


def toxicity(text: Column, model: TextCnn) -> Column:
    """Probability that a text is toxic; for null or empty texts that of a text without words."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.responses()
        for texts in batches:
            yield pd.Series([model.probability(model.margin(table, word_buckets(t))) for t in texts], dtype="float64")

    return F.pandas_udf(score, "double")(text)


def scores(docs: DataFrame, model: TextCnn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, lang and score of every row; the score depends on the text alone."""
    return docs.select(id_col, F.col(lang_col).alias("lang"), toxicity(F.col(text_col), model).alias("score"))


def calibrate(model: TextCnn, scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "label") -> None:
    """Set the languages' thresholds from all labelled rows of ``scored`` that the weights were not fitted to.

    ``labels`` has one row an id. Counts by language, bin and label reach the driver, no rows.
    """
    schema = "trained string"
    trained = scored.sparkSession.createDataFrame([(i,) for i in model.trained_ids], schema)
    free = labels.where(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("label")).join(
        F.broadcast(trained), F.col(id_col).cast("string") == F.col("trained"), "left_anti"
    )
    bin_ = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    rows = (
        scored.select(id_col, F.coalesce("lang", F.lit("")).alias("lang"), bin_)
        .join(free, id_col).groupBy("lang", "bin", "label").count().collect()
    )
    counts: dict[str, np.ndarray] = {}
    for row in rows:
        counts.setdefault(row["lang"], np.zeros((2, BINS)))[row["label"], row["bin"]] += row["count"]
    _set_thresholds(model, counts)


def classify(
    docs: DataFrame, model: TextCnn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """id, score, predicted (by ``threshold``) and flagged (by the language's own one).

    A language without labelled rows takes the threshold of all languages together. Repeated
    rows get equal answers; other columns are not looked at.
    """
    return decide(scores(docs, model, id_col, text_col, lang_col), model, id_col, threshold)


def decide(scored: DataFrame, model: TextCnn, id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``classify`` of rows that have their scores."""
    own = F.lit(model.general)
    for lang, value in sorted(model.thresholds.items()):
        own = F.when(F.coalesce(F.col("lang"), F.lit("")) == lang, F.lit(value)).otherwise(own)
    return scored.select(
        id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), (F.col("score") >= own).alias("flagged")
    )
