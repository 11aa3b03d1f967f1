"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is the product (binding) of its
letters' vectors, each permuted by its place; a text is the sum (bundle) of its n-grams,
and a language the sum of its documents' unit vectors, less what all languages share. A
document takes the language whose prototype has the largest cosine with it.

Letters are case-folded to 64 slots: the space between words, a to z, and 37 slots that
other letters share by a fixed hash; anything else counts as a space. So vectors exist for
every script, and the model's size is fixed: no table grows with the data.

Whole texts are read; a text enters as counts of its n-grams, in pieces of bounded size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import bounded_sample, free_name, learnable

DIMENSIONS = 1024
SLOTS = 64
SAMPLE_ROWS = 8_000  # labelled documents that prototypes are learned from, at most about
UNKNOWN = "und"
SEED = 20_240_601
_PIECE = 1 << 20  # characters counted at once
_SHORT = 1 << 15  # characters up to which trigrams are sorted


def _slot_table() -> np.ndarray:
    """Slot of every code point: 0 for a separator."""
    code = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    letter = np.char.isalpha(code.view("<U1"))
    wide = code.astype(np.int64)
    slot = np.where((97 <= wide) & (wide < 123), wide - 96, 27 + (wide * 2654435761 >> 7) % (SLOTS - 27))
    return np.where(letter, slot, 0).astype(np.uint8)


class Encoder:
    """Turns texts into unit vectors; the same in every task, as its vectors have a seed."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SLOTS, dimensions))
        self.slots = _slot_table()
        self.third = letters
        second, first = np.roll(letters, 1, axis=1), np.roll(letters, 2, axis=1)
        self.pairs = (first[:, None, :] * second[None, :, :]).reshape(SLOTS * SLOTS, dimensions)
        self.dimensions = dimensions

    def counts(self, text: str) -> np.ndarray:
        """How often each trigram of slots occurs; trigrams of separators alone don't count."""
        total = np.zeros(SLOTS**3, np.int64)
        text = text.lower()
        for start in range(0, len(text), _PIECE):
            part = text[max(0, start - 2) : start + _PIECE]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            slots = self.slots[codes].astype(np.int64)
            if start == 0:
                slots = np.concatenate([[0], slots])
            if start + _PIECE >= len(text):
                slots = np.concatenate([slots, [0]])
            grams = (slots[:-2] * SLOTS + slots[1:-1]) * SLOTS + slots[2:]
            total += np.bincount(grams, minlength=SLOTS**3)
        total[0] = 0
        return total

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The trigrams of a text and their counts, as ``counts`` has them.

        A table of all trigrams costs more than a short text does; that one is sorted.
        """
        if len(text) > _SHORT:
            counts = self.counts(text)
            found = np.flatnonzero(counts)
            return found, counts[found]
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        slots = np.zeros(len(codes) + 2, np.int32)
        slots[1:-1] = self.slots[codes]
        found, counts = np.unique((slots[:-2] * SLOTS + slots[1:-1]) * SLOTS + slots[2:], return_counts=True)
        return (found[1:], counts[1:]) if len(found) and not found[0] else (found, counts)

    def vector(self, text: str | None) -> np.ndarray | None:
        """The text's unit vector; None without a letter."""
        if not text:
            return None
        grams, counts = self.grams(text)
        if not len(grams):
            return None
        total = np.zeros(self.dimensions, np.float32)
        for start in range(0, len(grams), 4096):
            part = grams[start : start + 4096]
            bound = self.pairs[part // SLOTS] * self.third[part % SLOTS]
            weight = np.sqrt(counts[start : start + 4096]).astype(np.float32)
            total += weight @ bound.astype(np.float32)
        norm = np.linalg.norm(total)
        return total / norm if norm else None


@dataclass
class Profiles:
    """Unit prototypes of the languages, and what all of them share."""

    languages: list[str]
    shared: np.ndarray
    prototypes: np.ndarray

    def predict(self, vector: np.ndarray | None) -> tuple[str, float]:
        if vector is None or not self.languages:
            return UNKNOWN, 0.0
        rest = vector - self.shared
        norm = np.linalg.norm(rest)
        cosines = self.prototypes @ rest / norm if norm else np.zeros(len(self.languages))
        best = int(np.argmax(cosines))
        return self.languages[best], float(min(1.0, max(0.0, (1 + cosines[best]) / 2)))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Learn prototypes from rows with a language; each task sends one sum per language.

    Rows beyond ``sample_rows`` are thinned by a hash of their id.
    """
    sample = bounded_sample(docs.where(F.col(lang_col).isNotNull()), id_col, sample_rows)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, total = Encoder(), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                vector = encoder.vector(text)
                if vector is not None:
                    count, old = total.get(lang, (0, 0.0))
                    total[lang] = (count + 1, old + vector.astype(np.float64))
        rows = [(k, n, v.tolist()) for k, (n, v) in total.items()]
        yield pd.DataFrame(rows, columns=["lang", "n", "total"])

    # One row a task and language, so at most sample_rows rows reach the driver.
    partial = (
        sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .mapInPandas(sums, "lang string, n long, total array<double>")
        .collect()
    )
    total: dict[str, np.ndarray] = {}
    for row in sorted(partial, key=lambda r: (r["lang"], r["total"])):
        total[row["lang"]] = total.get(row["lang"], 0.0) + np.array(row["total"])
    languages = sorted(total)
    if not languages:
        return Profiles([], np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)))
    units = np.array([total[k] / max(np.linalg.norm(total[k]), 1e-12) for k in languages])
    shared = units.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS)
    rest = units - shared
    return Profiles(languages, shared, rest / np.maximum(np.linalg.norm(rest, axis=1, keepdims=True), 1e-12))


def language(text: Column, profiles: Profiles) -> Column:
    """struct(lang_pred, score, has_letter) of a text column."""

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder()
        for texts in batches:
            vectors = [encoder.vector(t) for t in texts]
            # A sum of vectors could cancel out, so None doesn't yet say that there is no letter.
            letters = [v is not None or bool(len(encoder.grams(t or "")[0])) for v, t in zip(vectors, texts)]
            found = [(*profiles.predict(v), letter) for v, letter in zip(vectors, letters)]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "has_letter"])

    return F.pandas_udf(predict, "lang_pred string, score double, has_letter boolean")(text)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row.

    ``und`` and 0 for a null text or one without a letter, and where nothing was learned.
    Equal cosines go to the language first in code-point order. Only the text is an input;
    repeated rows get equal answers, and other columns are not looked at.
    """
    found = docs.select(
        docs[f"`{id_col}`"].alias("id"), language(docs[f"`{text_col}`"], profiles).alias("answer")
    )
    return found.select(F.col("id").alias(id_col), "answer.lang_pred", "answer.score")


def fit_learnable(docs: DataFrame) -> Profiles:
    """Prototypes from the documents outside the held-out fold."""
    return fit(docs.where(learnable()))


def with_language(
    docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``docs`` with the predicted language in ``lang_col``, without texts that have none.

    The prediction replaces what was there, so a document whose label is missing or wrong
    gets the language of its text. Null texts and texts without a letter go; where nothing was
    learned, the others stay as ``und``. All columns keep their names and places.
    """
    answer = free_name(docs, "answer")
    found = docs.withColumn(answer, language(docs[f"`{text_col}`"], profiles))
    kept = found.where(found[answer].getField("has_letter"))
    return kept.select(
        *[
            kept[answer].getField("lang_pred").alias(c) if c == lang_col else kept["`" + c.replace("`", "``") + "`"]
            for c in docs.columns
        ]
    )
