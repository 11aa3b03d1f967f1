"""Spelling variants: words within one edit of each other, found through a reduced alphabet.

Letters are hashed to a few symbols, so words become reduced words. Two words within one
edit have reduced words that are equal or within one edit. So the full one-edit
neighbourhood of every reduced word is generated (itself, deletions, replacements,
insertions), joined with the reduced vocabulary, and each meeting is verified on the
original strings.

What keeps it whole and bounded: neighbourhoods are made from distinct reduced words, as
64-bit rolling hashes, so a neighbour costs one addition and not a string; a bitmap of the
reduced vocabulary (fixed size) drops most neighbours that no word has before they are
shuffled; a collision only adds a pair that verification refuses. The number of symbols
follows the vocabulary. Reduced words shared by more than ``CROWD`` words are no pair of
crowds: their words go through the same steps with every letter a symbol of its own, where
no two words share a reduced word.

Null texts and texts without such runs give no word, a null id counts as an empty one, and
repeated rows count again. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from telmart.llm.common import bitmap, in_bitmap, stored

LEAST_CHARS = 6
LEAST_COUNT = 5
DIVISOR = 199
RATIO = 5
CROWD = 64  # words of one reduced word
LEAST_SYMBOLS = 4
BITMAP_BITS = 1 << 26  # 8 MB, whatever the vocabulary
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIRST_SYMBOL = 0x21  # symbols are characters from here on
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_AT_ONCE = 1 << 20  # neighbours held at a time


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    divisor: int = DIVISOR,
) -> DataFrame:
    """(word, n): runs of letters, lower-cased, counted, one code point less where the hash says so.

    A run loses code point h % length if ``divisor`` divides h, the crc32 of id, colon and
    run. Occurrences are counted per task before they are shuffled by word.
    """
    text = F.translate(F.col(f"`{text_col}`"), _UPPER, _LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))
    found = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.char_length("run")).cast("int")
    rest = F.col("run").substr(at + 2, F.char_length("run"))
    word = F.when(h % divisor == 0, F.concat(F.left("run", at), rest)).otherwise(F.col("run"))
    words = found.select(word.alias("word")).where(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def symbols_of(words: DataFrame) -> dict[str, str]:
    """Letter to symbol, so that symbols are about equally frequent.

    There are as many symbols as it takes for fewer words than reduced words at every
    length. At most as many letters as runs may hold come to the driver.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    lengths = words.groupBy(F.char_length("word").alias("chars")).count()
    needed = lengths.agg(F.max(F.pow(4.0 * F.col("count"), 1 / F.col("chars")))).first()[0] or 0
    many = min(len(letters), max(LEAST_SYMBOLS, math.ceil(needed)))
    load = [0] * many
    chosen = {}
    for letter, count in sorted(letters, key=lambda row: (-row[1], row[0])):
        symbol = load.index(min(load))
        chosen[letter] = chr(_FIRST_SYMBOL + symbol)
        load[symbol] += count
    return chosen


def own_symbols(words: DataFrame) -> dict[str, str]:
    """Every letter that occurs with a symbol of its own."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect()
    return {row[0]: chr(_FIRST_SYMBOL + k) for k, row in enumerate(sorted(letters))}


def reduced(word: Column, symbols: dict[str, str]) -> Column:
    """The word with every letter replaced by its symbol."""
    return F.translate(word, "".join(symbols), "".join(symbols.values())) if symbols else word


def _codes(symbols: int) -> np.ndarray:
    """A 64-bit code per symbol."""
    state = (np.arange(symbols, dtype=np.uint64) + np.uint64(1)) * np.uint64(_BASE)
    state ^= state >> np.uint64(31)
    state *= np.uint64(0xBF58476D1CE4E5B9)
    return state ^ (state >> np.uint64(29))


def _powers(length: int) -> np.ndarray:
    factors = np.full(length + 1, _BASE, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _by_length(words: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and symbols (a row a word) of the words of each length, a bounded number at a time."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, _AT_ONCE // (256 * max(1, int(length))))
        for start in range(0, len(places), step):
            part = places[start : start + step]
            text = "".join(words.iloc[part]).encode("utf-16-le")
            letters = np.frombuffer(text, np.uint16).reshape(len(part), int(length))
            yield part, letters.astype(np.int64) - _FIRST_SYMBOL


def _hashed(terms: np.ndarray, length: int) -> np.ndarray:
    """Spread sums over all bits, lengths apart."""
    mixed = terms + np.uint64((length * 0xD6E8FEB86659FD93) % (1 << 64))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def word_keys(symbols: int) -> Callable[[pd.Series], pd.Series]:
    """Hash of reduced words of so many symbols."""

    def keys(words: pd.Series) -> pd.Series:
        codes, out = _codes(symbols), np.zeros(len(words), np.uint64)
        for places, letters in _by_length(words):
            length = letters.shape[1]
            out[places] = _hashed((codes[letters] * _powers(length)[:length]).sum(axis=1, dtype=np.uint64), length)
        return pd.Series(out.view(np.int64))

    return keys


def neighbourhoods(letters: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of all words within one edit of each row, the row's own word included.

    A word is the sum of its symbols' codes times powers of a base, so an edit changes a
    prefix sum, one term and a shifted suffix sum. Edits that give the same word are met once.
    """
    rows, length = letters.shape
    power, every = _powers(length + 1), np.arange(rows)
    terms = codes[letters] * power[:length]
    before = np.concatenate([np.zeros((rows, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    total = before[:, -1]
    yield every, _hashed(total, length)
    for at in range(length):
        after = total - before[:, at + 1]
        first_of_run = every if not at else np.flatnonzero(letters[:, at] != letters[:, at - 1])
        shorter = before[:, at] + after * np.uint64(_BASE_INVERSE)
        yield first_of_run, _hashed(shorter[first_of_run], length - 1)
        rest = total - terms[:, at]
        for symbol, term in enumerate(codes * power[at : at + 1]):
            other = np.flatnonzero(letters[:, at] != symbol)
            yield other, _hashed((rest + term)[other], length)
    for at in range(length + 1):
        longer = before[:, at] + (total - before[:, at]) * np.uint64(_BASE)
        for symbol, term in enumerate(codes * power[at : at + 1]):
            # In front of an equal symbol it would give the same word as behind it.
            new = every if at == length else np.flatnonzero(letters[:, at] != symbol)
            yield new, _hashed((longer + term)[new], length + 1)


def _neighbours(symbols: int, held: np.ndarray) -> Callable:
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = _codes(symbols)
        for batch in batches:
            keys = batch["key"].to_numpy()
            for places, letters in _by_length(batch["reduced"]):
                sources, found = [], []
                for rows, hashes in neighbourhoods(letters, codes):
                    there = in_bitmap(held, hashes)
                    sources.append(keys[places[rows[there]]])
                    found.append(hashes[there].view(np.int64))
                yield pd.DataFrame({"source": np.concatenate(sources), "key": np.concatenate(found)})

    return make


def _reduced_words(words: DataFrame, symbols: dict[str, str]) -> DataFrame:
    key = F.pandas_udf(word_keys(len(set(symbols.values()))), LongType())
    with_reduced = words.withColumn("reduced", reduced(F.col("word"), symbols))
    return stored(with_reduced.withColumn("key", key("reduced")), "reduced")


def _pairs(sources: DataFrame, table: DataFrame, symbols: dict[str, str], bits: int) -> DataFrame:
    """Pairs (word, n, near, near_n) one edit apart, word from ``sources``, near from ``table``."""
    make = _neighbours(len(set(symbols.values())), bitmap(table.select("key"), bits))
    distinct = sources.select("key", "reduced").distinct()
    links = distinct.mapInPandas(make, "source long, key long")
    near = table.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    ones = sources.select(F.col("key").alias("source"), "word", "n")
    met = links.join(near, "key").join(ones, "source")
    # Words differ, so a distance of at most one is one edit.
    apart = (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    return met.where(apart).select("word", "n", "near", "near_n")


def near_words(words: DataFrame, crowd: int = CROWD, bits: int = BITMAP_BITS) -> DataFrame:
    """All ordered pairs (word, n, near, near_n) of words one edit apart; ``words`` has word, n."""
    symbols = symbols_of(words)
    table = _reduced_words(words, symbols)
    crowded = table.groupBy("reduced").count().where(F.col("count") > crowd).select("reduced")
    if crowded.isEmpty():
        pairs = _pairs(table, table, symbols, bits)
    else:
        crowded = stored(crowded, "crowded")
        few = stored(table.join(crowded, "reduced", "left_anti").select(*table.columns), "few")
        each = own_symbols(words)
        whole = _reduced_words(words, each)
        # Two words never share a reduced word here, so crowds cost their own neighbourhoods only.
        many = table.join(crowded, "reduced", "left_semi").select("word")
        of_crowds = stored(_pairs(stored(whole.join(many, "word", "left_semi"), "many"), whole, each, bits), "crowds")
        turned = of_crowds.select(
            F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
        )
        pairs = _pairs(few, few, symbols, bits).unionByName(of_crowds).unionByName(turned)
    return pairs.repartition("word").distinct()


def variant_groups(
    words: DataFrame, ratio: int = RATIO, crowd: int = CROWD, bits: int = BITMAP_BITS
) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    The form is the near word of largest n, the first in code-point order of equals, if it
    is at least ``ratio`` times as frequent; the root is where following forms ends.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could run in circles")
    words = stored(words, "words")
    pairs = near_words(words, crowd, bits)
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
    )
    answers = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.form")).alias("form"),
            F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # Counts grow by the ratio at every step, which bounds a chain's length; steps are doubled.
    bounds = answers.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    steps = math.log(bounds["most"] / bounds["least"], ratio) if bounds["least"] and ratio > 1 else 0
    links = answers.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links = stored(
            links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots"
        )
    return answers.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
