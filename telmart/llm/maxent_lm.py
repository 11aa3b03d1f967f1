"""Hashed maximum-entropy language model with a class-factored softmax.

Counts. Every training token is counted, per task first. Words at or above a count that at
most ``LOOKUP_WORDS`` words reach form the lookup table that tasks get; it has a size bound
whatever the corpus. All other words are looked up by a join.

Model. The most frequent words have classes of ``CLASS_WORDS`` each; all other words, known
or not, fall into classes by a hash of their last bytes. The next word's probability is
that of its class times that of the word in it. A class's, and a frequent word's, is a
softmax over sums of weights of the context's features: the word before, the two before,
and two skip features (second and third word before), each hashed to a row of the weight
tables. In the other classes words have their smoothed relative frequency, with one share
for all unknown words. So a text's probabilities are proper, and longer histories differ.

Training. In each round the tasks go through a part of the training documents with the
weights the driver sent and add up both halves of the gradient: how often each feature was
seen with each class or word, and how often the model expects it. The driver takes one step
from the sums over all tasks, that of generalised iterative scaling: a share, one over the
number of features of a token, of the logarithm of seen over expected, both smoothed. Sums
do not depend on how documents are dealt to tasks, so neither does the model. The rounds'
parts are disjoint, by a hash of the id, and together are all documents.

Scoring. Tasks score batches of sparse rows in numpy and hand on, per document, the words
that their table lacks; these are joined with the counts and added.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import fold, stored, summed_arrays, words

LOOKUP_WORDS = 1 << 17
LOOKUP_BYTES = 48  # longer words are always joined
CLASS_WORDS = 64
FREQUENT_CLASSES = 24
OTHER_CLASSES = 40
CLASSES = FREQUENT_CLASSES + OTHER_CLASSES
ROWS = 1 << 13  # of each weight table
ROUNDS = 3
FEATURES = 4  # of a token
SMOOTHING = 1.0  # added to what was seen and what was expected
BATCH = 1 << 13
HELD_OUT_FOLDS = 7
END = b"\n"  # never a word
_PARTS = 128  # pieces in which sums are added up
_BLOCK = 1 << 10  # tokens whose logits are worked on at once
_SHORT = 16  # rows of runs that are summed side by side
_TOGETHER = 32  # pieces whose features are counted at once
_COUNTED = 1 << 18  # distinct words a task holds before it hands them on
_READ = 1 << 16  # bytes of text that are cut into tokens at once


def other_class(word: bytes) -> int:
    """Class of a word that is not among the most frequent."""
    return FREQUENT_CLASSES + zlib.crc32(word[-2:]) % OTHER_CLASSES


def tokens(text: str | None) -> list[bytes]:
    return [*words(text), END]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, class, n) of all tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()

        def rows() -> pd.DataFrame:
            return pd.DataFrame(
                {"word": list(seen), "class": [other_class(w) for w in seen], "n": list(seen.values())}
            )

        for batch in batches:
            for text in batch["text"]:
                seen.update(tokens(text))
                if len(seen) > _COUNTED:
                    yield rows()
                    seen.clear()
        yield rows()

    partial = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "word binary, class int, n long")
    return partial.groupBy("word", "class").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The lookup table, most frequent first, and what is known of the other words' classes."""

    lookup: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    class_counts: np.ndarray  # tokens of each class's words that are not frequent
    class_words: np.ndarray

    @property
    def frequent(self) -> int:
        return min(len(self.lookup), FREQUENT_CLASSES * CLASS_WORDS)


def vocabulary(counts: DataFrame, lookup_words: int = LOOKUP_WORDS) -> Vocabulary:
    """The driver's share: totals, and at most ``lookup_words`` short words."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    short = counts.where(F.octet_length("word") <= LOOKUP_BYTES)
    # How many words have each count: far fewer rows than words, and summed from the top.
    least, reached = None, 0
    for row in short.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        reached += row["words"]
        if reached > lookup_words:
            break
        least = row["n"]
    found = short.where(F.col("n") >= least).select("word", "n").toPandas() if least is not None else pd.DataFrame({"word": [], "n": []})
    order = sorted(zip((-found["n"]).astype("int64"), map(bytes, found["word"])))
    lookup = [w for _, w in order]
    held = np.array([-n for n, _ in order], np.int64)
    class_counts, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        class_counts[row["class"]], class_words[row["class"]] = row["n"], row["words"]
    vocab = Vocabulary(lookup, held, total, distinct, class_counts, class_words)
    for k in range(vocab.frequent):
        class_counts[other_class(lookup[k])] -= held[k]
        class_words[other_class(lookup[k])] -= 1
    return vocab


def _hash(*parts: np.ndarray, salt: int) -> np.ndarray:
    value = np.full(len(parts[0]), salt, np.uint64)
    for part in parts:
        value = (value ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


class Words:
    """Numbers of words (byte strings, each once, of ``LOOKUP_BYTES`` at most), found for many words at once.

    An open hash table in arrays. A word is found only where all of its bytes are equal, eight at a
    time, so hashes that collide cost a step and change nothing.
    """

    _EIGHTS = LOOKUP_BYTES // 8
    _MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

    def __init__(self, words: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = b"".join(words)
        starts = np.cumsum(self.sizes) - self.sizes
        self.hashes, self.heads = self._hashes(data, starts, self.sizes)
        eights = self._eights(data)
        self.parts = np.stack([self._part(eights, starts, self.sizes, k) for k in range(self._EIGHTS)])
        bits = max(4, (4 * len(words)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(words)), self._slot(self.hashes)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            again = self.slots[slot] != left  # taken, by this round's last writer too
            left, slot = left[again], (slot[again] + 1) & self.mask

    @staticmethod
    def _eights(data: bytes) -> np.ndarray:
        """The eight bytes from every place on, as numbers."""
        padded = data + bytes(LOOKUP_BYTES + 8)
        return np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))

    @classmethod
    def _part(cls, eights: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
        return eights[np.minimum(starts + 8 * k, len(eights) - 1)] & cls._MASKS[np.clip(sizes - 8 * k, 0, 8)]

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> self.shift).astype(np.int64)

    @classmethod
    def _hashes(cls, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash and the first eight bytes of every word; of longer ones than any held, of its beginning."""
        eights, factor = cls._eights(data), np.uint64(0x9E3779B97F4A7C15)
        heads = cls._part(eights, starts, sizes, 0)
        hashes = (heads ^ sizes.astype(np.uint64)) * factor
        long = np.flatnonzero(sizes > 8)
        for k in range(1, cls._EIGHTS):
            if not len(long):
                break
            mixed = hashes[long]
            hashes[long] = (mixed ^ (mixed >> np.uint64(29)) ^ cls._part(eights, starts[long], sizes[long], k)) * factor
            long = long[sizes[long] > 8 * (k + 1)]
        hashes ^= hashes >> np.uint64(32)
        return hashes * factor, heads

    def find(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word of ``data``, -1 where there is none."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.sizes) or not len(starts):
            return out
        hashes, heads = self._hashes(data, starts, sizes)
        eights, slot = self._eights(data), self._slot(hashes)
        left = None  # all words, then those that have met only others
        while left is None or len(left):
            mine = slice(None) if left is None else left
            held = self.slots[slot[mine]]
            there = held >= 0
            equal = there & (self.heads[held] == heads[mine]) & (self.sizes[held] == sizes[mine])
            long = np.flatnonzero(equal & (sizes[mine] > 8))
            at = long if left is None else left[long]
            for k in range(1, self._EIGHTS):
                if not len(long):
                    break
                same = self.parts[k][held[long]] == self._part(eights, starts[at], sizes[at], k)
                equal[long[~same]] = False
                more = same & (sizes[at] > 8 * (k + 1))
                long, at = long[more], at[more]
            out[mine] = np.where(equal, held, -1)
            others = np.flatnonzero(there & ~equal)
            left = others if left is None else left[others]
            slot[left] = (slot[left] + 1) & self.mask
        return out


class Batcher:
    """Turns texts into outputs and context rows; words stand for themselves or their class."""

    _SPACE = np.isin(np.arange(256), [32, *range(9, 14)])

    def __init__(self, vocab: Vocabulary) -> None:
        self.size, self.frequent = len(vocab.lookup), vocab.frequent
        self.words = Words(vocab.lookup)
        # Classes of other words by their last two bytes, or by their only one.
        self.by_two = np.array([other_class(bytes((a, b))) for a in range(256) for b in range(256)])
        self.by_one = np.array([other_class(bytes((a,))) for a in range(256)])

    def other_classes(self, data: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``other_class`` of the words of ``data`` that end before ``ends``."""
        last = data[ends - 1]
        return np.where(sizes > 1, self.by_two[data[ends - 2] * np.int64(256) + last], self.by_one[last])

    def _numbered(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lookup number of every token (-1: not there), its symbol, and the places of those not there."""
        numbers = self.words.find(data, starts, sizes)
        symbols, missing = numbers.copy(), np.flatnonzero(numbers < 0)
        ends = starts[missing] + sizes[missing]
        symbols[missing] = self.size + self.other_classes(np.frombuffer(data, np.uint8), ends, sizes[missing])
        return numbers, symbols, missing

    def read(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Lookup number of every token (-1: not there), its symbol, and the words not there."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        numbers, symbols, missing = self._numbered(b"".join(found), np.cumsum(sizes) - sizes, sizes)
        return numbers, symbols, [found[k] for k in missing]

    def read_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """The same for the tokens of many texts: numbers, symbols, each text's first token, its words not there."""
        data = END.join(texts) + END  # behind each text its end, which is a token
        place = np.cumsum([len(t) + 1 for t in texts]) - 1
        raw = np.frombuffer(data, np.uint8)
        space = self._SPACE[raw]
        begins = ~space
        begins[1:] &= space[:-1]
        stops = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        begins[place] = True
        starts = np.flatnonzero(begins)
        word = ~space[starts]
        sizes = np.ones(len(starts), np.int64)
        sizes[word] = stops - starts[word]
        firsts = np.concatenate([[0], np.flatnonzero(~word)[:-1] + 1])
        numbers, symbols, missing = self._numbered(data, starts, sizes)
        at = starts[missing]
        lacking = [data[a:b] for a, b in zip(at.tolist(), (at + sizes[missing]).tolist())]
        cuts = [0, *np.searchsorted(missing, firsts[1:]).tolist(), len(lacking)]
        return numbers, symbols, firsts, [lacking[a:b] for a, b in zip(cuts, cuts[1:])]

    def contexts(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows of the features before every token, a column each."""
        before = []
        for back in (1, 2, 3):
            shifted = np.concatenate([np.full(back, 1 << 40), symbols[:-back]])[: len(symbols)]
            for k in range(back):
                shifted[starts[starts + k < len(symbols)] + k] = 1 << 40  # before the text
            before.append(shifted)
        one, two, three = before
        hashed = [_hash(one, salt=1), _hash(one, two, salt=2), _hash(two, salt=3), _hash(three, salt=4)]
        return np.stack([(h >> np.uint64(40)).astype(np.int64) % ROWS for h in hashed], axis=1)

    def classes(self, numbers: np.ndarray, symbols: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Class of every token; ``others`` holds the class of each lookup word beyond the frequent."""
        out = numbers // CLASS_WORDS
        rest = numbers >= self.frequent
        out[rest] = others[numbers[rest]]
        missing = numbers < 0
        out[missing] = symbols[missing] - self.size
        return out


def word_rows(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rows of the word table: a context feature together with the class."""
    mixed = rows.astype(np.uint64) * np.uint64(CLASSES) + classes[:, None].astype(np.uint64)
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % ROWS


@dataclass
class Weights:
    """Class and word tables (a row per hashed feature), and a bias for each class and word."""

    tables: list[np.ndarray]  # ROWS x CLASSES and ROWS x CLASS_WORDS
    class_bias: np.ndarray
    word_bias: np.ndarray

    @classmethod
    def start(cls, vocab: Vocabulary) -> Weights:
        """Biases begin at the logarithms of relative frequencies, the rest at zero."""
        frequent = np.zeros(FREQUENT_CLASSES * CLASS_WORDS)
        frequent[: vocab.frequent] = vocab.counts[: vocab.frequent]
        words = frequent.reshape(FREQUENT_CLASSES, CLASS_WORDS)
        classes = vocab.class_counts + 1.0
        classes[:FREQUENT_CLASSES] = words.sum(axis=1)
        with np.errstate(divide="ignore"):
            class_bias = np.log(classes / classes.sum()).astype(np.float32)
            word_bias = np.log(words / np.maximum(words.sum(axis=1, keepdims=True), 1)).astype(np.float32)
        empty = np.float32(-1e9)  # a class or place without words has probability zero
        return cls(
            [np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, CLASS_WORDS), np.float32)],
            np.where(np.isfinite(class_bias), class_bias, empty),
            np.where(np.isfinite(word_bias), word_bias, empty),
        )

    def moved(self, sums: np.ndarray) -> Weights:
        """The weights after a step, from what was seen and then what was expected, table after table."""
        seen, expected = np.split(sums.astype(np.float64), 2)
        step = np.log((seen + SMOOTHING) / (expected + SMOOTHING)) / FEATURES
        parts = np.split(step.astype(np.float32), [self.tables[0].size])
        tables = [t + p.reshape(t.shape) for t, p in zip(self.tables, parts)]
        return Weights(tables, self.class_bias, self.word_bias)


def _exponentials(table: np.ndarray, rows: np.ndarray, bias: np.ndarray, own: np.ndarray | None) -> Iterator[tuple]:
    """By blocks that fit the cache: place, logits, exponentials and their sums by row.

    ``bias`` is one row, or a table of which ``own`` names each token's row. Arrays are used
    again for the next block. Rows are only shifted to a maximum of 0 where a sum would leave
    the range of float32.
    """
    ones = np.ones(table.shape[1], np.float32)
    logits, powers = np.empty((2, min(_BLOCK, len(rows)), table.shape[1]), np.float32)
    for at in range(0, len(rows), _BLOCK):
        part = slice(at, min(at + _BLOCK, len(rows)))
        mine, other = logits[: part.stop - at], powers[: part.stop - at]
        np.take(table, rows[part, 0], axis=0, out=mine, mode="clip")
        for k in range(1, rows.shape[1]):
            mine += np.take(table, rows[part, k], axis=0, out=other, mode="clip")
        mine += bias if own is None else np.take(bias, own[part], axis=0, out=other, mode="clip")
        with np.errstate(over="ignore"):
            sums = np.exp(mine, out=other) @ ones
        if not (sums.min() > 1e-20 and sums.max() < 1e30):
            mine -= mine.max(axis=1, keepdims=True)
            sums = np.exp(mine, out=other) @ ones
        yield part, mine, other, sums


def _chances(table: np.ndarray, rows: np.ndarray, bias: np.ndarray, own: np.ndarray | None, target: np.ndarray) -> np.ndarray:
    """log10 of the targets' probabilities, 1e-30 at least."""
    out = np.empty(len(target))
    for part, logits, _, sums in _exponentials(table, rows, bias, own):
        out[part] = logits[np.arange(len(sums)), target[part]] - np.log(sums, dtype=np.float64)
    return np.maximum(out / math.log(10), -30)


class Scratch:
    """float32 arrays that are used again: page faults of new ones cost more than the work in them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def rows(self, name: str, count: int, width: int) -> np.ndarray:
        if name not in self.held or self.held[name].size < count * width:
            self.held[name] = np.empty(max(count, BATCH) * width, np.float32)
        return self.held[name][: count * width].reshape(count, width)


def _short_sums(rows: np.ndarray, places: np.ndarray, starts: np.ndarray, size: np.ndarray, total: np.ndarray, scratch: Scratch) -> None:
    """Sums of runs of ``rows[places]``, all at once, row by row; longest run first, none above ``_SHORT``."""
    np.take(rows, places[starts], axis=0, out=total, mode="clip")
    longer = np.searchsorted(-size, -np.arange(1, _SHORT))  # runs of more than 1, 2, ... rows
    for done, pending in enumerate(longer.tolist(), 1):
        if not pending:
            break
        more = scratch.rows("more", pending, rows.shape[1])
        total[:pending] += np.take(rows, places[starts[:pending] + done], axis=0, out=more, mode="clip")


def _add_runs(
    into: np.ndarray, targets: np.ndarray, rows: np.ndarray, places: np.ndarray, starts: np.ndarray, size: np.ndarray,
    scratch: Scratch, depth: int = 0,
) -> None:
    """Add the sum of each run of ``rows[places]`` to a row of ``into``, another one for every run.

    Long runs are cut into full pieces of ``_SHORT`` rows and a rest; sums of pieces are runs again.
    """
    full, rest = np.divmod(size, _SHORT)
    firsts, whole = np.cumsum(full) - full, int(full.sum())
    inside = np.arange(whole) - np.repeat(firsts, full)
    some = np.flatnonzero(rest)
    some = some[np.argsort(_SHORT - rest[some], kind="stable")]
    begin = np.concatenate([np.repeat(starts, full) + _SHORT * inside, starts[some] + _SHORT * full[some]])
    total = scratch.rows(f"total{depth}", len(begin), rows.shape[1])
    _short_sums(rows, places, begin, np.concatenate([np.full(whole, _SHORT), rest[some]]), total, scratch)
    into[targets[some]] += total[whole:]
    if whole:
        long = np.flatnonzero(full)
        _add_runs(into, targets[long], total, np.arange(whole), firsts[long], full[long], scratch, depth + 1)


class Sums:
    """Both halves of a table's gradient, added up over a task's tokens."""

    def __init__(self, table: np.ndarray) -> None:
        self.counts, self.expected = np.zeros(table.size), np.zeros(table.shape, np.float32)
        self.scratch, self.met = Scratch(), []

    def add(
        self, table: np.ndarray, rows: np.ndarray, bias: np.ndarray, own: np.ndarray | None, target: np.ndarray
    ) -> None:
        chances = self.scratch.rows("chances", len(rows), table.shape[1])
        for part, _, powers, sums in _exponentials(table, rows, bias, own):
            np.multiply(powers, (1 / sums)[:, None], out=chances[part])
        flat = rows.T.astype(np.uint16).ravel()  # sorted by radix; ROWS fits
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(ranked)) + 1])
        size = np.diff(np.append(starts, len(ranked)))
        places = np.tile(np.arange(len(rows), dtype=np.int32), rows.shape[1])[order]
        _add_runs(self.expected, ranked[starts], chances, places, starts, size, self.scratch)
        self.met.append((rows * table.shape[1] + target[:, None]).ravel())
        if len(self.met) >= _TOGETHER:
            self.seen()

    def seen(self) -> np.ndarray:
        """How often each feature was seen with each target; counted for many pieces at once."""
        if self.met:
            self.counts += np.bincount(np.concatenate(self.met), minlength=len(self.counts))
            self.met = []
        return self.counts


class Task:
    """What a task needs besides its documents: the vocabulary, and derived tables."""

    def __init__(self, vocab: Vocabulary, weights: Weights) -> None:
        self.vocab, self.weights = vocab, weights
        self.batcher = Batcher(vocab)
        ends = np.cumsum(self.batcher.words.sizes)
        self.others = self.batcher.other_classes(
            np.frombuffer(b"".join(vocab.lookup), np.uint8), ends, self.batcher.words.sizes
        )
        self.log_counts = np.log10(vocab.counts + 1.0)
        self.log_shares = np.log10(vocab.class_counts + vocab.class_words + 1.0)

    def batches(self, texts) -> Iterator[tuple]:
        """Per batch of about ``_READ`` bytes or one text: numbers, symbols, starts, words not there."""
        held, size = [], 0
        for text in texts:
            held.append(text.encode().lower() if text else b"")
            size += len(held[-1])
            if size >= _READ or len(held) >= BATCH:
                yield self.batcher.read_texts(held)
                held, size = [], 0
        if held:
            yield self.batcher.read_texts(held)

    def pieces(self, numbers, symbols, starts) -> Iterator[tuple]:
        """Contexts and classes of a batch, in equal pieces of about ``BATCH`` tokens."""
        contexts = self.batcher.contexts(symbols, starts)
        classes = self.batcher.classes(numbers, symbols, self.others)
        cuts = np.linspace(0, len(numbers), max(1, round(len(numbers) / BATCH)) + 1).astype(int)
        for at, end in zip(cuts, cuts[1:]):
            part = slice(at, end)
            yield part, contexts[part], classes[part]

    def learn(self, texts) -> np.ndarray | None:
        """What was seen and then what was expected, table after table, in a pass over the texts."""
        tables = self.weights.tables
        sums, read = [Sums(t) for t in tables], 0
        for numbers, symbols, starts, _ in self.batches(texts):
            for part, contexts, classes in self.pieces(numbers, symbols, starts):
                sums[0].add(tables[0], contexts, self.weights.class_bias, None, classes)
                inside = np.flatnonzero(classes < FREQUENT_CLASSES)
                if len(inside):
                    own = classes[inside]
                    place = numbers[part][inside] % CLASS_WORDS
                    sums[1].add(tables[1], word_rows(contexts[inside], own), self.weights.word_bias, own, place)
                read += len(classes)
        parts = [*(s.seen().astype(np.float32) for s in sums), *(s.expected.ravel() for s in sums)]
        return np.concatenate(parts) if read else None

    def logs(self, numbers, symbols, starts) -> np.ndarray:
        """log10 probability of every token; for words not there, log10(count + 1) is lacking."""
        tables = self.weights.tables
        out = np.empty(len(numbers))
        for part, contexts, classes in self.pieces(numbers, symbols, starts):
            log = _chances(tables[0], contexts, self.weights.class_bias, None, classes)
            inside = np.flatnonzero(classes < FREQUENT_CLASSES)
            own = classes[inside]
            place = numbers[part][inside] % CLASS_WORDS
            log[inside] += _chances(tables[1], word_rows(contexts[inside], own), self.weights.word_bias, own, place)
            outside = np.flatnonzero(classes >= FREQUENT_CLASSES)
            log[outside] -= self.log_shares[classes[outside]]
            known = outside[numbers[part][outside] >= 0]
            log[known] += self.log_counts[numbers[part][known]]
            out[part] = log
        return out

    def score(self, texts) -> Iterator[tuple]:
        """Per text: tokens, those in the lookup table, base and model sums, and the words not there.

        The sums lack log10(count + 1) of words not there, and nothing else.
        """
        base_share = math.log10(self.vocab.total + self.vocab.distinct + 1)
        for numbers, symbols, starts, lacking in self.batches(texts):
            there, base = numbers >= 0, np.zeros(len(numbers))
            base[there] = self.log_counts[numbers[there]]
            logs = self.logs(numbers, symbols, starts)
            sums = [np.add.reduceat(v, starts) for v in (there.astype(np.int64), base - base_share, logs)]
            yield from zip(np.diff(np.append(starts, len(numbers))), *sums, lacking)


@dataclass
class Model:
    vocab: Vocabulary
    weights: Weights
    counts: DataFrame


def _plain(vocab: Vocabulary, weights: Weights) -> tuple:
    """Only lists, numbers and arrays: a broadcast is read by workers that lack this package."""
    return tuple(vars(vocab).values()), tuple(vars(weights).values())


def _task(sent: tuple) -> Task:
    return Task(Vocabulary(*sent[0]), Weights(*sent[1]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
        lookup_words: int = LOOKUP_WORDS) -> Model:
    """Count all tokens of ``docs``, then train on all of them once, a part in each round."""
    spark = docs.sparkSession
    counts = stored(word_counts(docs, text_col), "counts")
    vocab = vocabulary(counts, lookup_words)
    weights = Weights.start(vocab)
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(_plain(vocab, weights))

        def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = _task(sent.value).learn(t for batch in batches for t in batch["text"])
            if sums is not None:
                yield pd.DataFrame({"part": range(_PARTS), "values": [p.tobytes() for p in np.split(sums, _PARTS)]})

        part = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(rounds)) == number)
        partial = part.select(F.col(text_col).alias("text")).mapInPandas(learn, "part int, values binary")
        sums = summed_arrays(partial, "f4", "f8")
        if len(sums):
            weights = weights.moved(sums)
        sent.unpersist()
    return Model(vocab, weights, counts)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Null text has one token, the end. With nothing learned every score is that of an empty
    corpus. Repeated rows get equal answers; other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_plain(model.vocab, model.weights))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = _task(sent.value)
        for batch in batches:
            found = list(task.score(batch["text"]))
            yield pd.DataFrame(found, columns=["n_tokens", "n_known", "base", "logs", "lacking"]).assign(id=batch["id"].to_numpy())

    # Ids are text on their way through pandas, which has no integers beside nulls.
    partial = stored(
        docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
        .mapInPandas(rows, "id string, n_tokens long, n_known long, base double, logs double, lacking array<binary>")
        .withColumn("row", F.monotonically_increasing_id()),
        "partial",
    )
    lacking = partial.select("row", F.explode("lacking").alias("word")).groupBy("row", "word").count()
    joined = (
        lacking.join(model.counts.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum("count").alias("more"), F.sum(F.col("count") * F.log10(F.col("n") + 1.0)).alias("logs_more"))
    )
    more, zero = F.coalesce("logs_more", F.lit(0.0)), F.lit(0)
    return partial.join(joined, "row", "left").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(model.vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("logs") + more).alias("score"),
    )


def learnable_docs(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that the model may learn from; a row without id is never used."""
    return docs.where(F.coalesce(fold(id_col, HELD_OUT_FOLDS) != 2, F.lit(False)))
