"""Collocations: phrases whose parts occur together more often than alone.

Counts of all phrases of up to five words come from a depth-truncated suffix trie that is
built in parts, by vertical partitioning:

1. Words are counted, and get 64-bit ids that are checked to be unique. A phrase cannot be
   frequent if one of its words is not, so other words end the suffixes that run into them.
   Nor can it be if two neighbours in it are not frequent together: pairs are counted by a hash
   in an array of fixed size, and a pair whose slot stays below the limit ends a suffix, too.
2. Word prefixes with more suffixes than the memory budget are extended by a word, a
   scan per level, until every prefix left is within the budget; a prefix of full depth is a leaf
   and needs no more than its count. Prefixes within the budget are packed into groups up
   to the budget.
3. One scan routes every suffix, cut to five words, to the group of its prefix. A group
   fits in memory; its task sorts the suffixes, which lays out the subtree, and reads the count
   of every inner node from the total of the leaves below it.

Prefixes, frequent words and pairs travel as bitmaps of fixed size. They let a few too many pass, which
costs work and changes nothing: what is extended is counted level by level, what is
infrequent falls to the exact limit at the end. A passage that repeats any number of times
exceeds the budget, is extended to full depth and so never gathers in one group.

Per language (null: ``und``), a phrase is scored by its weakest cut, and phrases that lie
inside a longer one about as frequent are dropped. Null texts count as empty, repeated rows
count again, an empty table gives no rows; ids and other columns are not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telmart.llm.common import bitmap, in_bitmap, stored, summed_arrays

DEPTH = 5
LEAST = 100
TOP = 2000
SCALE = 1000
CONTAINED = 100  # per cent of a phrase's occurrences inside a longer one that make it redundant
NO_LANGUAGE = "und"
BUDGET = 1 << 20  # suffixes of a group
BINS = 1 << 14  # what packing moves; a group has one at least
WORD_BITS = 1 << 26
PREFIX_BITS = 1 << 24
PAIR_SLOTS = 1 << 22  # counters of neighbours
ID_BITS = 62
_BLOCK_WORDS = 1 << 20
_BLOCK_VOCABULARY = 1 << 19
_TO_BREAK = bytes.maketrans(b".,;:!?\x0b\x0c\x0d", b"\n" * 9)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PAIR_PARTS = 64  # pieces in which the counters are added up
_KEY = "key array<long>, n long"


class _Numbers(dict):
    """Numbers words from ``names``' length on, in the order in which they are met."""

    def __init__(self, lang: str, names: list) -> None:
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        number = self[word] = len(self.names)
        return number


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, list[tuple[str, bytes]]]]:
    """Word numbers of whole pieces, 0 after each, and the (lang, word) of numbers 1, 2, ..."""
    seq, names, by_lang = array("I"), [], {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if not text:
                continue
            if lang not in by_lang:
                by_lang[lang] = _Numbers(lang, names)
            for piece in text.encode().lower().translate(_TO_BREAK).split(b"\n"):
                words = piece.split()
                if words:
                    seq.extend(map(by_lang[lang].__getitem__, words))
                    seq.append(0)
                    if len(seq) >= _BLOCK_WORDS or len(names) >= _BLOCK_VOCABULARY:
                        yield np.frombuffer(seq, np.uint32), names
                        seq, names, by_lang = array("I"), [], {}
                        by_lang[lang] = _Numbers(lang, names)
    if len(seq):
        yield np.frombuffer(seq, np.uint32), names


def _ids(names: list[tuple[str, bytes]], seed: int, id_bits: int) -> np.ndarray:
    """Id of each number; 0 stays that of a break."""
    mask, of = (1 << id_bits) - 1, xxhash.xxh64_intdigest
    ids = [(of(b"%b\0%b" % (lang.encode(), word), seed) & mask) or 1 for lang, word in names]
    return np.array([0, *ids], np.int64)


def _word_counter(seed: int, id_bits: int) -> Callable:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for seq, names in _blocks(batches):
            counts = np.bincount(seq, minlength=len(names) + 1)
            yield pd.DataFrame(
                {
                    "id": _ids(names, seed, id_bits)[1:],
                    "lang": [lang for lang, _ in names],
                    "word": [word.decode() for _, word in names],
                    "n": counts[1:],
                }
            )

    return count


def _sources(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
    )


def counted_words(sources: DataFrame, id_bits: int = ID_BITS) -> tuple[DataFrame, int]:
    """(id, lang, word, n) of all words, and the seed under which no two words share an id."""
    seed = 0
    while True:
        partial = sources.mapInPandas(_word_counter(seed, id_bits), "id long, lang string, word string, n long")
        words = stored(partial.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("id").count().where(F.col("count") > 1).isEmpty():
            return words, seed
        seed += 1


def _mixed(prefix: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Hash of a prefix extended by a word."""
    x = (prefix.view(np.uint64) ^ (prefix.view(np.uint64) >> np.uint64(29))) * _MIX + ids.view(np.uint64)
    x ^= x >> np.uint64(32)
    return (x * _MIX).view(np.int64)


class _Plan:
    """What tasks need to route a suffix: bitmaps of each level, and the group of each bin.

    ``frequent[k]`` and ``extended[k]`` hold prefixes of k + 1 words, ``pairs`` neighbours.
    """

    def __init__(self, seed: int, id_bits: int, frequent: list, extended: list) -> None:
        self.seed, self.id_bits = seed, id_bits
        self.frequent, self.extended = frequent, extended
        self.pairs = self.group_of_bin = None

    def suffixes(self, seq: np.ndarray, names: list, depths: int = DEPTH) -> tuple[list[np.ndarray], np.ndarray]:
        """Columns of word numbers, one per depth, 0 from the first break or infrequent word on."""
        ids = _ids(names, self.seed, self.id_bits)
        known = in_bitmap(self.frequent[0], ids)
        known[0] = False
        first = np.where(known[seq], seq, 0).astype(np.uint32)
        goes_on = np.append(first[1:] > 0, False) & (first > 0)
        if self.pairs is not None:  # else they are being counted
            at = np.flatnonzero(goes_on)
            goes_on[at] = in_bitmap(self.pairs, _mixed(ids[first[at]], ids[first[at + 1]]))
        columns = [first]
        for depth in range(1, depths):
            column = np.zeros_like(first)
            column[:-depth] = np.where(goes_on[depth - 1 : -1], first[depth:], 0)
            column[columns[-1] == 0] = 0
            columns.append(column)
        return columns, ids

    def descend(self, columns: list[np.ndarray], ids: np.ndarray, levels: int):
        """Follow extended prefixes for ``levels`` words at most.

        Yields (depth, places, prefix hashes, extended) for the suffixes that have a frequent
        prefix of that depth, all prefixes above extended.
        """
        places = np.flatnonzero(columns[0])
        prefix = ids[columns[0][places]]
        for level in range(levels):
            if level:
                words = columns[level][places]
                places, prefix, words = places[words > 0], prefix[words > 0], words[words > 0]
                prefix = _mixed(prefix, ids[words])
                if level < len(self.frequent):
                    known = in_bitmap(self.frequent[level], prefix)
                    places, prefix = places[known], prefix[known]
            more = np.zeros(len(places), bool)
            if level < len(self.extended):
                more = in_bitmap(self.extended[level], prefix)
            yield level + 1, places, prefix, more
            places, prefix = places[more], prefix[more]


def _distinct_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of one row of each kind, and how many there are of it."""
    order = np.lexsort(columns[::-1])
    change = np.zeros(len(order), bool)
    change[:1] = True
    for column in columns:
        change[1:] |= column[order[1:]] != column[order[:-1]]
    starts = np.flatnonzero(change)
    return order[starts], np.diff(np.append(starts, len(order)))


def _prefix_rows(plan: _Plan, columns: list[np.ndarray], ids: np.ndarray, depth: int) -> Iterator[pd.DataFrame]:
    for level, places, prefix, _ in plan.descend(columns, ids, depth):
        if level == depth and len(places):
            words = [column[places] for column in columns[:depth]]
            one, n = _distinct_rows(words)
            keys = np.stack([ids[w[one]] for w in words], axis=1)
            yield pd.DataFrame({"key": pd.Series(list(keys), dtype=object), "prefix": prefix[one], "n": n})


def _prefix_counter(plan: _Plan, depth: int) -> Callable:
    """Counts prefixes of ``depth`` words whose shorter prefixes are all extended."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for seq, names in _blocks(batches):
            yield from _prefix_rows(plan, *plan.suffixes(seq, names, depth), depth)

    return count


def _pair_counter(plan: _Plan, least: int, slots: int) -> Callable:
    """Counters of neighbours, by a hash of both; they stop at ``least``, which is all they are asked about."""
    kind = np.uint8 if least < 1 << 8 else np.uint32

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(slots, np.uint32)
        for seq, names in _blocks(batches):
            columns, ids = plan.suffixes(seq, names, 2)
            at = np.flatnonzero(columns[1])
            pairs = _mixed(ids[columns[0][at]], ids[columns[1][at]])
            counters += np.bincount(pairs & (slots - 1), minlength=slots).astype(np.uint32)
            np.minimum(counters, least, out=counters)
        pieces = np.split(counters.astype(kind), _PAIR_PARTS)
        yield pd.DataFrame({"part": range(_PAIR_PARTS), "values": [p.tobytes() for p in pieces]})

    return count


def frequent_pairs(sources: DataFrame, plan: _Plan, least: int, slots: int = PAIR_SLOTS) -> np.ndarray:
    """Bitmap of the counters that reach ``least``: every pair that does is in it."""
    counters = sources.mapInPandas(_pair_counter(plan, least, slots), "part int, values binary")
    return summed_arrays(
        counters, "u1" if least < 1 << 8 else "u4", "u8", lambda n: np.packbits(n >= least, bitorder="little")
    )


def _router(plan: _Plan) -> Callable:
    """Deals suffixes to groups: per block and group one row of packed columns."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for seq, names in _blocks(batches):
            columns, ids = plan.suffixes(seq, names)
            found, groups, depths = [], [], []
            for depth, places, prefix, more in plan.descend(columns, ids, len(plan.frequent)):
                # The prefix itself is counted; only suffixes that go on below it matter.
                if depth < DEPTH:
                    stay = ~more & (columns[depth][places] > 0)
                    found.append(places[stay])
                    groups.append(plan.group_of_bin[prefix[stay] & (len(plan.group_of_bin) - 1)])
                    depths.append(np.full(len(found[-1]), depth, np.uint8))
            places, group, depth = map(np.concatenate, (found, groups, depths))
            order = np.argsort(group, kind="stable")
            group = group[order]
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            packed = [_packed(columns, ids, places[part], depth[part]) for part in np.split(order, starts[1:])]
            if len(order):
                yield pd.DataFrame({"group": group[starts], **{c: [p[c] for p in packed] for c in packed[0]}})

    return route


def _packed(columns: list[np.ndarray], ids: np.ndarray, places: np.ndarray, depth: np.ndarray) -> dict[str, bytes]:
    """Suffixes as numbers into a list of the ids they use; 0 stays 0."""
    words = np.stack([column[places] for column in columns])
    used = np.zeros(len(ids), bool)
    used[words] = True
    used[0] = False
    mine = np.flatnonzero(used)
    number = np.zeros(len(ids), np.uint16 if len(mine) < 1 << 16 else np.uint32)
    number[mine] = np.arange(1, len(mine) + 1)
    return {"ids": ids[mine].tobytes(), "depths": depth.tobytes(), "words": number[words].tobytes()}


def _subtree(least: int) -> Callable:
    """Counts the phrases below the prefixes of one group."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(np.concatenate([np.frombuffer(b, np.int64) for b in group["ids"]]), return_inverse=True)
        parts, depths, start = [], [], 0
        for own, depth, words in zip(group["ids"], group["depths"], group["words"]):
            depths.append(np.frombuffer(depth, np.uint8))
            wide = len(words) // (DEPTH * len(depths[-1])) == 4
            numbers = np.frombuffer(words, np.uint32 if wide else np.uint16).reshape(DEPTH, -1)
            size = len(own) // 8
            there = np.concatenate([[0], at[start : start + size] + 1]).astype(np.uint32 if len(ids) >> 16 else np.uint16)
            parts.append(there[numbers])
            start += size
        words, depth = np.concatenate(parts, axis=1), np.concatenate(depths)
        order = np.lexsort(words[::-1])
        change = np.zeros(len(order), bool)
        change[0] = True
        keys, totals = [], []
        for length, word in enumerate(words, 1):
            word = word[order]
            change[1:] |= word[1:] != word[:-1]
            starts = np.flatnonzero(change)
            leaves = np.diff(np.append(starts, len(order)))
            nodes = (leaves >= least) & (word[starts] > 0) & (depth[order[starts]] < length)
            one = order[starts[nodes]]
            keys.extend(ids[words[:length, one].T.astype(np.int64) - 1])
            totals.append(leaves[nodes])
        return pd.DataFrame({"key": pd.Series(keys, dtype=object), "n": np.concatenate(totals)})

    return count


def _packing(sizes: np.ndarray, budget: int) -> np.ndarray:
    """Group of each bin: bins by size go to the first open group with room, in turn."""
    groups, room, current = np.zeros(len(sizes), np.int32), 0, -1
    for k in np.argsort(-sizes, kind="stable"):
        if sizes[k] > room:
            current, room = current + 1, budget
        groups[k] = current
        room -= sizes[k]
    return groups


def counted_phrases(
    sources: DataFrame, words: DataFrame, seed: int, least: int = LEAST, budget: int = BUDGET,
    id_bits: int = ID_BITS, bins: int = BINS,
) -> DataFrame:
    """(key, n): all phrases of 1 to 5 words, as arrays of word ids, that occur ``least`` times."""
    frequent = words.where(F.col("n") >= least)
    levels = [frequent.select(F.array("id").alias("key"), F.col("id").alias("prefix"), "n")]
    plan = _Plan(seed, id_bits, [bitmap(frequent.select(F.col("id").alias("key")), WORD_BITS)], [])
    plan.pairs = frequent_pairs(sources, plan, least)
    while len(levels) < DEPTH:
        over = levels[-1].where(F.col("n") > budget).select(F.col("prefix").alias("key"))
        if over.isEmpty():
            break
        plan.extended.append(bitmap(over, PREFIX_BITS))
        counter = _prefix_counter(plan, len(levels) + 1)
        partial = sources.mapInPandas(counter, "key array<long>, prefix long, n long")
        counted = partial.groupBy("key", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        levels.append(stored(counted, "prefixes"))
        plan.frequent.append(bitmap(levels[-1].select(F.col("prefix").alias("key")), PREFIX_BITS))
    sizes = np.zeros(bins, np.int64)
    # At most one row a bin comes to the driver.
    for depth, level in enumerate(levels, 1):
        if depth < DEPTH:
            within = level.where(F.col("n") <= budget) if len(plan.extended) >= depth else level
            by_bin = within.groupBy(F.col("prefix").bitwiseAND(bins - 1).alias("bin")).agg(F.sum("n").alias("n"))
            for row in by_bin.collect():
                sizes[row["bin"]] += row["n"]
    plan.group_of_bin = _packing(sizes, budget)
    routed = sources.mapInPandas(_router(plan), "group int, ids binary, depths binary, words binary")
    below = routed.groupBy("group").applyInPandas(_subtree(least), _KEY)
    found = below
    for level in levels:
        found = found.unionByName(level.select("key", "n"))
    return stored(found, "phrases")


def without_contained(phrases: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """Phrases of two words and more that no longer one holds in ``contained`` % of their cases."""
    candidates = phrases.where(F.size("key") > 1)
    # Inner parts of two words and more, shorter than the phrase.
    inner = F.expr(
        "flatten(transform(sequence(2, size(key) - 1), m -> "
        "transform(sequence(1, size(key) - m + 1), i -> slice(key, i, m))))"
    )
    longer = (
        candidates.where(F.size("key") > 2)
        .select(F.explode(inner).alias("key"), F.col("n").alias("longer"))
        .groupBy("key")
        .agg(F.max("longer").alias("longer"))
    )
    held = F.coalesce(100 * F.col("longer") >= contained * F.col("n"), F.lit(False))
    return candidates.join(longer, "key", "left").where(~held).select("key", "n")


def spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Add lang and phrase, the words joined by spaces."""
    positions = phrases.select("key", "n", F.posexplode("key").alias("at", "id"))
    named = positions.join(words.select("id", "lang", "word"), "id")
    in_order = F.array_sort(F.collect_list(F.struct("at", "word")))
    return named.groupBy("key", "n").agg(
        F.min("lang").alias("lang"), F.array_join(F.transform(in_order, lambda w: w["word"]), " ").alias("phrase")
    )


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame, scale: int = SCALE) -> DataFrame:
    """Add n of the language, and l, r and score of the cut that scores lowest.

    Products have up to 38 decimal digits, so they are exact.
    """
    cuts = phrases.withColumnRenamed("n", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("key") - 1)))
    cuts = cuts.select(
        "*", F.expr("slice(key, 1, k)").alias("first"), F.expr("slice(key, k + 1, size(key) - k)").alias("rest")
    )
    left = counts.select(F.col("key").alias("first"), F.col("n").alias("l"))
    right = counts.select(F.col("key").alias("rest"), F.col("n").alias("r"))
    wide = cuts.join(left, "first").join(right, "rest").join(totals, "lang")
    digits = "decimal(19, 0)"
    score = F.expr(
        f"(cast({scale}L * a as {digits}) * cast(n as {digits})) div (cast(l as {digits}) * cast(r as {digits}))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (
        wide.groupBy("key", "lang", "phrase", "a", "n")
        .agg(lowest)
        .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    scale: int = SCALE,
    contained: int = CONTAINED,
    budget: int = BUDGET,
    id_bits: int = ID_BITS,
) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    sources = _sources(docs, text_col, lang_col)
    words, seed = counted_words(sources, id_bits)
    counts = counted_phrases(sources, words, seed, least, budget, id_bits)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    kept = spelled(without_contained(counts, contained), words)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranks = scored(kept, counts, totals, scale).withColumn("rank", F.row_number().over(best))
    return ranks.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
