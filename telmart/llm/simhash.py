"""SimHash near-duplicates through BK-trees.

A document's fingerprint has 64 bits; bit i is one where bit i is set in more than half of
the hashes of its word shingles. Documents link when their fingerprints differ in at most
``RADIUS`` bits, and groups are the connected components of those links.

Search. Two codes within 4 bits agree on at least two of six blocks, so every code joins
the 15 shards named by two of its blocks, and each linked pair meets in a shard. A shard
becomes a BK-tree: a node's children are keyed by their integer Hamming distance to it,
and a search follows only the edges within the radius of the query's distance. Equal
codes are collapsed beforehand, so a group of exact copies is one code. A shard with more
than ``SHARD_LIMIT`` codes is dealt into chunks and every pair of chunks gets a tree of
its own: trees have a proven size bound, and the tree of a chunk travels to the shard's
other chunks only. Within a tree a subtree whose codes are all linked with the query
already is passed over; so a dense group of near copies takes one visit a code, and a
tree emits one link a code instead of all pairs. No candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from telmart.llm.common import columns, free_name, runs, stored, words
from telmart.llm.components import connected_components

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
SHARD_LIMIT = 1 << 16
_BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))  # first bit, width
_PIECE = 1 << 15  # shingles whose bits are counted at once


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned number; zero for a text without words."""
    tokens = words(text)
    if not tokens:
        return 0
    if len(tokens) <= shingle_words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(shingle_words)))))
    count = np.zeros(64, np.int64)
    for start in range(0, len(shingles), _PIECE):
        part = shingles[start : start + _PIECE]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(shingles), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a (signed) long."""

    def of(texts: pd.Series) -> pd.Series:
        codes = np.fromiter((simhash(t, shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(codes.view(np.int64))

    return F.pandas_udf(of, LongType())(text)


def fingerprint_hex(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def _shard_keys(code: Column) -> Column:
    """The 15 shards of a code: which two blocks, and their bits."""
    block = [F.shiftrightunsigned(code, at).bitwiseAND((1 << width) - 1) for at, width in _BLOCKS]
    return F.array(
        *(
            F.shiftleft(F.lit(n).cast("long"), 22) + F.shiftleft(block[a], 11) + block[b]
            for n, (a, b) in enumerate(combinations(range(len(_BLOCKS)), 2))
        )
    )


class LinkTree:
    """A BK-tree that keeps its codes' linked groups; every code is searched, then added."""

    def __init__(self, radius: int = RADIUS) -> None:
        self.radius = radius
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []  # of a node, by distance to it
        self.leader: list[int] = []  # union-find
        self.alike: list[int] = []  # a node whose group has the whole subtree; -1 if mixed

    def group(self, node: int) -> int:
        leader = self.leader
        while leader[node] != node:
            leader[node] = node = leader[leader[node]]
        return node

    def add(self, code: int) -> None:
        codes, children, alike, radius = self.codes, self.children, self.alike, self.radius
        new = len(codes)
        codes.append(code)
        children.append({})
        self.leader.append(new)
        alike.append(new)
        if not new:
            return
        mine, pending = new, [0]
        while pending:
            node = pending.pop()
            if alike[node] >= 0 and self.group(alike[node]) == mine:
                continue
            distance = (code ^ codes[node]).bit_count()
            if distance <= radius:
                other = self.group(node)
                if other != mine:
                    self.leader[mine] = other
                    mine = other
            for edge, child in children[node].items():
                if -radius <= edge - distance <= radius:
                    pending.append(child)
        node = 0
        while True:
            if alike[node] >= 0 and self.group(alike[node]) != mine:
                alike[node] = -1
            distance = (code ^ codes[node]).bit_count()
            child = children[node].get(distance)
            if child is None:
                children[node][distance] = new
                return
            node = child


def _shard_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple[int, int]] = []
    for run in runs(batches, ("shard", "cell"), ("shard", "cell", "code"), least=2):
        codes = run["code"].tolist()
        tree = LinkTree()
        for code in codes:
            tree.add(code & 0xFFFFFFFFFFFFFFFF)
        for node, code in enumerate(codes):
            if (leader := tree.group(node)) != node:
                out.append((code, codes[leader]))
        if len(out) >= 50_000:
            yield pd.DataFrame(out, columns=["u", "v"])
            out = []
    yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def code_links(codes: DataFrame, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(u, v) links that connect the same codes as all pairs within the radius do.

    ``codes`` has distinct longs in column code.
    """
    sharded = codes.select("code", F.explode(_shard_keys(F.col("code"))).alias("shard"))
    # At most 15 * codes / shard_limit rows: safe to broadcast.
    large = (
        sharded.groupBy("shard")
        .count()
        .where(F.col("count") > shard_limit)
        .select("shard", F.ceil(F.col("count") / (shard_limit / 2)).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda i: F.least(i, chunk) * F.col("chunks") + F.greatest(i, chunk),
    )
    dealt = sharded.join(F.broadcast(large), "shard", "left").select(
        "shard", "code", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(cells)).alias("cell")
    )
    return (
        dealt.repartition("shard", "cell")
        .sortWithinPartitions("shard", "cell", "code")
        .mapInPandas(_shard_links, "u long, v long")
    )


def near_groups(classes: DataFrame) -> DataFrame:
    """Classes (code, first_id, size) with their group: code, component_id, group_size.

    component_id is the smallest id in the group, null if the group has no ids.
    """
    roots = connected_components(code_links(classes.select("code")))
    grouped = classes.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn(
        "root", F.coalesce("root", "code")
    )
    groups = grouped.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.sum("size").alias("group_size")
    )
    return grouped.select("code", "root").join(groups, "root").drop("root")


def classes_of(coded: DataFrame, id_col: str) -> DataFrame:
    return stored(
        coded.groupBy("code").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("size")), "codes"
    )


def mark_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, fingerprint (16 hex digits) and component_id.

    Null text has no words: fingerprint zero, linked like any other. component_id is the
    smallest id of the group; ids that are null are passed over, and a group of such rows
    alone has null. Repeated rows get the same answer. Other columns are not looked at.
    """
    coded = stored(docs.select(id_col, fingerprint(F.col(text_col)).alias("code")), "fingerprints")
    groups = near_groups(classes_of(coded, id_col))
    return coded.join(groups, "code").select(id_col, fingerprint_hex(F.col("code")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id.

    Rows that repeat that id stay together; rows without id stay only where their whole
    group has none. All columns keep their names and places.
    """
    code = free_name(docs, "code")
    coded = stored(docs.withColumn(code, fingerprint(docs[f"`{text_col}`"])), "fingerprints")
    ids = coded.select(coded[code].alias("code"), coded[f"`{id_col}`"].alias("id"))
    groups = near_groups(classes_of(ids, "id"))
    several = groups.where("group_size > 1").select(F.struct("code", "component_id").alias("several"))
    joined = coded.join(several, coded[code] == several["several.code"], "left")
    keep = several["several"].isNull() | several["several.component_id"].eqNullSafe(coded[f"`{id_col}`"])
    return joined.where(keep).select(*columns(coded)[:-1])
