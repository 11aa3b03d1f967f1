"""Near-duplicate vectors through iterative quantisation and multi-index Hamming tables.

1. Equal vectors are collapsed into classes, counted per task first.
2. On a bounded sample a projection onto principal axes and rotations are learned that
   bring the vectors close to the corners of a cube (alternating signs and Procrustes);
   the signs are balanced binary codes. Every vector is then encoded.
3. The codes' substrings index hash tables. Vectors that share a substring meet in a
   bucket; there are as many tables as it takes for pairs at the threshold, made from
   the sample and found in it, to miss all of them with at most ``MISS``.
4. Within a bucket the original vectors are compared in double precision, in blocks. A
   pair counts in the first table in which it meets, so nothing is counted twice, and
   pairs leave the task only as counts and one connecting edge a vector.

Buckets of more than ``BUCKET_LIMIT`` classes are dealt into chunks, and each pair of
chunks is a task's work of its own. No bucket, candidate or partner is capped.

For the tables to stay selective, ``substring_bits`` should grow with log2 of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import runs, stored
from telmart.llm.components import connected_components

THRESHOLD = 0.95
SAMPLE_ROWS = 8_192
SUBSTRING_BITS = 12
MISS = 0.01
BUCKET_LIMIT = 8_192
ROUNDS = 50
SEED = 7
MOST_TABLES = 128
_BLOCK = 1_024
_PARTNERS = 4_096
_PAIR_BLOCK = 256


def _substrings(bits: np.ndarray, width: int) -> list[np.ndarray]:
    """The bits of one rotation as numbers of ``width`` bits each."""
    weights = 1 << np.arange(width)
    return [bits[:, at : at + width] @ weights for at in range(0, bits.shape[1] - width + 1, width)]


@dataclass
class Quantiser:
    """Mean, and one projection per rotation; signs of the projected vector are the code."""

    mean: np.ndarray
    projections: list[np.ndarray]
    substring_bits: int
    tables: int

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The substring of every table, one column each."""
        centred = vectors - self.mean
        keys = [k for p in self.projections for k in _substrings(centred @ p > 0, self.substring_bits)]
        return np.stack(keys[: self.tables], axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so squares neither vanish nor overflow."""
    wide = np.asarray(vectors, np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def stacked(arrays, dimensions: int) -> np.ndarray:
    """Arrays as rows of one matrix; shorter ones are filled up with zeros."""
    out = np.zeros((len(arrays), dimensions))
    for k, a in enumerate(arrays):
        out[k, : len(a)] = a
    return out


def threshold_pairs(sample: np.ndarray, threshold: float, random: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs on which misses are measured, as (vectors, partners, weights).

    Partners made at the threshold's cosine, off in any direction and off in directions in
    which the sample itself varies; and the pairs within the sample that are linked, so that
    dense clusters count by their pairs.
    """
    base = np.repeat(sample, math.ceil(_PARTNERS / len(sample)), axis=0)
    values, axes = np.linalg.eigh(np.cov(sample.T, bias=True).reshape(sample.shape[1], -1))
    out = []
    for spread in (np.eye(sample.shape[1]), axes * np.sqrt(np.maximum(values, 0))):
        off = random.standard_normal(base.shape) @ spread.T
        off -= (off * base).sum(axis=1, keepdims=True) * base
        length = np.linalg.norm(off, axis=1, keepdims=True)
        some = length[:, 0] > 1e-9
        partners = threshold * base[some] + math.sqrt(1 - threshold**2) * off[some] / length[some]
        out.append((base[some], partners, np.ones(len(partners))))
    first, second, weights = [], [], []
    for at in range(0, len(sample), _PAIR_BLOCK):
        a, b = np.nonzero(np.triu(sample[at : at + _PAIR_BLOCK] @ sample.T >= threshold, at + 1))
        drawn = random.choice(len(a), min(len(a), _PARTNERS // 4), replace=False)
        first.append(a[drawn] + at), second.append(b[drawn])
        weights.append(np.full(len(drawn), len(a) / max(1, len(drawn))))
    out.append((sample[np.concatenate(first)], sample[np.concatenate(second)], np.concatenate(weights)))
    return [pairs for pairs in out if len(pairs[2])]


def train(sample: np.ndarray, threshold: float = THRESHOLD, substring_bits: int = SUBSTRING_BITS,
          miss: float = MISS, rounds: int = ROUNDS) -> Quantiser:
    """Learn rotations from unit vectors; tables are added until the measured misses are at most ``miss``.

    Centring widens the angle between vectors that share a direction, so the angle alone
    gives only the least number of tables. Where ``MOST_TABLES`` don't suffice substrings
    are shortened, which makes buckets larger and loses nothing.
    """
    dimensions = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    projected = centred @ axes
    random = np.random.default_rng(SEED)
    pairs = [(a - mean, b - mean, w / w.sum()) for a, b, w in threshold_pairs(sample, threshold, np.random.default_rng(SEED))]
    flip = math.acos(threshold) / math.pi  # share of signs that differ at the threshold
    projections: list[np.ndarray] = []
    for width in range(min(substring_bits, dimensions), 0, -1):
        least = max(1, math.ceil(math.log(miss) / math.log(1 - (1 - flip) ** width)))
        missed, tables, used = [np.ones(len(w), bool) for _, _, w in pairs], 0, 0
        while tables < max(least, MOST_TABLES):
            if used == len(projections):
                rotation, _ = np.linalg.qr(random.standard_normal((dimensions, dimensions)))
                for _ in range(rounds):
                    signs = np.where(projected @ rotation > 0, 1.0, -1.0)
                    left, _, right = np.linalg.svd(signs.T @ projected)
                    rotation = right.T @ left.T
                projections.append(axes @ rotation)
            p, used = projections[used], used + 1
            tables += dimensions // width
            for m, (a, b, _) in zip(missed, pairs):
                for k, n in zip(_substrings(a @ p > 0, width), _substrings(b @ p > 0, width)):
                    m &= k != n
            if tables >= least and all(w @ m <= miss for m, (_, _, w) in zip(missed, pairs)):
                return Quantiser(mean, projections[:used], width, tables)
    # One table that all vectors share.
    return Quantiser(mean, [np.zeros((dimensions, 1))], 1, 1)


def comparable(vector: str) -> Column:
    """Not null, not zero, and every component there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _spanning(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest row each row is connected with, by pairs of rows."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(run: dict[str, np.ndarray], dimensions: int, threshold: float) -> pd.DataFrame:
    """Links counted in one bucket or pair of chunks: class, links, root (a linked class)."""
    size = len(run["class_id"])
    vectors = unit(stacked(run["vector"], dimensions))
    keys = np.stack(run["tables"])[:, : run["table"][0]]
    chunk, copies = run["chunk"], run["copies"]
    within = run["cell_a"][0] == run["cell_b"][0]
    links, edges = np.zeros(size, np.int64), []
    for i in range(0, size, _BLOCK):
        for j in range(i, size, _BLOCK):
            near = vectors[i : i + _BLOCK] @ vectors[j : j + _BLOCK].T >= threshold
            a, b = np.nonzero(np.triu(near, 1) if i == j else near)
            a, b = a + i, b + j
            if not within:
                across = chunk[a] != chunk[b]
                a, b = a[across], b[across]
            if keys.shape[1]:
                first = ~(keys[a] == keys[b]).any(axis=1)
                a, b = a[first], b[first]
            if len(a):
                links += np.bincount(a, copies[b], size).astype(np.int64)
                links += np.bincount(b, copies[a], size).astype(np.int64)
                label = _spanning(a, b, size)
                moved = np.flatnonzero(label != np.arange(size))
                edges.append((moved, label[moved]))
    root = np.arange(size)
    if edges:
        root = _spanning(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]), size)
    some = links > 0
    ids = run["class_id"]
    return pd.DataFrame({"class_id": ids[some], "links": links[some], "root": ids[root[some]]})


def _bucketed(classes: DataFrame, model: Quantiser, dimensions: int, bucket_limit: int) -> DataFrame:
    def tables(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        return pd.Series(list(model.keys(unit(stacked(vectors.tolist(), dimensions))).astype(np.int32)))

    coded = classes.withColumn("tables", F.pandas_udf(tables, "array<int>")("vector"))
    coded = stored(coded, "codes")
    spread = coded.select("class_id", "copies", "vector", "tables", F.posexplode("tables").alias("table", "value"))
    # At most tables * 2 ** substring_bits rows.
    large = (
        coded.select(F.posexplode("tables").alias("table", "value"))
        .groupBy("table", "value")
        .count()
        .where(F.col("count") > bucket_limit)
        .select("table", "value", F.ceil(F.col("count") / bucket_limit).cast("int").alias("chunks"))
    )
    chunk = F.coalesce(F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int"), F.lit(0))
    cells = F.transform(
        F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1),
        lambda k: F.struct(F.least(k, "chunk").alias("cell_a"), F.greatest(k, "chunk").alias("cell_b")),
    )
    return (
        spread.join(F.broadcast(large), ["table", "value"], "left")
        .withColumn("chunk", chunk)
        .withColumn("cell", F.explode(cells))
        .select("table", "value", "cell.cell_a", "cell.cell_b", "chunk", "class_id", "copies", "tables", "vector")
    )


def near_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
    substring_bits: int = SUBSTRING_BITS,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """One row per row of ``table``: id, n_links, component_id and kept.

    Vectors that are null, zero or hold null or non-finite components link with nothing,
    nor do rows without id (their component_id is null and they are not kept). Repeated
    rows count as vectors of their own. Vectors of unequal length are compared as if the
    shorter had zeros at its end. Other columns are not looked at.
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    usable = comparable("vector") & F.col("id").isNotNull()
    classes = stored(
        rows.where(usable)
        .groupBy("vector")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    size, dimensions = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if size:
        share = min(1.0, sample_rows / size)
        drawn = classes.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 31)) < int(share * (1 << 31)))
        vectors = [r["vector"] for r in drawn.select("vector").sort("vector").collect()]
        sample = unit(stacked(vectors, dimensions)) if vectors else np.eye(dimensions)
        model = train(sample, threshold, substring_bits)
        order = ("table", "value", "cell_a", "cell_b")
        wanted = (*order, "chunk", "class_id", "copies", "tables", "vector")

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for run in runs(batches, order, wanted, least=2):
                yield bucket_links(run, dimensions, threshold)

        found = stored(
            _bucketed(classes, model, dimensions, bucket_limit)
            .repartition(*order)
            .sortWithinPartitions(*order)
            .mapInPandas(compare, "class_id long, links long, root long"),
            "links",
        )
    else:
        found = table.sparkSession.createDataFrame([], "class_id long, links long, root long")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("class_id").alias("u"), F.col("root").alias("v")))
    grouped = (
        classes.join(links, "class_id", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .withColumn("root", F.coalesce("root", "class_id"))
    )
    components = grouped.groupBy("root").agg(F.min("first_id").alias("component"))
    answers = grouped.join(components, "root").select(
        "vector", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    keyed = rows.withColumn("usable", usable)
    joined = keyed.join(answers.withColumn("usable", F.lit(True)), ["usable", "vector"], "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
