"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telmart.scratch import scratch_path

HELD_OUT_REMAINDER = 2


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [df["`" + name.replace("`", "``") + "`"] for name in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it back.

    This cuts the lineage at a place every executor can reach, so lost executors cost no
    recomputation beyond it and random or sampled steps are never repeated differently.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BITMAP_BITS = 8 * 4096  # of one value of bitmap_construct_agg


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """The low bits of column ``key`` (a hash, long) as a bitmap of ``bits`` / 8 bytes.

    Its size is fixed, whatever the number of keys: a filter that tasks may carry. It never
    misses a key; the fuller it is, the more other keys it lets pass. ``bits`` is a power of two.
    """
    slot = F.col("key").bitwiseAND(bits - 1)
    slots = keys.select(F.floor(slot / _BITMAP_BITS).alias("piece"), (slot % _BITMAP_BITS).alias("bit"))
    # Dealt by piece first: one small row a key moves, not one bitmap a task.
    pieces = slots.repartition("piece").groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    found = np.zeros((max(1, bits // _BITMAP_BITS), _BITMAP_BITS // 8), np.uint8)
    for piece, held in pieces.collect():
        found[piece] = np.frombuffer(bytes(held), np.uint8)
    return found.reshape(-1)[: max(1, bits // 8)]


def summed_arrays(
    partial: DataFrame, held: str, total: str, finish: Callable[[np.ndarray], np.ndarray] | None = None
) -> np.ndarray:
    """Sums of the arrays that tasks made, part by part, one after the other.

    ``partial`` has columns part (int) and values (binary, numbers of type ``held``); arrays of
    a part are equally long. Rows stream by, so memory holds one part whatever the number
    of tasks; ``finish`` may make a part's sums smaller before they go to the driver.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, sums = None, None

        def done() -> pd.DataFrame:
            out = sums if finish is None else finish(sums)
            return pd.DataFrame({"part": [part], "values": [out.tobytes()]})

        for batch in batches:
            for number, values in zip(batch["part"], batch["values"]):
                values = np.frombuffer(values, held)
                if number != part:
                    if part is not None:
                        yield done()
                    part, sums = number, np.zeros(len(values), total)
                sums += values
        if part is not None:
            yield done()

    rows = partial.select("part", "values").repartition("part").sortWithinPartitions("part")
    found = rows.mapInPandas(add, "part int, values binary").collect()
    kind = total if finish is None else finish(np.zeros(8, total)).dtype
    pieces = [np.frombuffer(bytes(r["values"]), kind) for r in sorted(found, key=lambda r: r["part"])]
    return np.concatenate(pieces) if pieces else np.zeros(0, kind)


def in_bitmap(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (a 64-bit integer) may be one of those the bitmap was made from."""
    slot = keys.astype(np.uint64) & np.uint64(8 * len(held) - 1)
    byte = held[(slot >> np.uint64(3)).astype(np.int64)]
    return (byte >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def held_out(id_col: str = "doc_id", folds: int = 4) -> Column:
    """True for rows no model may learn from; a row without id is not held out."""
    return F.coalesce(fold(id_col, folds) == HELD_OUT_REMAINDER, F.lit(False))


def learnable(id_col: str = "doc_id", folds: int = 4) -> Column:
    """True for rows a model may learn from; a row without id is never used."""
    return F.coalesce(fold(id_col, folds) != HELD_OUT_REMAINDER, F.lit(False))


def bounded_sample(df: DataFrame, id_col: str, limit: int, rows: int | None = None) -> DataFrame:
    """About ``limit`` rows at most, chosen by a hash of their id; all rows if there are fewer.

    When rows are thinned, those without id go, and of rows that share an id the first in the
    order of all columns stays: neither can fill a sample beyond its limit.
    """
    rows = df.count() if rows is None else rows
    if rows <= limit:
        return df
    share = int(limit / rows * (1 << 31))
    some = df.where(F.col(id_col).isNotNull() & (F.pmod(F.xxhash64(id_col), F.lit(1 << 31)) < share))
    one = some.groupBy(id_col).agg(F.min(F.struct(*columns(df))).alias("row"))
    return one.select("row.*")


def words(text: str | None) -> list[bytes]:
    """Runs of anything but space and \\x09-\\x0D, with A-Z in lower case."""
    return text.encode().lower().split() if text else []


def runs(
    batches: Iterator[pd.DataFrame], keys: Sequence[str], columns: Sequence[str], least: int = 1
) -> Iterator[dict[str, np.ndarray]]:
    """Consecutive rows of equal keys as arrays, for partitions sorted by ``keys``.

    Keys must be numeric. Runs shorter than ``least`` are passed over.
    """
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        data = {c: batch[c].to_numpy() for c in columns}
        if held is not None:
            data = {c: np.concatenate([held[c], data[c]]) for c in columns}
        size = len(data[columns[0]])
        if not size:
            continue
        change = np.zeros(size - 1, bool)
        for key in keys:
            change |= data[key][1:] != data[key][:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        lengths = np.diff(starts)
        for k in np.flatnonzero(lengths >= least):
            yield {c: v[starts[k] : starts[k + 1]] for c, v in data.items()}
        held = {c: v[starts[-1] :] for c, v in data.items()}
    if held is not None and len(held[columns[0]]) >= least:
        yield held
