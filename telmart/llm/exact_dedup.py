"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Every level counts its keys and passes on only rows whose key occurs again; the full
content is hashed for the survivors alone. The survivors of a level travel as a bitmap of
fixed size, so no text is ever shuffled to find them. A collision in a bitmap merely lets
a row go on to the next, exact level.

Null text counts as empty. A group's answer is the largest id in it; null ids are smaller
than any other. Rows that repeat an id and its text are one document: they all count
towards the group's size and get the same answer. Other columns are carried as one struct
and not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import columns, stored

PREFIX_CHARS = 64
FILTER_BITS = 1 << 26  # 8 MB, whatever the input
_BITMAP_BITS = 8 * 4096  # of one value of bitmap_construct_agg


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def _repeated(keys: DataFrame, bits: int) -> DataFrame:
    """A bitmap, in pieces, of the keys that occur more than once; ``keys`` has column key."""
    slots = (
        keys.groupBy("key")
        .count()
        .where("count > 1")
        .select(_slot(F.col("key"), bits).alias("slot"))
        .select(
            F.floor(F.col("slot") / _BITMAP_BITS).alias("piece"),
            (F.col("slot") % _BITMAP_BITS).alias("bit"),
        )
    )
    # Dealt by piece first: one small row a key moves, not one bitmap a task.
    pieces = slots.repartition("piece").groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return stored(pieces.select(F.col("piece").alias("__piece"), F.col("bitmap").alias("__bitmap")), "bitmap")


def _where_repeated(df: DataFrame, key: Column, bitmap: DataFrame, bits: int, name: str) -> DataFrame:
    """Add boolean ``name``: whether the row's key is in the bitmap (at most bits / 8 bytes)."""
    slot = _slot(key, bits)
    bit = (slot % _BITMAP_BITS).cast("int")
    byte = F.substring(F.col("__bitmap"), (bit / 8 + 1).cast("int"), F.lit(1))
    found = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit % 8) == 1
    return (
        df.withColumn("__piece", F.floor(slot / _BITMAP_BITS))
        .join(F.broadcast(bitmap), "__piece", "left")
        .withColumn(name, F.coalesce(found, F.lit(False)))
        .drop("__piece", "__bitmap")
    )


def with_full_hash(
    docs: DataFrame, text_col: str, prefix_chars: int = PREFIX_CHARS, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """Add ``__hash``: sha-256 of the text where another row may hold the same, else null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    length = F.octet_length(text)
    prefix = F.concat_ws(":", length, F.xxhash64(F.left(text, F.lit(prefix_chars))))
    lengths = _repeated(docs.select(length.alias("key")), filter_bits)
    docs = _where_repeated(docs, length, lengths, filter_bits, "__same_length")
    prefixes = _repeated(docs.where("__same_length").select(prefix.alias("key")), filter_bits)
    docs = _where_repeated(docs, prefix, prefixes, filter_bits, "__same_prefix")
    full = F.when(F.col("__same_length") & F.col("__same_prefix"), F.sha2(text, 256))
    return docs.withColumn("__hash", full).drop("__same_length", "__same_prefix")


def mark_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    prefix_chars: int = PREFIX_CHARS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``carry``, keep_id, group_size and kept.

    Only ids, hashes and the carried columns are shuffled. Groups are counted before the
    shuffle; the join back is one that adaptive execution splits where a group is large.
    """
    held = docs.select(
        docs[f"`{id_col}`"].alias("id"),
        docs[f"`{text_col}`"].alias("text"),
        *[docs[f"`{c}`"].alias(f"carried_{k}") for k, c in enumerate(carry)],
    )
    rows = with_full_hash(held, "text", prefix_chars, filter_bits).drop("text")
    groups = (
        rows.where("__hash is not null")
        .groupBy("__hash")
        .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    # Rows that are alone have no hash; a key of their own keeps them off a common task.
    alone = F.xxhash64(F.monotonically_increasing_id()).cast("string")
    return rows.withColumn("__hash", F.coalesce("__hash", alone)).join(groups, "__hash", "left").select(
        F.col("id").alias(id_col),
        *[F.col(f"carried_{k}").alias(c) for k, c in enumerate(carry)],
        F.coalesce("keep", "id").alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep").isNull() | (F.col("keep") == F.col("id")), F.lit(False)).alias("kept"),
    )


def drop_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` with exactly one row of every text, the one with the largest id.

    Of rows that repeat the id, the one whose other columns sort last stays. Rows whose
    text is certainly alone pass unshuffled; of the rest each task first keeps one row a text.
    """
    other = [docs[f"`{c}`"] for c in docs.columns if c not in (id_col, text_col)]
    held = docs.select(
        docs[f"`{id_col}`"].alias("id"),
        docs[f"`{text_col}`"].alias("text"),
        (F.to_json(F.struct(*other)) if other else F.lit("")).alias("others"),
        F.struct(*columns(docs)).alias("row"),
    )
    hashed = with_full_hash(held, "text", prefix_chars, filter_bits)
    best = (
        hashed.where("__hash is not null")
        .groupBy("__hash")
        .agg(F.max_by("row", F.struct("id", "others")).alias("row"))
        .select("row.*")
    )
    return hashed.where("__hash is null").select("row.*").unionAll(best)
