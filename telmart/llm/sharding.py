"""Shards that all hold the mixture of the whole, by proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked. Row r of a source with n rows
(r from 0) stands at the fraction (2r + 1) / 2n of it. All rows sorted by fraction interleave
the sources in proportion everywhere, so cutting that order into equal runs gives shards
whose row counts differ by at most one and that hold every source in its share, give or
take a row or two.

Only ids, sources, sizes, checksums and a row number are sorted; texts stay where they are
until shards are written. Null is a source of its own. Null text has no bytes and the
checksum of an empty one. Rows with the same or no id are rows of their own, in an order
that their checksum and then their place in the table decide. An empty table gives no rows.
Other columns are carried untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telmart.llm.common import columns, stored
from telmart.llm.ranking import ranked

SHARDS = 8
SEED = 13
LAW = "rows"


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text, plus one; one for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_checksum(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; that of no bytes for null."""
    return F.crc32(F.coalesce(text, F.lit("")))


def _facts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    text = docs[f"`{text_col}`"]
    return [
        docs[f"`{id_col}`"].alias("id"),
        docs[f"`{source_col}`"].alias("source"),
        text_size(text).alias("size"),
        text_checksum(text).alias("checksum"),
        F.monotonically_increasing_id().alias("number"),
    ]


def interleaved(facts: DataFrame, seed: int = SEED) -> DataFrame:
    """Add column place (0, 1, ...), the order in which all sources are mixed in proportion.

    ``facts`` has columns id, source, size, checksum and number, a number per row. Both
    rankings deal rows by ranges, so a source of any size spreads over tasks.
    """
    shuffled = facts.withColumn("draw", F.xxhash64(F.lit(seed), "id", "checksum", "size"))
    order = [F.col("source").isNull(), F.col("source"), F.col("draw"), F.col("id"), F.col("number")]
    by_source = ranked(shuffled, order, "at")
    # One row a source, counted in the tasks first; joined as Spark sees fit.
    sources = by_source.groupBy("source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    both = by_source.join(
        sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    fraction = (2 * (F.col("at") - F.col("first")) + 1) / (2 * F.col("rows"))
    placed = both.select(*facts.columns, "at", fraction.alias("fraction"))
    return ranked(placed, [F.col("fraction"), F.col("at")], "place").drop("at", "fraction")


def cut(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add shard (int) and slot (long, from 0 in every shard) to rows with a place.

    Shard s takes the places from s * rows / shards up to the next shard's first one.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    total = placed.count()
    shard = f"(place * {shards}L div {max(total, 1)}L)"
    first = f"({shard} * {total}L + {shards - 1}L) div {shards}L"
    return placed.select(
        *[c for c in placed.columns if c != "place"],
        F.expr(shard).cast("int").alias("shard"),
        F.expr(f"place - {first}").alias("slot"),
    )


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: its id, size, checksum, shard and slot."""
    facts = stored(docs.select(*_facts(docs, id_col, text_col, source_col)), "facts")
    placed = cut(interleaved(facts, seed), shards)
    return placed.select(F.col("id").alias(id_col), "size", "checksum", "shard", "slot")


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
) -> None:
    """Write ``docs`` as Parquet below ``path``/shard=<n>, rows in the order of their slots.

    Files hold columns ``slot`` and ``row``, the whole row as a struct, so no name clashes.
    The rows are numbered and stored once; then they are dealt by shard and slot, so a shard
    becomes several files of consecutive slots rather than one task's work.
    """
    row = F.struct(*columns(docs)).alias("row")
    numbered = stored(docs.select(row, *_facts(docs, id_col, text_col, source_col)), "numbered")
    facts = numbered.select("id", "source", "size", "checksum", "number")
    places = cut(interleaved(facts, seed), shards).select("number", "shard", "slot")
    rows = numbered.select("number", "row").join(places, "number").select("shard", "slot", "row")
    (
        rows.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows of one shard in their order, as they were written."""
    held = spark.read.parquet(path).where(F.col("shard") == shard)
    return held.orderBy("slot").select("row.*")
