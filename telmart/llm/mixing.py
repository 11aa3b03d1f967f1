"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``rate`` = target / source size times in the mix.
Sorted within its source, document r has the prefix sum r * rate; with one offset u per
source, drawn from a seed, it is emitted once per integer between (r - 1) * rate + u and
r * rate + u. As documents are sorted by size first, neighbours stand in for each other and
the taken words come near the target; as rates are at most ``MAX_REPEATS``, no document is
taken more often than that.

The order has no ties but between equal rows, and ranks are integers, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telmart.llm.common import columns, stored
from telmart.llm.ranking import ranked

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix"
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: its size, target, rate and offset.

    Sources take the weights in turn, by code point, null last. Targets share the size of
    all sources by weight; a target stops at ``max_repeats`` times its source's size, and
    the excess is shared anew by weight. All sources below their limit then stand at one
    level, target = level * weight, which the sorted limits give in one pass. Sources are
    counted per task first; the windows run over one small row a source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    # Column functions, not element_at: the weights are few and fixed.
    weight = F.coalesce(
        *(F.when(turn % len(weights) == k, F.lit(w)) for k, w in enumerate(weights))
    )
    limited = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * max_repeats)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before, all_rows = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (
        F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = limited.withColumn("level", level)
    # The level holds from the first source, by limit, that does not reach its own limit; of
    # sources with equal limits that is the one with the highest level.
    ratio, level = F.col("limit") / F.col("weight"), F.col("level")
    holds = F.min(F.when(level * F.col("weight") <= F.col("limit"), F.struct(ratio, -level))).over(all_rows)
    target = F.least(-holds["col2"] * F.col("weight"), F.col("limit").cast("double"))
    offset = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    return levelled.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
        (offset.cast("double") / F.lit(float(1 << 32))).alias("offset"),
    )


def with_copies(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Rows (id, source, size, number) with copies, source_size and target.

    Rows are range-partitioned by source, size and id, so a large source spreads over
    tasks; ranks within a source are positions less the source's first one. The number, one
    of each row's own, tells equal rows apart.
    """
    targets = stored(source_targets(sized, weights, max_repeats), "targets")
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("id"), F.col("number")]
    placed = ranked(sized.select("id", "source", "size", "number"), order, "at")
    first = placed.groupBy("source").agg(F.min("at").alias("first"))
    per_source = targets.join(first, targets["source"].eqNullSafe(first["source"])).select(
        targets["source"].alias("of"), "source_size", "target", "rate", "offset", "first"
    )
    rank = F.col("at") - F.col("first") + 1
    copies = F.floor(rank * F.col("rate") + F.col("offset")) - F.floor(
        (rank - 1) * F.col("rate") + F.col("offset")
    )
    return (
        placed.join(per_source, placed["source"].eqNullSafe(per_source["of"]))
        .withColumn("copies", copies)
        .drop("at", "first", "of", "rate", "offset")
    )


def mix_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken and copies.

    Null text has size 0; null is a source of its own, the last one; null ids sort first.
    Repeated rows are documents of their own. A source without words has target 0 and none
    of its documents is taken. Other columns are not looked at.
    """
    sized = stored(
        docs.select(
            docs[f"`{id_col}`"].alias("id"),
            docs[f"`{source_col}`"].alias("source"),
            word_count(docs[f"`{text_col}`"]).alias("size"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "sizes",
    )
    return with_copies(sized, weights, max_repeats).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; mix_report says what odd values do.

    The rows are stored with a number of their own, so only that number, the id, the
    source and the size go through the ranking. Other columns are carried as one struct,
    whatever their names.
    """
    numbered = stored(
        docs.select(
            F.struct(*columns(docs)).alias("row"),
            docs[f"`{id_col}`"].alias("id"),
            docs[f"`{source_col}`"].alias("source"),
            word_count(docs[f"`{text_col}`"]).alias("size"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "numbered",
    )
    sized = numbered.select("id", "source", "size", "number")
    taken = with_copies(sized, weights, max_repeats).where("copies > 0").select("number", "copies")
    return (
        numbered.select("number", "row")
        .join(taken, "number")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("row.*")
    )
