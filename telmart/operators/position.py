"""Consecutive row positions without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telmart.scratch import shared_root

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_position(df: DataFrame, name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Add positions 1..n in the order of ``order_by``, or in scan order without it.

    Rows are range-partitioned and numbered inside their partition; the partition sizes
    (one small row each) give the offsets. The numbered rows are checkpointed to the
    shared folder first, since a recomputed range partitioning could cut elsewhere.
    """
    spark = df.sparkSession
    shared_root(spark)
    if order_by:
        # Scan order breaks ties, so rows with equal order columns still spread out.
        order = [*order_by, "__scan"]
        df = (
            df.withColumn("__scan", F.monotonically_increasing_id())
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .drop("__scan")
        )
    numbered = df.select(
        "*",
        F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1).alias("__row"),
    ).checkpoint()
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__row") + 1)
        .drop("__part", "__row", "__offset")
    )
