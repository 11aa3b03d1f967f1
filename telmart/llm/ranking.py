"""Consecutive ranks of all rows, without a window over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telmart.llm.common import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add long column ``name``: 0, 1, ... in the order of ``order``, which must have no ties.

    Rows are dealt by ranges of the order, numbered inside their partition and stored, since
    ranges that are made again could be cut elsewhere; the partitions' sizes, one small row
    each, give the offsets. ``df`` has no columns that start with two underscores.
    """
    numbered = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("__part"),
            F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1).alias("__row"),
        ),
        "ranked",
    )
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    # One row a partition, whatever the rows: small enough to send to every task.
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__row"))
        .drop("__part", "__row", "__before")
    )
