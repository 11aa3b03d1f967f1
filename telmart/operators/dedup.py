"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], aggregate) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(f"`{c}`").alias(f"__order{i}") for i, c in enumerate(order_by)]
    # The remaining columns break ties, so the choice does not depend on row order.
    row = F.struct(*order, *[F.col(f"`{c}`") for c in rest])
    picked = df.groupBy(*keys).agg(aggregate(row).alias("__row"))
    return picked.select(
        *[F.col(f"`{c}`") if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def first_row_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The row with the smallest ``order_by`` of every key (columns must be orderable).

    An aggregate rather than a window: each task first reduces its own rows to one per
    key, so a key with very many rows never has to fit into, or wait for, one task.
    """
    return _pick(df, keys, order_by, F.min)


def last_row_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row with the largest ``order_by`` of every key."""
    return _pick(df, keys, order_by, F.max)
