"""Gold aggregates over the conformed dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_measures(
    fact: DataFrame,
    group_by: Sequence[str],
    sums: Sequence[str] = (),
    averages: Sequence[str] = (),
    decimals: int = 2,
) -> DataFrame:
    """Row count, sums and averages per group; reduced inside each task before the shuffle."""
    measures: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    measures += [F.round(F.sum(c), decimals).alias(f"sum_{c}") for c in sums]
    measures += [F.round(F.avg(c), decimals).alias(f"avg_{c}") for c in averages]
    return fact.groupBy(*group_by).agg(*measures)


def partial_measures(
    fact: DataFrame, group_by: Sequence[str], sums: Sequence[str] = (), averages: Sequence[str] = ()
) -> DataFrame:
    """What ``merged_measures`` needs of each group: row count, sums, and counts of averaged values."""
    names = list(dict.fromkeys([*sums, *averages]))
    measures = [F.count(F.lit(1)).alias("n_rows")]
    measures += [F.sum(c).alias(f"total_{c}") for c in names]
    measures += [F.count(c).alias(f"filled_{c}") for c in averages]
    return fact.groupBy(*group_by).agg(*measures)


def merged_measures(
    partials: DataFrame,
    group_by: Sequence[str],
    sums: Sequence[str] = (),
    averages: Sequence[str] = (),
    decimals: int = 2,
) -> DataFrame:
    """``daily_measures`` from stored parts, by the same or fewer columns."""
    measures: list[Column] = [F.sum("n_rows").alias("n_rows")]
    measures += [F.round(F.sum(f"total_{c}"), decimals).alias(f"sum_{c}") for c in sums]
    measures += [
        F.round(F.try_divide(F.sum(f"total_{c}"), F.sum(f"filled_{c}")), decimals).alias(f"avg_{c}")
        for c in averages
    ]
    return partials.groupBy(*group_by).agg(*measures)


def drill_across(
    parts: Mapping[str, DataFrame], on: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Line up aggregates of several facts on shared dimension columns.

    Every part must already be grouped by ``on``; its measures are named
    ``<part>_<measure>`` and are null where the part has no such group.
    """
    renamed = [
        df.select(*on, *[F.col(m).alias(f"{name}_{m}") for m in measures])
        for name, df in parts.items()
    ]
    return reduce(lambda a, b: a.join(b, list(on), "full_outer"), renamed)


def load_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table, through scalar subqueries."""
    spark = next(iter(tables.values())).sparkSession
    names = list(tables)
    selected = ", ".join(f"(select count(*) from {{{n}}}) as {n}" for n in names)
    return spark.sql(f"select {selected}", **tables)
