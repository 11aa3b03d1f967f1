"""Catalog tables and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None when the catalog does not know it."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def row_count(df: DataFrame) -> int:
    return df.count()


def publish_view(df: DataFrame, name: str) -> str:
    """Make a DataFrame addressable from SQL text; returns the view name."""
    df.createOrReplaceTempView(name)
    return name
