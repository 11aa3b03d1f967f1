"""Lenient casts: text that does not parse becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(column: Column) -> Column:
    return column.try_cast("double")


def to_integer(column: Column) -> Column:
    # Through double, so that "480.0" counts as 480.
    return column.try_cast("double").try_cast("bigint")


def to_moment(column: Column) -> Column:
    """Zone-free timestamp, so keys hashed from it do not depend on the session zone."""
    return column.try_cast("timestamp_ntz")


def to_day(column: Column, *formats: str) -> Column:
    """First format that parses wins; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)).cast("date") for f in formats])


def to_boolean(column: Column) -> Column:
    """True or false where the value is that or its name; null for anything else."""
    name = F.lower(F.trim(column.cast("string")))
    return F.when(name == "true", True).when(name == "false", False)


def filled(column: Column) -> Column:
    """Null for an empty string, for fallbacks that skip blank values."""
    return F.when(column != "", column)


def cast_leniently(column: Column, data_type: str) -> Column:
    if data_type == "bigint":
        return to_integer(column)
    if data_type == "boolean":
        return to_boolean(column)
    return column.try_cast(data_type)
