"""Projection, defaulting and filtering operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmart.functions.casts import cast_leniently

QUALITY_FLAGS = ("rejection_reason", "is_rejected")

RAISE = "raise"
OVERWRITE = "overwrite"


def flatten_structs(
    df: DataFrame, prefixes: Mapping[str, str], on_conflict: str = RAISE
) -> DataFrame:
    """Replace struct columns by their fields, named ``<prefix>_<field>``.

    An empty prefix gives the bare field names. Columns that are absent or not structs
    are left alone. One projection is built however many structs there are, so nested
    column pruning still reaches the scan. When a field would take the name of a
    column that stays, ``on_conflict`` either raises or lets the field replace it.
    """
    structs = {
        name: prefix
        for name, prefix in prefixes.items()
        if name in df.columns and isinstance(df.schema[name].dataType, T.StructType)
    }
    fields: dict[str, Column] = {}
    for name, prefix in structs.items():
        for field in df.schema[name].dataType.names:
            target = f"{prefix}_{field}" if prefix else field
            if target in fields and on_conflict == RAISE:
                raise ValueError(f"two struct fields would be named {target}")
            fields[target] = F.col(f"`{name}`").getField(field).alias(target)
    kept = [c for c in df.columns if c not in structs]
    clashes = [c for c in kept if c in fields]
    if clashes and on_conflict == RAISE:
        raise ValueError(f"flattened fields would replace columns {clashes}")
    return df.select(*[F.col(f"`{c}`") for c in kept if c not in fields], *fields.values())


@dataclass(frozen=True)
class Projected:
    """A target column: where it comes from, its type and its null default.

    ``default=None`` keeps nulls. A source column absent from the frame yields the
    default (or a typed null) instead of an analysis error.
    """

    target: str
    source: str
    data_type: str = "string"
    default: Any = None


def projected(df: DataFrame, spec: Projected) -> Column:
    fallback = F.lit(spec.default).cast(spec.data_type)
    if spec.source not in df.columns:
        return fallback.alias(spec.target)
    value = F.col(f"`{spec.source}`")
    if df.schema[spec.source].dataType.simpleString() != spec.data_type:
        value = cast_leniently(value, spec.data_type)
    if spec.default is not None:
        value = F.coalesce(value, fallback)
    return value.alias(spec.target)


def project_with_defaults(df: DataFrame, specs: Sequence[Projected]) -> DataFrame:
    return df.select(*[projected(df, s) for s in specs])


def accepted(df: DataFrame) -> DataFrame:
    """Rows not known to be rejected: the flag is false or null.

    On a stored table this is written as two plain comparisons, a form that is pushed
    into the Parquet scan. A flag just computed is never null and needs one.
    """
    if not df.schema["is_rejected"].nullable:
        return df.filter("not is_rejected")
    return df.filter("is_rejected is false or is_rejected is null")


def strictly_accepted(df: DataFrame) -> DataFrame:
    """Rows known to be clean: flag false, or no reason where the flag is absent."""
    if "is_rejected" in df.columns:
        return df.filter("is_rejected = false")
    if "rejection_reason" in df.columns:
        return df.filter("rejection_reason is null")
    return df


def drop_quality_flags(df: DataFrame) -> DataFrame:
    return df.drop(*QUALITY_FLAGS)


def drop_complex_columns(df: DataFrame) -> DataFrame:
    """Drop struct, array and map columns, which a flat sink cannot take."""
    complex_types = (T.StructType, T.ArrayType, T.MapType)
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, complex_types)])


def fill_nulls_by_type(df: DataFrame) -> DataFrame:
    """'' for strings, false for booleans, 0 for numbers; dates and times stay null."""
    fills: dict[str, Any] = {}
    numeric = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            fills[field.name] = ""
        elif isinstance(field.dataType, T.BooleanType):
            fills[field.name] = False
        elif isinstance(field.dataType, numeric):
            fills[field.name] = 0
    return df.fillna(fills) if fills else df
