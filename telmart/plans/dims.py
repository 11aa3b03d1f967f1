"""Dimension models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telmart.functions.casts import filled, to_day
from telmart.functions.enrich import age_group, period_of_day
from telmart.functions.keys import EPOCH_DAY, surrogate_key
from telmart.operators.dedup import first_row_per_key
from telmart.operators.position import with_position
from telmart.operators.scd import OPEN_END
from telmart.sources.series import covering_date_series, date_series, minute_series


@dataclass(frozen=True)
class DimModel:
    """A hashed dimension: key column and its parts, then (target, source) columns."""

    table: str
    seed: str
    key: str
    key_parts: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


# Columns of the hashed dimensions and the parts of their keys.
DIM_MODELS = {
    "cell_site": DimModel(
        "dim_cell_site", "cell_site", "cell_sk", ("cell_id", "city"),
        _same("cell_id", "city", "site_name", "latitude", "longitude"),
    ),
    "user": DimModel(
        "dim_user", "user", "user_sk", ("user_id", "phone_number"),
        (
            ("user_id", "user_sk"), ("phone_number", "msisdn"), ("plan_type", "customer_type"),
            *_same(
                "gender", "age_group", "city", "activation_date", "status",
                "effective_from", "effective_to", "is_current",
            ),
        ),
    ),
    "device": DimModel(
        "dim_device", "device", "device_sk", ("tac", "brand"), _same("tac", "brand", "model"),
    ),
    "agent": DimModel(
        "dim_agent", "agent", "agent_sk", ("agent_id", "name", "department"),
        _same("agent_id", "name", "department", "city", "status"),
    ),
}


def build_dim(seed: DataFrame, name: str, sep: str = "") -> DataFrame:
    """Distinct projection of a seed with its md5 key in front.

    The distinct runs inside the tasks first, so repeated rows shrink before the shuffle.
    """
    model = DIM_MODELS[name]
    rows = seed.select(*[F.col(s).alias(t) for t, s in model.columns]).distinct()
    key = surrogate_key(*[F.col(p) for p in model.key_parts], sep=sep)
    return rows.select(key.alias(model.key), "*")


def calendar(days: DataFrame, extended: bool = False, unknown_member: bool = False) -> DataFrame:
    """dim_date rows for a ``date_value`` series.

    ``extended`` adds day_of_week and is_weekend; ``unknown_member`` adds the epoch day
    that facts without a usable timestamp point to.
    """
    if unknown_member:
        epoch_day = days.sparkSession.range(1).select(
            F.lit(EPOCH_DAY).cast("date").alias("date_value")
        )
        days = days.filter(F.col("date_value") != F.lit(EPOCH_DAY).cast("date")).union(epoch_day)
    day = F.col("date_value")
    iso = day.cast("string")
    columns = [
        F.md5(iso).alias("date_sk"),
        day.alias("full_date"),
        iso.alias("date"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    ]
    if extended:
        columns += [
            F.date_format(day, "EEEE").alias("day_of_week"),
            (F.weekday(day) >= 5).alias("is_weekend"),
        ]
    return days.select(*columns)


def build_dim_date(
    spark: SparkSession,
    start: str = "2025-01-01",
    end: str = "2025-12-31",
    extended: bool = False,
    unknown_member: bool = False,
) -> DataFrame:
    return calendar(date_series(spark, start, end), extended, unknown_member)


def build_dim_date_covering(df: DataFrame, moment: str, extended: bool = False) -> DataFrame:
    """dim_date for exactly the range of days a frame spans."""
    return calendar(covering_date_series(df, moment), extended)


def build_dim_time(spark: SparkSession, extended: bool = False) -> DataFrame:
    """1440 minutes of the day; ``extended`` adds time_period."""
    minute = F.col("minute_of_day")
    hour = F.floor(minute / 60)
    columns = [
        minute.alias("time_key"),
        minute.cast("string").alias("time_value"),
        hour.cast("string").alias("hour"),
        (minute % 60).cast("string").alias("minute"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
    ]
    if extended:
        columns.append(period_of_day(hour).alias("time_period"))
    return minute_series(spark).select(*columns)


def _first_filled(df: DataFrame, *names: str) -> Column:
    """First non-blank of the columns the frame has."""
    present = [filled(F.col(n).cast("string")) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def build_user_seed(raw: DataFrame, position_order: Sequence[str] = ()) -> DataFrame:
    """User seed from a raw master: fallbacks, dates in two formats, age buckets.

    Users get consecutive numbers in source order and one open version each. Gender and
    dates that the master lacks become 'Unknown' and null.
    """
    started = to_day(
        _first_filled(raw, "activation_date", "registration_date"), "yyyy-M-d", "yyyy-M-d H:m:s"
    ).cast("string")
    bucket = age_group(F.col("age")) if "age" in raw.columns else F.lit("unknown")
    numbered = with_position(raw, "user_sk", position_order)
    return numbered.select(
        "user_sk",
        _first_filled(raw, "phone_number", "msisdn").alias("msisdn"),
        F.coalesce(_first_filled(raw, "plan_type", "customer_type"), F.lit("Prepaid")).alias(
            "customer_type"
        ),
        F.coalesce(_first_filled(raw, "gender"), F.lit("Unknown")).alias("gender"),
        F.coalesce(_first_filled(raw, "age_group"), bucket).alias("age_group"),
        F.coalesce(_first_filled(raw, "city", "region"), F.lit("Unknown")).alias("city"),
        started.alias("activation_date"),
        F.coalesce(_first_filled(raw, "status"), F.lit("Active")).alias("status"),
        started.alias("effective_from"),
        F.lit(OPEN_END).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def build_device_seed(raw: DataFrame, position_order: Sequence[str] = ()) -> DataFrame:
    """Device seed from a raw master: blank codes dropped, first row per code wins.

    ``device_sk`` is the position in the source, so dropped rows leave gaps.
    """
    numbered = with_position(raw, "device_sk", position_order)
    tac = F.regexp_replace("tac", r"^\s+|\s+$", "")
    smartphone = F.col("is_smartphone") if "is_smartphone" in raw.columns else F.lit(None)
    rows = numbered.select(
        "device_sk",
        F.concat(tac, F.lit("0000000")).alias("imei"),
        tac.alias("tac"),
        F.coalesce(_first_filled(raw, "manufacturer", "brand"), F.lit("Unknown")).alias("brand"),
        F.coalesce(_first_filled(raw, "model"), F.lit("Generic")).alias("model"),
        F.coalesce(_first_filled(raw, "os"), F.lit("Unknown")).alias("os"),
        F.coalesce(smartphone.cast("boolean"), F.lit(True)).alias("is_smartphone"),
    ).filter("tac <> ''")
    return first_row_per_key(rows, ["tac"], ["device_sk"])
