"""Enrichment formulas as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0
SHORT_CALL_MARKER = "WANGIRI_FRAUD"
SHORT_CALL_SECONDS = 30
TAC_LENGTH = 8
HOUR_FACTORS = {(8, 18): 1.3, (19, 23): 1.5, (0, 6): 0.3}
WEEKEND_FACTOR = 1.4
SUMMER_MONTHS, SUMMER_FACTOR = (6, 8), 1.2
SEPTEMBER_FACTOR, SEPTEMBER_NIGHT_FACTOR = 1.6, 1.5
SEPTEMBER_NIGHT_HOURS = ((20, 23), (0, 3))
AGE_LIMITS = {"<18": 18, "18-29": 30, "30-44": 45, "45-59": 60}
OLDEST_GROUP, UNKNOWN_GROUP = "60+", "unknown"


def tac_of(imei: Column) -> Column:
    """Type allocation code: the first 8 characters, '' when the IMEI is shorter or null."""
    return F.when(F.length(imei) >= TAC_LENGTH, F.substring(imei, 1, TAC_LENGTH)).otherwise("")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between two points in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dlat = (phi2 - phi1) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2)) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(half_dlon), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def seasonal_multiplier(moment: Column, decimals: int | None = 2) -> Column:
    """Traffic multiplier by hour, weekend and month."""
    hour, month = F.hour(moment), F.month(moment)

    def factor(condition: Column, value: float) -> Column:
        return F.when(condition, value).otherwise(1.0)

    by_hour = F.coalesce(
        *[F.when(hour.between(*hours), value) for hours, value in HOUR_FACTORS.items()], F.lit(1.0)
    )
    september = month == 9
    night = reduce(lambda a, b: a | b, [hour.between(*h) for h in SEPTEMBER_NIGHT_HOURS])
    product = (
        by_hour
        * factor(F.weekday(moment) >= 5, WEEKEND_FACTOR)
        * factor(september, SEPTEMBER_FACTOR)
        * factor(september & night, SEPTEMBER_NIGHT_FACTOR)
        * factor(month.between(*SUMMER_MONTHS), SUMMER_FACTOR)
    )
    return product if decimals is None else F.round(product, decimals)


def short_call_flag(call_type: Column, duration_seconds: Column) -> Column:
    """Marker of a suspiciously short international call, else null."""
    suspicious = (call_type == "International") & (duration_seconds < SHORT_CALL_SECONDS)
    return F.when(suspicious, SHORT_CALL_MARKER)


def age_group(age: Column) -> Column:
    """Age bucket of a whole number given as text or number; anything else is 'unknown'."""
    text = age.cast("string")
    years = F.when(text.rlike("^-?[0-9]+$"), text.try_cast("int"))
    groups = [F.when(years < limit, name) for name, limit in AGE_LIMITS.items()]
    oldest = F.when(years.isNotNull(), OLDEST_GROUP)
    return F.coalesce(*groups, oldest, F.lit(UNKNOWN_GROUP))


def period_of_day(hour: Column) -> Column:
    """night 0-5, morning 6-11, afternoon 12-17, evening 18-23 (our boundaries)."""
    return (
        F.when(hour < 6, "night")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .otherwise("evening")
    )
