from __future__ import annotations

import hashlib
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telmart.functions import casts, enrich, keys


def one(df, expression):
    return df.select(expression.alias("v")).first()["v"]


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def moment(text):
    return F.lit(text).cast("timestamp_ntz")


def test_bad_text_becomes_null(unit):
    assert one(unit, casts.to_number(F.lit("abc"))) is None
    assert one(unit, casts.to_moment(F.lit("INVALID_DATE"))) is None
    assert one(unit, casts.to_moment(F.lit("2025-13-45 25:99:99"))) is None
    assert one(unit, casts.to_integer(F.lit("480.0"))) == 480
    assert one(unit, casts.to_moment(F.lit("2025-01-02 03:04:05"))) == datetime(2025, 1, 2, 3, 4, 5)


def test_two_day_formats(unit):
    for text, expected in (("2025-1-5", "2025-01-05"), ("2025-01-05 06:07:08", "2025-01-05")):
        day = casts.to_day(F.lit(text), "yyyy-M-d", "yyyy-M-d H:m:s")
        assert str(one(unit, day)) == expected
    assert one(unit, casts.to_day(F.lit("soon"), "yyyy-M-d", "yyyy-M-d H:m:s")) is None


def test_surrogate_keys(unit):
    a, none, n = F.lit("a"), F.lit(None).cast("string"), F.lit(7).cast("long")
    assert one(unit, keys.surrogate_key(n, a)) == md5("7a")
    assert one(unit, keys.surrogate_key(a, none)) is None
    assert one(unit, keys.surrogate_key(a, none, null_as_empty=True)) == md5("a")
    assert one(unit, keys.surrogate_key(a, n, a, sep="|")) == md5("a|7|a")


def test_date_and_time_keys(unit):
    at = moment("2025-05-06 13:45:10")
    assert one(unit, keys.date_key(at)) == md5("2025-05-06")
    assert one(unit, keys.date_key(F.lit(None).cast("timestamp_ntz"))) == md5("1970-01-01")
    assert one(unit, keys.time_key(at)) == 825
    assert one(unit, keys.time_key(at, keys.MINUTE_OF_HOUR)) == 45
    with pytest.raises(ValueError):
        keys.time_key(at, "second")


def test_tac(unit):
    assert one(unit, enrich.tac_of(F.lit("123456789012345"))) == "12345678"
    assert one(unit, enrich.tac_of(F.lit("0123456789"))) == "01234567"
    assert one(unit, enrich.tac_of(F.lit("1234567"))) == ""
    assert one(unit, enrich.tac_of(F.lit(None).cast("string"))) == ""


def test_distance(unit):
    cairo_alexandria = enrich.haversine_km(*[F.lit(x) for x in (30.0444, 31.2357, 31.2001, 29.9187)])
    assert one(unit, cairo_alexandria) == pytest.approx(179.6, abs=1.0)
    quarter = enrich.haversine_km(*[F.lit(float(x)) for x in (0, 0, 0, 90)])
    assert one(unit, quarter) == pytest.approx(math.pi / 2 * 6371)


@pytest.mark.parametrize(
    "text, expected",
    [("2025-09-06 21:00:00", 5.04), ("2025-07-01 07:00:00", 1.2), ("2025-01-01 03:00:00", 0.3)],
)
def test_seasonal(unit, text, expected):
    assert one(unit, enrich.seasonal_multiplier(moment(text))) == pytest.approx(expected)


def test_short_call(unit):
    flag = enrich.short_call_flag
    assert one(unit, flag(F.lit("International"), F.lit(29))) == "WANGIRI_FRAUD"
    assert one(unit, flag(F.lit("International"), F.lit(30))) is None
    assert one(unit, flag(F.lit("Local"), F.lit(1))) is None


@pytest.mark.parametrize(
    "age, expected",
    [
        ("17", "<18"), ("18", "18-29"), ("29", "18-29"), ("30", "30-44"), ("44", "30-44"),
        ("45", "45-59"), ("59", "45-59"), ("60", "60+"), (None, "unknown"), ("old", "unknown"),
        ("17.5", "unknown"),
    ],
)
def test_age_group(unit, age, expected):
    assert one(unit, enrich.age_group(F.lit(age).cast("string"))) == expected
