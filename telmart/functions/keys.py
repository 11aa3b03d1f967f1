"""Surrogate, date and time keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"
EPOCH_DAY = "1970-01-01"

KEY_NAME = "transaction_sk"
LEGACY_KEY_NAME = "trasnaction_sk"  # fixed value: the spelling older warehouses carry
KEY_NAMES = (KEY_NAME, LEGACY_KEY_NAME)

MINUTE_OF_DAY = "minute_of_day"
MINUTE_OF_HOUR = "minute_of_hour"


def surrogate_key(*parts: Column, sep: str = "", null_as_empty: bool = False) -> Column:
    """md5 of the concatenated parts.

    Dimensions leave the key null when a part is null; facts treat a null part as ''.
    """
    texts = [p.cast("string") for p in parts]
    if null_as_empty:
        texts = [F.coalesce(t, F.lit("")) for t in texts]
    if sep:
        texts = [piece for t in texts for piece in (F.lit(sep), t)][1:]
    return F.md5(F.concat(*texts))


def epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def date_key(moment: Column) -> Column:
    """md5 of the ISO day; the epoch day stands in for a null moment."""
    day = moment.cast("date").cast("string")
    return F.md5(F.coalesce(day, F.lit(EPOCH_DAY)))


def time_key(moment: Column, mode: str = MINUTE_OF_DAY) -> Column:
    """Minute of day (0-1439, matches dim_time) or minute of hour (0-59, legacy)."""
    if mode == MINUTE_OF_DAY:
        minutes = F.hour(moment) * 60 + F.minute(moment)
    elif mode == MINUTE_OF_HOUR:
        minutes = F.minute(moment)
    else:
        raise ValueError(f"unknown time key mode: {mode}")
    return F.coalesce(minutes, F.lit(0))
