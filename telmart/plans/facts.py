"""Fact models: one declarative spec per fact, one builder for all of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmart.functions.enrich import tac_of
from telmart.functions.keys import (
    KEY_NAME,
    LEGACY_KEY_NAME,
    MINUTE_OF_DAY,
    date_key,
    epoch,
    surrogate_key,
    time_key,
)
from telmart.functions.casts import to_moment
from telmart.operators.shape import Projected, accepted, projected
from telmart.session import split_wide_code

EVENT_DAY = "event_day"


@dataclass(frozen=True)
class FactModel:
    """``columns`` in table order; computed ones (timestamp, TACs) by name alone."""

    table: str
    source: str
    key_parts: tuple[str, ...]
    columns: tuple[Projected | str, ...]


def _text(target: str, source: str | None = None) -> Projected:
    return Projected(target, source or target, "string", "")


def _kept(target: str, source: str | None = None) -> Projected:
    return Projected(target, source or target)


def _double(target: str, default: float = 0.0) -> Projected:
    return Projected(target, target, "double", default)


def _long(target: str) -> Projected:
    return Projected(target, target, "bigint", 0)


def _flag(target: str) -> Projected:
    return Projected(target, target, "boolean", False)


# Computed columns, named where they stand in the table.
MOMENT = "timestamp"
FROM_TAC = "from_tac"
TO_TAC = "to_tac"

_PARTY_KEY = ("event_type", "{id}", "from_phone_number", "to_phone_number", "timestamp")
_CUSTOMER_KEY = ("event_type", "{id}", "customer_phone", "timestamp")


def _key(parts: Sequence[str], id_column: str) -> tuple[str, ...]:
    return tuple(p.format(id=id_column) for p in parts)


# Names, order, sources and defaults of the columns, and the parts of the keys.
FACT_MODELS = {
    "calls": FactModel(
        "fact_calls",
        "calls",
        _key(_PARTY_KEY, "call_id"),
        (
            _kept("call_id", "sid"), _kept("event_type"),
            _text("from_phone_number"), _text("to_phone_number"),
            _text("from_cell_site"), _text("to_cell_site"),
            _text("from_imei"), _text("to_imei"), FROM_TAC, TO_TAC,
            MOMENT, _text("status"), _long("call_duration_seconds"),
            _double("amount"), _text("currency"), _text("call_type"),
        ),
    ),
    "payment": FactModel(
        "fact_payment",
        "payment",
        _key(_CUSTOMER_KEY, "payment_id"),
        (
            _kept("payment_id", "sid"), _kept("event_type"), _kept("customer_phone", "customer"),
            _text("phone_number"), _text("payment_type"), _double("payment_amount"),
            _text("payment_method"), _text("status"), MOMENT, _text("transaction_id"),
            _text("invoice_number"), _double("seasonal_multiplier", 1.0),
            _double("amount"), _text("currency"),
        ),
    ),
    "recharge": FactModel(
        "fact_recharge",
        "recharge",
        _key(_CUSTOMER_KEY, "recharge_id"),
        (
            _kept("recharge_id", "sid"), _text("transaction_id"), _kept("event_type"),
            _kept("customer_phone", "customer"), _double("balance_after"),
            _double("balance_before"), _double("amount"), _text("currency"), MOMENT,
            _text("payment_method"), _text("phone_number"),
        ),
    ),
    "sms": FactModel(
        "fact_sms",
        "sms",
        _key(_PARTY_KEY, "sms_id"),
        (
            _kept("sms_id", "sid"), _kept("event_type"),
            _text("from_phone_number"), _text("to_phone_number"),
            _text("from_imei"), _text("to_imei"), FROM_TAC, TO_TAC,
            _text("from_cell_site"), _text("to_cell_site"), MOMENT, _text("status"),
            _double("jitter_ms"), _long("latency_ms"), _long("signal_strength_dbm"),
            _double("amount"), _text("currency"),
        ),
    ),
    "support": FactModel(
        "fact_support",
        "support",
        ("event_type", "support_id", "customer_phone", "escalated", "timestamp"),
        (
            _kept("support_id", "sid"), _kept("event_type"), _kept("customer_phone", "customer"),
            _text("phone_number"), _text("channel"), _text("reason"),
            _long("wait_time_seconds"), _long("resolution_time_seconds"), _text("agent_id"),
            _long("satisfaction_score"), MOMENT, _flag("first_call_resolution"),
            _flag("escalated"), _flag("call_back_requested"),
        ),
    ),
}


def build_fact(
    silver: DataFrame,
    name: str,
    time_mode: str = MINUTE_OF_DAY,
    key_name: str = KEY_NAME,
    sep: str = "",
) -> DataFrame:
    """Accepted silver rows as a fact: defaults first, keys from the defaulted values.

    Columns the silver table lacks take their defaults. A timestamp that does not parse
    is the epoch. The plan is scan, filter, project: no shuffle. Keys are text hashes
    that only the columns they name feed, so an unused key costs nothing.
    """
    model = FACT_MODELS[name]
    split_wide_code(silver.sparkSession)
    rows = _modelled(accepted(silver), model)
    moment = F.col(f"`{MOMENT}`")
    return rows.select(
        surrogate_key(
            *[F.col(f"`{p}`") for p in model.key_parts], sep=sep, null_as_empty=True
        ).alias(key_name),
        date_key(moment).alias("date_sk"),
        time_key(moment, time_mode).alias("time_sk"),
        "*",
    )


def with_rejected(silver: DataFrame, name: str) -> DataFrame:
    """The model's columns of all rows, rejected ones too, for which no rule is checked.

    Lookups may look for frequent keys in it (``keys_from``): of a fact built on the way,
    checking the rules costs more than all the rest. The rejected rows lower a key's share at most
    by their own; a key that is missed for that leaves a larger partition, which adaptive execution splits.
    """
    return _modelled(silver, FACT_MODELS[name])


def _modelled(silver: DataFrame, model: FactModel) -> DataFrame:
    def column(spec: Projected | str):
        if isinstance(spec, Projected):
            return projected(silver, spec)
        if spec == MOMENT:
            return F.coalesce(to_moment(F.col("`timestamp`")), epoch()).alias(MOMENT)
        imei = Projected(spec, spec.replace("_tac", "_imei"))
        return tac_of(projected(silver, imei)).alias(spec)

    return silver.select(*[column(s) for s in model.columns])


def with_event_day(fact: DataFrame) -> DataFrame:
    """Add the day of the fact's moment, the column that stored facts are partitioned by."""
    return fact.withColumn(EVENT_DAY, F.col(f"`{MOMENT}`").cast("date"))
