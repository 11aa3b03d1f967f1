"""Bronze-to-silver model: what is flattened, checked and typed per event type."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmart.functions.casts import cast_leniently
from telmart.operators.quality import SKIP, RuleSet, add_rejection_reason
from telmart.operators.shape import flatten_structs
from telmart.schemas import event_schema
from telmart.session import split_wide_code


@dataclass(frozen=True)
class SilverModel:
    table: str
    structs: Mapping[str, str]
    rules: RuleSet


# Structs and rules of every event type, in message order. A rule on a column that the batch lacks is skipped; support
# events, for one, have no status. The boolean rules are this library's. Scores are listed as numeric although they are
# optional, so a support event without a score is rejected.
SILVER_MODELS = {
    "call": SilverModel(
        "calls",
        {"from": "from", "to": "to", "billing_info": ""},
        RuleSet(
            required=(
                "event_type", "sid", "timestamp", "status", "from_phone_number",
                "to_phone_number", "call_duration_seconds", "amount", "currency", "call_type",
            ),
            numeric=("call_duration_seconds", "amount"),
            positive=("amount",),
            between={"call_duration_seconds": (0, 3600)},
        ),
    ),
    "sms": SilverModel(
        "sms",
        {"from": "from", "to": "to", "billing_info": "", "network_metrics": ""},
        RuleSet(
            required=(
                "event_type", "sid", "timestamp", "status", "from_phone_number",
                "to_phone_number", "from_cell_site", "to_cell_site", "from_imei", "to_imei",
                "body", "currency", "amount",
            ),
            numeric=("amount",),
            positive=("amount",),
            boolean=("handover_success",),
        ),
    ),
    "payment": SilverModel(
        "payment",
        {"billing_info": ""},
        RuleSet(
            required=(
                "event_type", "sid", "timestamp", "status", "customer", "payment_type",
                "payment_amount", "payment_method", "phone_number", "transaction_id",
                "seasonal_multiplier", "amount", "currency",
            ),
            numeric=("payment_amount", "amount"),
            positive=("payment_amount", "amount"),
            boolean=("_requires_retry",),
        ),
    ),
    "recharge": SilverModel(
        "recharge",
        {"billing_info": ""},
        RuleSet(
            required=(
                "event_type", "sid", "timestamp", "status", "customer", "phone_number",
                "recharge_amount", "balance_before", "balance_after", "payment_method",
                "transaction_id", "amount", "currency",
            ),
            numeric=("recharge_amount", "balance_before", "balance_after", "amount"),
            positive=("recharge_amount", "amount"),
            boolean=("_requires_followup",),
        ),
    ),
    "support": SilverModel(
        "support",
        {},
        RuleSet(
            required=(
                "event_type", "sid", "timestamp", "status", "customer", "phone_number",
                "channel", "reason", "wait_time_seconds", "resolution_time_seconds", "agent_id",
            ),
            numeric=("wait_time_seconds", "resolution_time_seconds", "satisfaction_score"),
            positive=("wait_time_seconds", "resolution_time_seconds"),
            between={"satisfaction_score": (1, 5)},
            boolean=("first_call_resolution", "escalated", "call_back_requested"),
        ),
    ),
}


def normalise(bronze: DataFrame, event_type: str) -> DataFrame:
    """Flatten the structs of an event type; values are still as they arrived."""
    return flatten_structs(bronze, SILVER_MODELS[event_type].structs)


def _silver_types(event_type: str) -> dict[str, T.DataType]:
    """Type of every column after flattening."""
    types: dict[str, T.DataType] = {}
    structs = SILVER_MODELS[event_type].structs
    for field in event_schema(event_type).fields:
        if field.name in structs and isinstance(field.dataType, T.StructType):
            prefix = structs[field.name]
            for inner in field.dataType.fields:
                name = f"{prefix}_{inner.name}" if prefix else inner.name
                types[name] = inner.dataType
        else:
            types[field.name] = field.dataType
    return types


def _typed_value(column: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """Cast text to a number or boolean where one is wanted, field by field inside structs."""
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        inner = {f.name: f.dataType for f in wanted.fields}
        fields = [
            _typed_value(column.getField(f.name), f.dataType, inner.get(f.name, f.dataType)).alias(
                f.name
            )
            for f in found.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(found, T.StringType) and isinstance(wanted, (T.NumericType, T.BooleanType)):
        return cast_leniently(column, wanted.simpleString())
    return column


def typed(flat: DataFrame, event_type: str) -> DataFrame:
    """Give numbers and booleans in text their silver type; other text becomes null."""
    wanted = _silver_types(event_type)
    return flat.select(
        *[
            _typed_value(
                F.col(f"`{f.name}`"), f.dataType, wanted.get(f.name, f.dataType)
            ).alias(f.name)
            for f in flat.schema.fields
        ]
    )


def validate(
    flat: DataFrame, event_type: str, rules: RuleSet | None = None, missing: str = SKIP
) -> DataFrame:
    """Check a normalised batch on the values as they arrived, then type them."""
    split_wide_code(flat.sparkSession)
    checked = add_rejection_reason(flat, rules or SILVER_MODELS[event_type].rules, missing)
    return typed(checked, event_type)


def to_silver(
    bronze: DataFrame, event_type: str, rules: RuleSet | None = None, missing: str = SKIP
) -> DataFrame:
    """Flatten, validate and type one event type. No shuffle; works on streams as well."""
    return validate(normalise(bronze, event_type), event_type, rules, missing)


def with_partition_day(silver: DataFrame) -> DataFrame:
    """Partition column of silver tables: the landing day, 'unknown' without one."""
    day = F.when(F.col("event_date") != "", F.col("event_date")).otherwise("unknown")
    return silver.withColumn("landing_day", day)
