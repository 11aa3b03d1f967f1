"""Column contracts of every layer.

Raw events are read with explicit schemas. Numeric and boolean leaves are read as text
(``raw_schema``), so a value such as ``"abc"`` survives until validation has named
it; ``event_schema`` then gives the silver type of each of those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_TYPES = ("call", "sms", "payment", "recharge", "support")

# Fields of the raw events.
_PARTY = "struct<phone_number:string,cell_site:string,imei:string>"
_BILLING = "struct<amount:double,currency:string>"
_QOS = "struct<mos_score:double,jitter_ms:double,packet_loss_percent:double,codec:string>"
_NETWORK = (
    "struct<signal_strength_dbm:bigint,latency_ms:bigint,packet_loss_percent:double,"
    "cell_congestion:string,handover_success:boolean,mos_score:double,jitter_ms:double,"
    "throughput_mbps:double>"
)

EVENT_DDL = {
    "call": (
        f"event_type string, sid string, `from` {_PARTY}, `to` {_PARTY}, "
        "call_duration_seconds bigint, status string, `timestamp` string, call_type string, "
        "phone_number string, customer string, behavior_profile string, "
        f"seasonal_multiplier double, billing_info {_BILLING}, qos_metrics {_QOS}, "
        "fraud_indicator string, risk_score bigint"
    ),
    "sms": (
        f"event_type string, sid string, `from` {_PARTY}, `to` {_PARTY}, body string, "
        "status string, `timestamp` string, phone_number string, customer string, "
        f"registration_date string, seasonal_multiplier double, billing_info {_BILLING}, "
        f"network_metrics {_NETWORK}"
    ),
    "payment": (
        "event_type string, sid string, customer string, payment_type string, "
        "payment_amount double, payment_method string, status string, `timestamp` string, "
        "phone_number string, transaction_id string, invoice_number string, "
        f"seasonal_multiplier double, billing_info {_BILLING}, _requires_retry boolean"
    ),
    "recharge": (
        "event_type string, sid string, customer string, recharge_amount double, "
        "balance_before double, balance_after double, payment_method string, status string, "
        "`timestamp` string, phone_number string, transaction_id string, "
        f"seasonal_multiplier double, billing_info {_BILLING}, _requires_followup boolean"
    ),
    "support": (
        "event_type string, sid string, customer string, channel string, reason string, "
        "wait_time_seconds bigint, resolution_time_seconds bigint, agent_id string, "
        "satisfaction_score bigint, `timestamp` string, phone_number string, "
        "first_call_resolution boolean, escalated boolean, call_back_requested boolean"
    ),
}

# Fields each raw event type is expected to carry (the drift contract).
EXPECTED_FIELDS = {
    "call": (
        "event_type", "sid", "timestamp", "from", "to", "status", "call_duration_seconds",
        "billing_info", "call_type",
    ),
    "sms": (
        "event_type", "sid", "timestamp", "from", "to", "status", "body", "billing_info",
        "customer_id", "network_metrics",
    ),
    "payment": (
        "event_type", "sid", "customer", "payment_type", "payment_amount", "payment_method",
        "status", "timestamp", "phone_number", "transaction_id", "invoice_number",
        "seasonal_multiplier", "billing_info",
    ),
    "recharge": (
        "event_type", "sid", "timestamp", "from", "to", "status", "body", "billing_info",
        "customer", "phone_number", "recharge_amount", "requires_followup",
        "seasonal_multiplier", "transaction_id",
    ),
    "support": (
        "event_type", "sid", "customer", "channel", "reason", "wait_time_seconds",
        "resolution_time_seconds", "agent_id", "satisfaction_score", "timestamp",
        "phone_number", "first_call_resolution", "escalated", "call_back_requested",
    ),
}

# Columns of the seed files.
SEED_DDL = {
    "cell_site": "cell_id string, city string, site_name string, latitude double, longitude double",
    "user": (
        "user_sk bigint, msisdn string, customer_type string, gender string, age_group string, "
        "city string, activation_date string, status string, effective_from string, "
        "effective_to string, is_current boolean"
    ),
    "device": (
        "device_sk bigint, imei string, tac string, brand string, model string, os string, "
        "is_smartphone boolean"
    ),
    "agent": "agent_id string, name string, department string, city string, status string",
    # Masters from which the user and device seeds are built.
    "raw_user": (
        "phone_number string, msisdn string, activation_date string, registration_date string, "
        "gender string, age string, age_group string, plan_type string, customer_type string, "
        "status string, city string, region string"
    ),
    "raw_device": (
        "tac string, manufacturer string, brand string, model string, os string, "
        "is_smartphone boolean"
    ),
}


def _ddl_schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def event_schema(event_type: str) -> T.StructType:
    """Logical schema of one raw event type."""
    return _ddl_schema(EVENT_DDL[event_type])


def _as_text(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _as_text(f.dataType), True) for f in data_type.fields]
        )
    return T.StringType() if isinstance(data_type, (T.NumericType, T.BooleanType)) else data_type


def raw_schema(event_type: str) -> T.StructType:
    """Reading schema: numbers and booleans arrive as text so that bad ones are not lost."""
    return _as_text(event_schema(event_type))


def seed_schema(name: str) -> T.StructType:
    return _ddl_schema(SEED_DDL[name])


def drift_report(observed: DataFrame, event_type: str) -> DataFrame:
    """Compare observed field names (``column_name``) with the contract of an event type.

    Returns one row per column that is ``missing`` from the data or ``unexpected`` in it.
    """
    spark = observed.sparkSession
    names = [(c,) for c in EXPECTED_FIELDS[event_type]]
    expected = spark.createDataFrame(names, "column_name string").withColumn("known", F.lit(True))
    seen = observed.select("column_name").distinct().withColumn("seen", F.lit(True))
    return (
        expected.join(seen, "column_name", "full_outer")
        .filter("known is null or seen is null")
        .select(
            F.lit(event_type).alias("event_type"),
            "column_name",
            F.when(F.col("seen").isNull(), "missing").otherwise("unexpected").alias("drift"),
        )
    )


def frame_fields(df: DataFrame) -> DataFrame:
    """Column names of a frame as rows, for ``drift_report``."""
    return df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")


def observed_fields(lines: DataFrame, text_column: str = "value") -> DataFrame:
    """Distinct top-level field names of JSON objects held one per row as text."""
    return lines.select(F.explode(F.json_object_keys(text_column)).alias("column_name")).distinct()
