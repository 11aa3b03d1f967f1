from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telmart.functions.keys import MINUTE_OF_HOUR
from telmart.plans.dims import (
    build_device_seed,
    build_dim,
    build_dim_date,
    build_dim_date_covering,
    build_dim_time,
    build_user_seed,
)
from telmart.plans.facts import FACT_MODELS, LEGACY_KEY_NAME, build_fact
from telmart.plans.silver import SILVER_MODELS, to_silver
from telmart.schemas import raw_schema, seed_schema
from telmart.session import iceberg_conf, object_store_conf
from tests.conftest import rows_of
from tests.test_quality import events

CONTRACTS = {
    "calls": """transaction_sk date_sk time_sk call_id event_type from_phone_number to_phone_number
        from_cell_site to_cell_site from_imei to_imei from_tac to_tac timestamp status
        call_duration_seconds amount currency call_type""",
    "sms": """transaction_sk date_sk time_sk sms_id event_type from_phone_number to_phone_number
        from_imei to_imei from_tac to_tac from_cell_site to_cell_site timestamp status jitter_ms
        latency_ms signal_strength_dbm amount currency""",
    "payment": """transaction_sk date_sk time_sk payment_id event_type customer_phone phone_number
        payment_type payment_amount payment_method status timestamp transaction_id invoice_number
        seasonal_multiplier amount currency""",
    "recharge": """transaction_sk date_sk time_sk recharge_id transaction_id event_type
        customer_phone balance_after balance_before amount currency timestamp payment_method
        phone_number""",
    "support": """transaction_sk date_sk time_sk support_id event_type customer_phone phone_number
        channel reason wait_time_seconds resolution_time_seconds agent_id satisfaction_score
        timestamp first_call_resolution escalated call_back_requested""",
}


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("name", list(FACT_MODELS))
def test_fact_contract_and_plan(spark, name):
    event_type = next(t for t, m in SILVER_MODELS.items() if m.table == FACT_MODELS[name].source)
    empty = spark.createDataFrame([], raw_schema(event_type))
    fact = build_fact(to_silver(empty, event_type), name)
    assert fact.columns == CONTRACTS[name].split()
    assert "Exchange" not in fact._jdf.queryExecution().executedPlan().toString()


def test_wide_code_is_split_in_sessions_built_elsewhere(spark):
    limit, other = "spark.sql.codegen.hugeMethodLimit", spark.newSession()
    empty = other.createDataFrame([], raw_schema("call"))
    for found, wanted in (("65535", "8000"), ("4000", "4000")):
        other.conf.set(limit, found)
        build_fact(to_silver(empty, "call"), "calls")
        assert other.conf.get(limit) == wanted


def test_fact_values(spark):
    silver = to_silver(
        events(
            spark, "call", {}, {"timestamp": "INVALID_DATE", "sid": "CA2"},
            {"from": ("0101", None, "1234567"), "sid": "CA3"}, {"sid": None},
        ),
        "call",
    )
    rows = {r["call_id"]: r for r in build_fact(silver, "calls").collect()}
    assert sorted(rows) == ["CA1", "CA2", "CA3"]
    first = rows["CA1"]
    assert first["transaction_sk"] == md5("callCA1" "01012345678" "01087654321" "2025-05-06 13:45:00")
    assert (first["date_sk"], first["time_sk"]) == (md5("2025-05-06"), 825)
    assert (first["from_tac"], first["amount"], first["call_duration_seconds"]) == ("35846279", 1.28, 480)
    assert rows["CA2"]["timestamp"] == datetime(1970, 1, 1)
    assert rows["CA2"]["date_sk"] == md5("1970-01-01")
    assert (rows["CA3"]["from_tac"], rows["CA3"]["from_cell_site"]) == ("", "")
    legacy = build_fact(silver, "calls", MINUTE_OF_HOUR, LEGACY_KEY_NAME).filter("call_id = 'CA1'").first()
    assert (legacy["time_sk"], legacy["trasnaction_sk"]) == (45, first["transaction_sk"])


def test_null_flag_is_kept_and_optional_columns_default(spark):
    silver = to_silver(events(spark, "support", {}), "support").withColumn(
        "is_rejected", F.lit(None).cast("boolean")
    )
    fact = build_fact(silver.drop("satisfaction_score", "call_back_requested"), "support").first()
    assert (fact["satisfaction_score"], fact["call_back_requested"], fact["escalated"]) == (0, False, False)
    assert fact["transaction_sk"] == md5("supportSU1" "01012345678" "false" "2025-05-06 13:45:00")


def test_hashed_dims(spark):
    def seed(name, *rows):
        return spark.createDataFrame(list(rows), seed_schema(name))

    user = (7, "0101", "Prepaid", "Male", "18-29", "Cairo", "2024-01-01", "Active", "2024-01-01", "9999-12-31", True)
    dim = build_dim(seed("user", user, user), "user")
    assert dim.columns == (
        "user_sk user_id phone_number plan_type gender age_group city activation_date status "
        "effective_from effective_to is_current"
    ).split()
    assert [r["user_sk"] for r in dim.collect()] == [md5("70101")]
    device = build_dim(seed("device", (1, "i", "35846279", "Samsung", "G", "U", True)), "device")
    assert rows_of(device) == [(md5("35846279Samsung"), "35846279", "Samsung", "G")]
    site = build_dim(seed("cell_site", ("C1", "Cairo", "T", 1.0, 2.0), ("C2", None, "T", 1.0, 2.0)), "cell_site")
    assert rows_of(site.select("cell_sk")) == sorted([(md5("C1Cairo"),), (None,)], key=repr)
    agent = build_dim(seed("agent", ("AG1", "N", "D", "C", "Active")), "agent", sep="|")
    assert agent.first()["agent_sk"] == md5("AG1|N|D")


def test_calendar(spark):
    year = build_dim_date(spark)
    assert year.columns == ["date_sk", "full_date", "date", "year", "month", "day"]
    assert year.count() == 365
    row = year.filter("date = '2025-02-03'").first()
    assert (row["date_sk"], row["year"], row["month"], row["day"]) == (md5("2025-02-03"), "2025", "02", "03")
    wide = build_dim_date(spark, "2025-01-04", "2025-01-06", extended=True, unknown_member=True)
    found = {r["date"]: (r["day_of_week"], r["is_weekend"]) for r in wide.collect()}
    assert found["2025-01-04"] == ("Saturday", True) and found["2025-01-06"] == ("Monday", False)
    assert "1970-01-01" in found and len(found) == 4
    events_ = spark.sql("select timestamp_ntz'2025-01-01 10:00:00' as t union all select timestamp_ntz'2025-01-03 01:00:00'")
    assert build_dim_date_covering(events_, "t").count() == 3
    with pytest.raises(ValueError):
        build_dim_date(spark, "2025-01-02", "2025-01-01")


def test_minutes(spark):
    minutes = build_dim_time(spark, extended=True)
    assert minutes.count() == 1440
    rows = {r["time_key"]: tuple(r)[1:] for r in minutes.collect()}
    assert rows[0] == ("0", "0", "0", "AM", "night")
    assert rows[719][3] == "AM" and rows[720][3] == "PM"
    assert rows[1439] == ("1439", "23", "59", "PM", "evening")


def test_user_seed(spark):
    raw = spark.createDataFrame(
        [
            ("0101", None, "2024-03-01", None, "Male", "17", None, None, "Postpaid", None, None, "Delta"),
            ("", "0102", None, "2024-03-01 10:11:12", None, "old", None, "Gold", None, "Inactive", "Giza", None),
            (None, "0103", "soon", None, None, "60", "45-59", None, None, None, None, None),
        ],
        seed_schema("raw_user"),
    ).coalesce(1)
    found = rows_of(build_user_seed(raw))
    end = "9999-12-31"
    assert found == [
        (1, "0101", "Postpaid", "Male", "<18", "Delta", "2024-03-01", "Active", "2024-03-01", end, True),
        (2, "0102", "Gold", "Unknown", "unknown", "Giza", "2024-03-01", "Inactive", "2024-03-01", end, True),
        (3, "0103", "Prepaid", "Unknown", "45-59", "Unknown", None, "Active", None, end, True),
    ]


def test_device_seed(spark):
    raw = spark.createDataFrame(
        [
            (" 35846279 ", "Samsung", None, None, None, None),
            ("  ", "Blank", None, None, None, None),
            ("35846279", "Second", None, None, None, None),
            ("86945303", None, "Huawei", "P1", "Android", False),
            (None, "NoCode", None, None, None, None),
        ],
        seed_schema("raw_device"),
    ).coalesce(1)
    assert rows_of(build_device_seed(raw)) == [
        (1, "358462790000000", "35846279", "Samsung", "Generic", "Unknown", True),
        (4, "869453030000000", "86945303", "Huawei", "P1", "Android", False),
    ]


def test_session_settings():
    iceberg = iceberg_conf("local", "s3a://bucket/warehouse")
    assert iceberg["spark.sql.catalog.local.warehouse"] == "s3a://bucket/warehouse"
    store = object_store_conf("http://store:9000")
    assert not any("key" in k for k in store)
    assert object_store_conf("e", "a", "b")["spark.hadoop.fs.s3a.secret.key"] == "b"
