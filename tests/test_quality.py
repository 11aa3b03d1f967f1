from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telmart.operators import quality, shape
from telmart.plans.silver import SILVER_MODELS, to_silver
from telmart.schemas import EVENT_TYPES, drift_report, frame_fields, raw_schema
from tests.conftest import rows_of

CALL = {
    "event_type": "call", "sid": "CA1",
    "from": ("01012345678", "CELL00001", "358462791234567"),
    "to": ("01087654321", "CELL00002", "358462701234567"),
    "call_duration_seconds": "480", "status": "completed", "timestamp": "2025-05-06 13:45:00",
    "call_type": "Local", "billing_info": ("1.28", "EGP"),
}
SUPPORT = {
    "event_type": "support", "sid": "SU1", "customer": "01012345678", "channel": "phone",
    "reason": "billing", "wait_time_seconds": "60", "resolution_time_seconds": "300",
    "agent_id": "AG1001", "satisfaction_score": "4", "timestamp": "2025-05-06 13:45:00",
    "phone_number": "01012345678", "first_call_resolution": True, "escalated": False,
}


def events(spark, event_type, *changes):
    base = {"call": CALL, "support": SUPPORT}[event_type]
    schema = raw_schema(event_type)
    rows = [[{**base, **c}.get(f) for f in schema.names] for c in changes]
    return spark.createDataFrame(rows, schema)


def reasons(spark, event_type, *changes):
    checked = to_silver(events(spark, event_type, *changes).coalesce(1), event_type)
    return [r["rejection_reason"] for r in checked.select("rejection_reason").collect()]


def test_call_rules(spark):
    def billing(amount):
        return {"billing_info": (amount, "EGP")}

    found = reasons(
        spark, "call",
        {},
        billing(None),
        billing("0.0"),
        billing("abc"),
        {"sid": None, "from": (None, "CELL00001", "1")},
        *[{"call_duration_seconds": d} for d in ("-10", "0", "3600", "3601")],
        {"timestamp": "INVALID_DATE"},
    )
    outside = "call_duration_seconds must be between 0 and 3600, "
    assert found == [
        None,
        "amount come with null value, amount must be numeric, ",
        "amount must be positive, ",
        "amount must be numeric, ",
        "sid come with null value, from_phone_number come with null value, ",
        outside, None, None, outside,
        None,
    ]


def test_support_rules(spark):
    found = reasons(
        spark, "support", {}, {"wait_time_seconds": "0"}, {"satisfaction_score": None},
        {"satisfaction_score": "6"},
    )
    assert found == [
        None, "wait_time_seconds must be positive, ", "satisfaction_score must be numeric, ",
        "satisfaction_score must be between 1 and 5, ",
    ]


def test_flag_matches_reason_and_types(spark):
    silver = to_silver(events(spark, "call", {}, {"sid": None}), "call")
    assert rows_of(silver.selectExpr("is_rejected = (rejection_reason is not null)")) == [(True,)] * 2
    types = dict(silver.dtypes)
    assert types["amount"] == "double" and types["call_duration_seconds"] == "bigint"
    assert types["qos_metrics"].startswith("struct<mos_score:double")
    assert "from" not in types and "from_imei" in types


def test_reason_is_cut(spark):
    wide = spark.createDataFrame([tuple([None] * 60)], ", ".join(f"column_{i:02d} string" for i in range(60)))
    rules = quality.RuleSet(required=tuple(wide.columns))
    reason = quality.add_rejection_reason(wide, rules).first()["rejection_reason"]
    assert len(reason) == 1000


def test_absent_columns(spark):
    df = spark.createDataFrame([("a",)], "sid string")
    rules = quality.RuleSet(required=("sid", "status"), numeric=("amount",))
    assert quality.add_rejection_reason(df, rules).first()["rejection_reason"] is None
    strict = quality.add_rejection_reason(df, rules, missing=quality.REJECT).first()
    assert strict["rejection_reason"] == "status come with null value, " and strict["is_rejected"]
    none = quality.add_rejection_reason(df, quality.RuleSet()).first()
    assert none["rejection_reason"] is None and none["is_rejected"] is False


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("phone", ["01012345678"], ["0000000000", "+20123456789", "  0101  "]),
        ("imei", ["358462791234567"], ["0123456789", "12345678901234F"]),
        ("cell_site", ["CELL00001"], ["INVALID_CELL"]),
        ("timestamp", ["2025-01-01 00:00:00"], ["INVALID_DATE", "2025-13-45 25:99:99"]),
    ],
)
def test_format_rules(spark, kind, good, bad):
    values = [*good, None, *bad]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    checked = quality.add_rejection_reason(df, quality.RuleSet(formats={"v": kind}))
    rejected = {r["i"]: r["is_rejected"] for r in checked.collect()}
    assert [rejected[i] for i in range(len(values))] == [False] * (len(good) + 1) + [True] * len(bad)


texts = st.one_of(
    st.none(), st.sampled_from(["", "abc", "0", "-1", "5", "3600", "3600.5", " 7 ", "1e3", "NaN"]),
    st.integers(-10, 4000).map(str),
)


def expected_reason(a, b):
    """The rules of the property test, in plain Python."""

    def number(text):
        try:
            return None if text is None else float(text)
        except ValueError:
            return None

    reason = ""
    for name, value in (("a", a), ("b", b)):
        if value is None:
            reason += f"{name} come with null value, "
    if number(a) is None:
        reason += "a must be numeric, "
    for name, value in (("a", a), ("b", b)):
        n = number(value)
        if n is not None and n <= 0:
            reason += f"{name} must be positive, "
    n = number(b)
    # Spark orders NaN above every number.
    if n is not None and (n < 0 or n > 3600 or math.isnan(n)):
        reason += "b must be between 0 and 3600, "
    return reason or None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=40))
def test_rules_equal_plain_python(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    rules = quality.RuleSet(
        required=("a", "b"), numeric=("a",), positive=("a", "b"), between={"b": (0, 3600)}
    )
    found = {r["i"]: r["rejection_reason"] for r in quality.add_rejection_reason(df, rules).collect()}
    assert [found[i] for i in range(len(rows))] == [expected_reason(*r) for r in rows]


def test_plan_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    few = quality.RuleSet(required=("a",))
    many = quality.RuleSet(
        ("a", "b"), ("a", "b"), ("a", "b"), {"a": (0, 5)}, ("a", "b"), {"a": "phone"}
    )
    sizes = set()
    for rules in (few, many):
        checked = quality.add_rejection_reason(df, rules)
        sizes.add(checked._jdf.queryExecution().optimizedPlan().toString().count("Project"))
    assert len(sizes) == 1 and sizes.pop() <= 2


def test_rejection_report_and_split(spark):
    silver = to_silver(
        events(spark, "call", {}, {"sid": None}, {"sid": None, "billing_info": (None, "EGP")}), "call"
    )
    assert rows_of(quality.rejection_report(silver, "event_type")) == [
        ("call", "amount come with null value", 1), ("call", "amount must be numeric", 1),
        ("call", "sid come with null value", 2),
    ]
    valid, rejected = quality.split_by_quality(silver)
    assert (valid.count(), rejected.count()) == (1, 2)


def test_accept_filters(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, is_rejected boolean")
    assert rows_of(shape.accepted(df).select("i")) == [(2,), (3,)]
    assert rows_of(shape.strictly_accepted(df).select("i")) == [(2,)]
    reason_only = spark.createDataFrame([(1, "x"), (2, None)], "i int, rejection_reason string")
    assert rows_of(shape.strictly_accepted(reason_only).select("i")) == [(2,)]
    assert shape.strictly_accepted(df.select("i")).count() == 3


def test_orphans_ignore_unknown_members(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), ("",), (None,)], "k string")
    dim = spark.createDataFrame([("a",)], "k string")
    assert rows_of(quality.orphan_keys(fact, "k", dim, "k")) == [("b", 2)]
    report = quality.integrity_report(fact, {"k": (dim, "k")})
    assert rows_of(report) == [("k", 1, 2)]


def test_profile_and_sample(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    assert rows_of(quality.profile_table(df)) == [
        (1, "i", "int", True, 2), (2, "s", "string", True, 2),
    ]
    assert quality.sample_rows(spark.range(10)).count() == 5


def test_drift(spark):
    df = spark.createDataFrame([("x", 1)], "event_type string, surprise int")
    found = dict((r["column_name"], r["drift"]) for r in drift_report(frame_fields(df), "call").collect())
    assert found["surprise"] == "unexpected" and found["sid"] == "missing"
    assert "event_type" not in found


def test_every_model_reads_known_columns():
    assert set(SILVER_MODELS) == set(EVENT_TYPES)
