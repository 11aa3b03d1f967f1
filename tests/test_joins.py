from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telmart.operators import joins
from telmart.operators.aggregates import daily_measures, drill_across, load_counts
from telmart.operators.dedup import first_row_per_key, last_row_per_key
from telmart.operators.position import with_position
from telmart.plans.facts import build_fact, with_rejected
from telmart.plans.silver import to_silver
from checks import bindings as b
from tests.conftest import SF_DIR, rows_of


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def calls(spark):
    """A third of the rows share one caller, a fifth have none, some callers are unknown."""
    return spark.range(6000).selectExpr(
        "id",
        """case when id % 3 = 0 then 'hot' when id % 5 = 1 then null
           else concat('k', id % 900) end as from_phone_number""",
        "concat('k', id % 11) as to_phone_number",
        "timestamp_ntz'2025-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 100 as int)) as moment",
    )


@pytest.fixture(scope="module")
def users(spark):
    known = spark.range(700).selectExpr(
        "concat('k', id) as phone_number", "concat('city', id % 7) as city", "true as is_current"
    )
    hot = spark.sql("select 'hot' as phone_number, 'hotcity' as city, true as is_current")
    stale = spark.sql("select 'k1' as phone_number, 'old' as city, false as is_current")
    return known.union(hot).union(stale)


def test_salted_lookup_equals_broadcast_lookup(calls, users):
    small = joins.with_users(calls, users, ["city"])
    large = joins.with_users(calls, users, ["city"], max_bytes=0)
    assert "BroadcastHashJoin" in plan_of(small)
    assert rows_of(small) == rows_of(large)
    assert large.count() == 6000


def test_inner_lookup(calls, users):
    current = users.filter("is_current")
    plain = calls.join(current, calls.from_phone_number == current.phone_number)
    for limit in (0, joins.MAX_BROADCAST_BYTES):
        found = joins.lookup_join(
            calls, current, "from_phone_number", "phone_number", ["city"], "u_", "inner",
            max_bytes=limit,
        )
        assert found.count() == plain.count()


def test_measured_size_counts_nested_and_text_bytes(spark):
    base = joins.measured_bytes(spark.sql("select 1 as i"))
    assert joins.measured_bytes(spark.sql("select 1 as i, repeat('x', 1000) as s")) >= base + 1000
    assert joins.measured_bytes(spark.sql("select 1 as i, array_repeat('x', 1000) as a")) > base + 1000
    assert joins.measured_bytes(spark.sql("select 1 as i where false")) == 0


def test_frequent_keys_are_the_hot_ones(calls):
    found = joins.frequent_keys(calls, ["from_phone_number", "to_phone_number"], 0.05)
    assert list(found["from_phone_number"]) == ["hot"] and 0.3 < found["from_phone_number"]["hot"] < 0.4
    assert len(found["to_phone_number"]) == 11


def test_hot_key_is_spread_over_the_shuffle(spark, calls, users):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        wide = joins.lookup_join(
            calls, users.filter("is_current"), "from_phone_number", "phone_number", ["city"], "u_",
            max_bytes=0,
        )
        sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    # Unsalted, the hot key's 2000 rows would lie in one partition; the average is 375.
    assert len(sizes) == 16 and max(sizes) < 1000


def test_copies_of_one_row_are_spread(spark, users):
    copies = spark.range(0, 4000, 1, 16).selectExpr("'hot' as from_phone_number")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        wide = joins.lookup_join(
            copies, users.filter("is_current"), "from_phone_number", "phone_number", ["city"], "u_",
            max_bytes=0,
        )
        sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_lookups_scan_the_fact_once(spark, calls, users, tmp_path):
    calls.write.parquet(str(tmp_path / "f"))
    users.write.parquet(str(tmp_path / "d"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    dim = spark.read.parquet(str(tmp_path / "d"))
    plan = plan_of(joins.with_users(fact, dim, ["city"], max_bytes=0))
    assert plan.count(f"Location: InMemoryFileIndex(1 paths)[file:{tmp_path}/f]") == 1


def test_salted_lookups_read_needed_columns_only(spark, users, tmp_path):
    rows = spark.range(300).selectExpr(
        "cast(id as string) as transaction_sk", "case when id % 3 = 0 then 'hot' end as phone_number",
        *[f"repeat('x', 20) as unused_{k}" for k in range(5)], "cast(id as double) as amount",
    )
    rows.write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    wide = joins.lookup_join(fact, users.filter("is_current"), "phone_number", "phone_number", ["city"], "u_", max_bytes=0)
    plan = plan_of(wide.groupBy("u_city").agg(F.sum("amount")))
    assert "unused" not in plan.split("ReadSchema: ")[1].split("\n")[0] and "unused_1" not in plan


def test_a_measured_dimension_is_hashed_in_its_partitions(calls, users):
    hashed = joins.with_users(calls, users, ["city"], max_bytes=1)
    assert plan_of(hashed).count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan_of(hashed)
    assert rows_of(hashed) == rows_of(joins.with_users(calls, users, ["city"]))


def test_salts_and_frequent_keys_of_a_fact_built_on_the_way_are_cheap(spark, users, monkeypatch):
    silver = to_silver(b.raw_calls(spark, SF_DIR), "call")
    keys, looked_in = with_rejected(silver, "calls"), []
    monkeypatch.setattr(joins, "frequent_keys", lambda df, names: looked_in.append(df) or {n: {"": 0.1} for n in names})
    wide = joins.with_users(build_fact(silver, "calls"), users, ["city"], max_bytes=0, keys_from=keys)
    # No key is hashed for the salts, and no rule is checked where keys are looked for.
    assert "md5" not in plan_of(wide.groupBy("from_user_city").agg(F.sum("amount")))
    assert looked_in == [keys] and " Filter " not in plan_of(keys.select("from_phone_number"))
    assert keys.count() == silver.count() > build_fact(silver, "calls").count()
    assert wide.count() == build_fact(silver, "calls").count()


def test_a_key_gets_salts_by_its_share(spark):
    rows = spark.range(1000).selectExpr("case when id % 2 = 0 then 'a' when id % 10 = 1 then 'b' else cast(id as string) end as k")
    found = joins.frequent_keys(rows, ["k"], 0.05)["k"]
    assert {k: round(v, 1) for k, v in found.items()} == {"a": 0.5, "b": 0.1}
    fan = {r[0]: r[1] for r in joins._fan_out(rows, "k", found).collect()}
    assert fan == {"a": 8, "b": 2}  # of 4 salts in each of 4 partitions
    assert joins._fan_out(rows, "k", {}) is None


def test_no_fact_row_meets_every_version(spark):
    """One key with 5,000 versions and half of all rows: linear work, whichever way."""
    versions = spark.range(5_000).selectExpr(
        "if(id >= 0, 'hot', 'x') as phone_number", "concat('P', id) as plan_type",
        "cast(date_add(date '2000-01-01', cast(id as int)) as string) as effective_from",
        "case when id < 4999 then cast(date_add(date '2000-01-01', cast(id + 1 as int)) as string) end as effective_to",
    )
    facts = spark.range(40_000).selectExpr(
        "id as i", "case when id % 2 = 0 then 'hot' when id % 3 = 0 then 'cold' end as phone_number",
        "timestamp_ntz '1999-12-31 12:00:00' + make_dt_interval(cast(id % 6000 as int)) as timestamp",
    )
    for limit in (0, joins.MAX_BROADCAST_BYTES):
        wide = joins.with_user_as_of(facts, versions, columns=["plan_type"], max_bytes=limit)
        assert not any(k in plan_of(wide) for k in ("NestedLoop", "Cartesian"))
        rows = wide.collect()
        assert len(rows) == 40_000
        for r in rows:
            day = r["i"] % 6000 - 1  # of the version that holds
            wanted = f"P{min(day, 4999)}" if r["phone_number"] == "hot" and day >= 0 else None
            assert r["user_plan_type"] == wanted


def test_overlapping_and_open_versions(spark):
    versions = spark.createDataFrame(
        [("p", "A", None, "2025-01-01"), ("p", "B", "2024-06-01", None), ("p", "C", "2024-06-01", "2024-07-01"), ("q", "D", None, None)],
        "phone_number string, plan_type string, effective_from string, effective_to string",
    )
    facts = spark.sql(
        """select stack(5, 1, 'p', '2020-01-01', 2, 'p', '2024-06-15', 3, 'q', null, 4, 'q', '2024-01-01', 5, 'p', '2030-01-01')
           as (i, phone_number, t)"""
    ).selectExpr("i", "phone_number", "cast(t as timestamp_ntz) as timestamp")
    expected = [(1, "A"), (2, "B"), (3, "D"), (4, "D"), (5, "B")]
    for limit in (0, joins.MAX_BROADCAST_BYTES):
        wide = joins.with_user_as_of(facts, versions, columns=["plan_type"], max_bytes=limit)
        assert rows_of(wide.select("i", "user_plan_type")) == expected


def test_point_in_time_lookup(spark):
    versions = spark.createDataFrame(
        [
            ("p", "A", "2024-01-01", "2025-01-01"), ("p", "B", "2025-01-01", "9999-12-31"),
            ("q", "C", "2025-06-01", "9999-12-31"),
        ],
        "phone_number string, plan_type string, effective_from string, effective_to string",
    )
    facts = spark.sql(
        """select stack(5, 1, 'p', '2024-12-31 23:59:59', 2, 'p', '2025-01-01 00:00:00',
           3, 'q', '2025-01-01 00:00:00', 4, 'p', '2023-01-01 00:00:00', 5, null, '2025-01-01 00:00:00')
           as (i, phone_number, t)"""
    ).selectExpr("i", "phone_number", "cast(t as timestamp_ntz) as timestamp")
    expected = [(1, "A"), (2, "B"), (3, None), (4, None), (5, None)]
    for limit in (0, joins.MAX_BROADCAST_BYTES):
        wide = joins.with_user_as_of(facts, versions, columns=["plan_type"], max_bytes=limit)
        assert rows_of(wide.select("i", "user_plan_type")) == expected


def test_other_lookups(spark):
    devices = spark.createDataFrame([("35846279", "Samsung")], "tac string, brand string")
    rows = spark.createDataFrame([("35846279",), ("",)], "tac string")
    assert rows_of(joins.with_manufacturer(rows, devices)) == [("", None), ("35846279", "Samsung")]
    agents = spark.createDataFrame([("AG1", "Sales")], "agent_id string, department string")
    support = spark.createDataFrame([("AG1",), ("AG2",)], "agent_id string")
    assert rows_of(joins.with_agent(support, agents)) == [("AG1", "Sales"), ("AG2", None)]
    with pytest.raises(ValueError):
        joins.lookup_join(agents, agents, "agent_id", "agent_id", ["department"])
    with pytest.raises(ValueError):
        joins.lookup_join(support, agents, "agent_id", "agent_id", how="full")


def test_first_and_last_row(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("b", 2, None), (None, 5, "z")], "k string, o int, v string"
    )
    assert rows_of(first_row_per_key(df, ["k"], ["o"])) == [
        ("a", 1, "y"), ("b", 2, None), (None, 5, "z"),
    ]
    assert rows_of(last_row_per_key(df, ["k"], ["o"]))[0] == ("a", 3, "x")


def test_first_row_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as o", "cast(id as string) as v")
    plan = plan_of(first_row_per_key(df, ["k"], ["o"]))
    assert "partial_min" in plan and "Window" not in plan


def test_positions(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "(id * 7919) % 1000 as o", "id % 2 as tie")
    placed = {r["o"]: r["p"] for r in with_position(df, "p", ["o"]).collect()}
    assert placed == {o: o + 1 for o in range(1000)}
    scan = {r["id"]: r["p"] for r in with_position(df, "p").collect()}
    assert scan == {i: i + 1 for i in range(1000)}
    tied = [(r["p"], r["tie"], r["id"]) for r in with_position(df, "p", ["tie"]).collect()]
    assert [t[2] for t in sorted(tied)] == [*range(0, 1000, 2), *range(1, 1000, 2)]


def test_aggregates(spark):
    fact = spark.createDataFrame(
        [("d1", 1.0), ("d1", 2.0), ("d2", 4.0)], "date_sk string, amount double"
    )
    daily = daily_measures(fact, ["date_sk"], ["amount"], ["amount"])
    assert rows_of(daily) == [("d1", 2, 3.0, 1.5), ("d2", 1, 4.0, 4.0)]
    other = daily_measures(fact.filter("date_sk = 'd2'").withColumn("date_sk", F.lit("d3")), ["date_sk"])
    across = drill_across({"a": daily, "b": other}, ["date_sk"], ["n_rows"])
    assert rows_of(across) == [("d1", 2, None), ("d2", 1, None), ("d3", None, 1)]
    assert rows_of(load_counts({"a": fact, "b": fact.limit(1)})) == [(3, 1)]
