"""Telecom-shaped inputs derived from the shared test tables.

lineitem plays calls, events plays sms and support, orders plays payments and
recharges; customer, part and supplier play the user, device, cell site and agent
masters. Defects are derived from keys, so both engines derive the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CALL_KEY = "(l_orderkey * 10 + l_linenumber)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _phone(key: str) -> str:
    return f"'010' || lpad(cast({key} as string), 8, '0')"


def _cell(key: str) -> str:
    return f"'CELL' || lpad(cast({key} as string), 5, '0')"


def _tac(key: str) -> str:
    return f"lpad(cast({key} as string), 8, '0')"


def _money(value: str) -> str:
    return f"cast(cast({value} as decimal(12,2)) as string)"


def _text_time(moment: str, shift: str = "0") -> str:
    shifted = f"timestampadd(SECOND, cast({shift} as int), {moment})"
    return f"substr(cast({shifted} as string), 1, 19)"


def _bad_time(key: str, good: str) -> str:
    return (
        f"case when {key} % 33 = 0 then 'INVALID_DATE' "
        f"when {key} % 33 = 1 then '2025-13-45 25:99:99' else {good} end"
    )


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = CALL_KEY
    caller = f"case when {k} % 31 = 0 then null else {_phone('l_partkey')} end"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'call' as event_type",
        f"case when {k} % 47 = 0 then null else 'CA' || cast({k} as string) end as sid",
        f"""named_struct(
            'phone_number', {caller},
            'cell_site', case when {k} % 25 = 0 then 'INVALID_CELL' when {k} % 26 = 0 then null
                         else {_cell('l_suppkey')} end,
            'imei', case when {k} % 21 = 0 then null when {k} % 20 = 0 then substr({_tac('l_partkey')}, 2)
                    else {_tac('l_partkey')} || '0000000' end) as `from`""",
        f"""named_struct(
            'phone_number', {_phone('l_suppkey')},
            'cell_site', {_cell('l_orderkey % 120')},
            'imei', {_tac('l_suppkey')} || '1234567') as `to`""",
        f"""case when {k} % 50 = 0 then null when {k} % 50 = 1 then '-10' when {k} % 50 = 2 then 'abc'
            else cast(cast(l_quantity as bigint) * 80 as string) end as call_duration_seconds""",
        "l_linestatus as status",
        f"{_bad_time(k, _text_time('l_shipdate', f'{k} % 86400'))} as `timestamp`",
        "case when l_returnflag = 'R' then 'International' else 'Local' end as call_type",
        f"{caller} as phone_number",
        f"{caller} as customer",
        f"""named_struct(
            'amount', case when {k} % 41 = 0 then null when {k} % 41 = 1 then 'abc'
                      when {k} % 41 = 2 then '0.0' else {_money('l_extendedprice')} end,
            'currency', 'EGP') as billing_info""",
        "named_struct('mos_score', '4.5', 'codec', 'AMR') as qos_metrics",
    )


def raw_sms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "'sms' as event_type",
        "case when event_id % 47 = 0 then null else 'SM' || cast(event_id as string) end as sid",
        f"""named_struct('phone_number', {_phone('user_id')}, 'cell_site', {_cell('event_id % 110')},
            'imei', {_tac('event_id % 2100')} || '7654321') as `from`""",
        f"""named_struct('phone_number', {_phone('event_id % 1600')},
            'cell_site', case when event_id % 30 = 0 then null else {_cell('user_id % 100')} end,
            'imei', case when event_id % 20 = 0 then 'ABC' else {_tac('user_id')} || '7654321' end) as `to`""",
        "case when event_id % 12 = 0 then null else props end as body",
        "event_type as status",
        f"{_bad_time('event_id', _text_time('ts'))} as `timestamp`",
        f"""named_struct('amount', case when event_id % 41 = 2 then '0.0' else {_money('value')} end,
            'currency', 'EGP') as billing_info""",
        """case when event_id % 2 = 0 then named_struct(
            'signal_strength_dbm', cast(-50 - event_id % 70 as string),
            'latency_ms', cast(10 + event_id % 490 as string),
            'jitter_ms', cast(cast(event_id % 50 as double) as string)) end as network_metrics""",
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "'payment' as event_type",
        "case when o_orderkey % 47 = 0 then null else 'PAY' || cast(o_orderkey as string) end as sid",
        f"case when o_orderkey % 31 = 0 then null else {_phone('o_custkey')} end as customer",
        "o_orderpriority as payment_type",
        f"""case when o_orderkey % 43 = 0 then null when o_orderkey % 43 = 1 then '-5'
            else {_money('o_totalprice')} end as payment_amount""",
        "case when o_orderkey % 29 = 0 then null else 'Cash' end as payment_method",
        "o_orderstatus as status",
        f"{_bad_time('o_orderkey', _text_time('o_orderdate', 'o_orderkey % 86400'))} as `timestamp`",
        f"case when o_orderkey % 31 = 0 then null else {_phone('o_custkey')} end as phone_number",
        "'TX' || cast(o_orderkey as string) as transaction_id",
        "case when o_orderkey % 3 = 0 then 'INV' || cast(o_orderkey as string) end as invoice_number",
        "case when o_orderkey % 37 = 0 then null else '1.3' end as seasonal_multiplier",
        f"""named_struct('amount', {_money('o_totalprice')}, 'currency', 'EGP') as billing_info""",
    )


def raw_recharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "'recharge' as event_type",
        "'RC' || cast(o_orderkey as string) as sid",
        f"{_phone('o_custkey')} as customer",
        """case when o_orderkey % 25 = 0 then '-50' when o_orderkey % 25 = 1 then null
            else cast(o_orderkey % 1000 + 1 as string) end as recharge_amount""",
        "cast(o_custkey % 50 as string) as balance_before",
        "case when o_orderkey % 39 = 0 then 'n/a' else cast(o_custkey % 500 as string) end as balance_after",
        "'Online' as payment_method",
        "o_orderstatus as status",
        f"{_bad_time('o_orderkey', _text_time('o_orderdate', 'o_orderkey % 86400'))} as `timestamp`",
        f"case when o_orderkey % 31 = 0 then null else {_phone('o_custkey')} end as phone_number",
        "'TXN' || cast(o_orderkey as string) as transaction_id",
        """named_struct('amount', cast(o_orderkey % 1000 + 1 as string), 'currency', 'EGP')
            as billing_info""",
    )


def raw_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "'support' as event_type",
        "'SU' || cast(event_id as string) as sid",
        f"case when event_id % 31 = 0 then null else {_phone('user_id')} end as customer",
        "event_type as channel",
        "case when event_id % 6 = 0 then 'billing' else 'technical' end as reason",
        "cast((event_id % 61) * 30 as string) as wait_time_seconds",
        "cast(60 + event_id % 86000 as string) as resolution_time_seconds",
        "'AG' || cast(1000 + event_id % 130 as string) as agent_id",
        """case when event_id % 10 < 2 then null when event_id % 10 = 9 then '6'
            else cast(1 + event_id % 5 as string) end as satisfaction_score""",
        f"{_bad_time('event_id', _text_time('ts'))} as `timestamp`",
        f"case when event_id % 31 = 0 then null else {_phone('user_id')} end as phone_number",
        "event_id % 2 = 0 as first_call_resolution",
        "case when event_id % 3 = 0 then null else event_id % 5 = 0 end as escalated",
        "event_id % 7 = 0 as call_back_requested",
    )


RAW_EVENTS = {
    "call": raw_calls,
    "sms": raw_sms,
    "payment": raw_payments,
    "recharge": raw_recharges,
    "support": raw_support,
}


def seed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as user_sk",
        f"{_phone('c_custkey')} as msisdn",
        "c_mktsegment as customer_type",
        "case when c_custkey % 2 = 0 then 'Male' else 'Female' end as gender",
        "case when c_custkey % 3 = 0 then '18-29' else '30-44' end as age_group",
        "'City_' || cast(c_nationkey as string) as city",
        "cast(date_add(date'2020-01-01', cast(c_custkey % 1000 as int)) as string) as activation_date",
        "'Active' as status",
        "cast(date_add(date'2020-01-01', cast(c_custkey % 1000 as int)) as string) as effective_from",
        "'9999-12-31' as effective_to",
        "true as is_current",
    )


def seed_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        f"{_tac('p_partkey')} as tac", "p_brand as brand", "p_name as model"
    )


def seed_cell_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        f"{_cell('s_suppkey')} as cell_id",
        "'City_' || cast(s_nationkey as string) as city",
        "s_name as site_name",
        "22 + cast(s_suppkey % 90 as double) / 10 as latitude",
        "25 + cast(s_suppkey % 70 as double) / 10 as longitude",
    )


def seed_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "'AG' || cast(1000 + s_suppkey as string) as agent_id",
        "s_name as name",
        "'Dept_' || cast(s_nationkey as string) as department",
        "'City_' || cast(s_nationkey % 7 as string) as city",
        "case when s_suppkey % 9 = 0 then 'Training' else 'Active' end as status",
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        f"case when c_custkey % 4 = 0 then '' else {_phone('c_custkey')} end as phone_number",
        f"{_phone('c_custkey')} as msisdn",
        """case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then '2021-03-04 05:06:07'
            when c_custkey % 5 = 2 then 'soon' else '2022-07-08' end as activation_date""",
        "case when c_custkey % 10 = 0 then '2020-02-29' end as registration_date",
        "case when c_custkey % 3 = 0 then null else 'Female' end as gender",
        "case when c_custkey % 11 = 0 then 'old' else cast(c_custkey % 90 as string) end as age",
        "case when c_custkey % 13 = 0 then '60+' end as age_group",
        "case when c_custkey % 6 = 0 then null else c_mktsegment end as plan_type",
        "case when c_custkey % 12 = 0 then 'Postpaid' end as customer_type",
        "case when c_custkey % 7 = 0 then 'Inactive' end as status",
        "case when c_custkey % 8 = 0 then 'Giza' end as city",
        "case when c_custkey % 9 = 0 then 'Delta' end as region",
    )


def raw_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        f"""case when p_partkey % 50 = 0 then '  ' else ' ' || {_tac('p_partkey div 3')} || '  ' end as tac""",
        "case when p_partkey % 4 = 0 then null else p_brand end as manufacturer",
        "case when p_partkey % 8 = 0 then 'Other' end as brand",
        "case when p_partkey % 5 = 0 then p_name end as model",
        "case when p_partkey % 6 = 0 then 'Android' end as os",
        "case when p_partkey % 7 = 0 then false end as is_smartphone",
    )
