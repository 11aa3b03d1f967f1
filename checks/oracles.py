"""The registered queries as SQL for DuckDB over the same tables, written independently."""

from __future__ import annotations

CALL_KEY = "(l_orderkey * 10 + l_linenumber)"


def _phone(key: str) -> str:
    return f"'010' || lpad(cast({key} as varchar), 8, '0')"


def _cell(key: str) -> str:
    return f"'CELL' || lpad(cast({key} as varchar), 5, '0')"


def _tac(key: str) -> str:
    return f"lpad(cast({key} as varchar), 8, '0')"


def _money(value: str) -> str:
    return f"cast(cast({value} as decimal(12,2)) as varchar)"


def _text_time(moment: str, shift: str = "0") -> str:
    return f"strftime({moment} + to_seconds({shift}), '%Y-%m-%d %H:%M:%S')"


def _bad_time(key: str, good: str) -> str:
    return (
        f"case when {key} % 33 = 0 then 'INVALID_DATE' "
        f"when {key} % 33 = 1 then '2025-13-45 25:99:99' else {good} end"
    )


# Flattened raw events, numbers still text.

_k = CALL_KEY
_caller = f"case when {_k} % 31 = 0 then null else {_phone('l_partkey')} end"

FLAT = {
    "call": f"""
        select 'call' as event_type,
            case when {_k} % 47 = 0 then null else 'CA' || cast({_k} as varchar) end as sid,
            case when {_k} % 50 = 0 then null when {_k} % 50 = 1 then '-10'
                when {_k} % 50 = 2 then 'abc'
                else cast(cast(l_quantity as bigint) * 80 as varchar) end as call_duration_seconds,
            l_linestatus as status,
            {_bad_time(_k, _text_time('l_shipdate', f'{_k} % 86400'))} as "timestamp",
            case when l_returnflag = 'R' then 'International' else 'Local' end as call_type,
            {_caller} as phone_number, {_caller} as customer,
            {_caller} as from_phone_number,
            case when {_k} % 25 = 0 then 'INVALID_CELL' when {_k} % 26 = 0 then null
                else {_cell('l_suppkey')} end as from_cell_site,
            case when {_k} % 21 = 0 then null when {_k} % 20 = 0 then substr({_tac('l_partkey')}, 2)
                else {_tac('l_partkey')} || '0000000' end as from_imei,
            {_phone('l_suppkey')} as to_phone_number,
            {_cell('l_orderkey % 120')} as to_cell_site,
            {_tac('l_suppkey')} || '1234567' as to_imei,
            case when {_k} % 41 = 0 then null when {_k} % 41 = 1 then 'abc'
                when {_k} % 41 = 2 then '0.0' else {_money('l_extendedprice')} end as amount,
            'EGP' as currency
        from lineitem""",
    "sms": f"""
        select 'sms' as event_type,
            case when event_id % 47 = 0 then null else 'SM' || cast(event_id as varchar) end as sid,
            case when event_id % 12 = 0 then null else props end as body,
            event_type as status,
            {_bad_time('event_id', _text_time('ts'))} as "timestamp",
            {_phone('user_id')} as from_phone_number,
            {_cell('event_id % 110')} as from_cell_site,
            {_tac('event_id % 2100')} || '7654321' as from_imei,
            {_phone('event_id % 1600')} as to_phone_number,
            case when event_id % 30 = 0 then null else {_cell('user_id % 100')} end as to_cell_site,
            case when event_id % 20 = 0 then 'ABC' else {_tac('user_id')} || '7654321' end as to_imei,
            case when event_id % 41 = 2 then '0.0' else {_money('value')} end as amount,
            'EGP' as currency,
            case when event_id % 2 = 0 then cast(-50 - event_id % 70 as varchar) end
                as signal_strength_dbm,
            case when event_id % 2 = 0 then cast(10 + event_id % 490 as varchar) end as latency_ms,
            case when event_id % 2 = 0 then cast(event_id % 50 as varchar) end as jitter_ms
        from events""",
    "payment": f"""
        select 'payment' as event_type,
            case when o_orderkey % 47 = 0 then null else 'PAY' || cast(o_orderkey as varchar) end as sid,
            case when o_orderkey % 31 = 0 then null else {_phone('o_custkey')} end as customer,
            o_orderpriority as payment_type,
            case when o_orderkey % 43 = 0 then null when o_orderkey % 43 = 1 then '-5'
                else {_money('o_totalprice')} end as payment_amount,
            case when o_orderkey % 29 = 0 then null else 'Cash' end as payment_method,
            o_orderstatus as status,
            {_bad_time('o_orderkey', _text_time('o_orderdate', 'o_orderkey % 86400'))} as "timestamp",
            case when o_orderkey % 31 = 0 then null else {_phone('o_custkey')} end as phone_number,
            'TX' || cast(o_orderkey as varchar) as transaction_id,
            case when o_orderkey % 3 = 0 then 'INV' || cast(o_orderkey as varchar) end as invoice_number,
            case when o_orderkey % 37 = 0 then null else '1.3' end as seasonal_multiplier,
            {_money('o_totalprice')} as amount, 'EGP' as currency, o_orderkey
        from orders""",
    "recharge": f"""
        select 'recharge' as event_type, 'RC' || cast(o_orderkey as varchar) as sid,
            {_phone('o_custkey')} as customer,
            case when o_orderkey % 25 = 0 then '-50' when o_orderkey % 25 = 1 then null
                else cast(o_orderkey % 1000 + 1 as varchar) end as recharge_amount,
            cast(o_custkey % 50 as varchar) as balance_before,
            case when o_orderkey % 39 = 0 then 'n/a' else cast(o_custkey % 500 as varchar) end
                as balance_after,
            'Online' as payment_method, o_orderstatus as status,
            {_bad_time('o_orderkey', _text_time('o_orderdate', 'o_orderkey % 86400'))} as "timestamp",
            case when o_orderkey % 31 = 0 then null else {_phone('o_custkey')} end as phone_number,
            'TXN' || cast(o_orderkey as varchar) as transaction_id,
            cast(o_orderkey % 1000 + 1 as varchar) as amount, 'EGP' as currency
        from orders""",
    "support": f"""
        select 'support' as event_type, 'SU' || cast(event_id as varchar) as sid,
            case when event_id % 31 = 0 then null else {_phone('user_id')} end as customer,
            event_type as channel,
            case when event_id % 6 = 0 then 'billing' else 'technical' end as reason,
            cast((event_id % 61) * 30 as varchar) as wait_time_seconds,
            cast(60 + event_id % 86000 as varchar) as resolution_time_seconds,
            'AG' || cast(1000 + event_id % 130 as varchar) as agent_id,
            case when event_id % 10 < 2 then null when event_id % 10 = 9 then '6'
                else cast(1 + event_id % 5 as varchar) end as satisfaction_score,
            {_bad_time('event_id', _text_time('ts'))} as "timestamp",
            case when event_id % 31 = 0 then null else {_phone('user_id')} end as phone_number,
            event_id % 2 = 0 as first_call_resolution,
            case when event_id % 3 = 0 then null else event_id % 5 = 0 end as escalated,
            event_id % 7 = 0 as call_back_requested
        from events""",
}


def _reasons(required=(), numeric=(), positive=(), between=None, extra=()) -> str:
    """Rejection text as one SQL expression."""
    parts = [f"case when {c} is null then '{c} come with null value, ' else '' end" for c in required]
    parts += [
        f"case when try_cast({c} as double) is null then '{c} must be numeric, ' else '' end"
        for c in numeric
    ]
    parts += [
        f"case when try_cast({c} as double) <= 0 then '{c} must be positive, ' else '' end"
        for c in positive
    ]
    parts += [
        f"case when try_cast({c} as double) < {lo} or try_cast({c} as double) > {hi} "
        f"then '{c} must be between {lo} and {hi}, ' else '' end"
        for c, (lo, hi) in (between or {}).items()
    ]
    parts += list(extra)
    return f"nullif(substr({' || '.join(parts)}, 1, 1000), '')"


_REASONS = {
    "call": _reasons(
        ("event_type", "sid", '"timestamp"', "status", "from_phone_number", "to_phone_number",
         "call_duration_seconds", "amount", "currency", "call_type"),
        ("call_duration_seconds", "amount"), ("amount",), {"call_duration_seconds": (0, 3600)},
    ),
    "sms": _reasons(
        ("event_type", "sid", '"timestamp"', "status", "from_phone_number", "to_phone_number",
         "from_cell_site", "to_cell_site", "from_imei", "to_imei", "body", "currency", "amount"),
        ("amount",), ("amount",),
    ),
    "payment": _reasons(
        ("event_type", "sid", '"timestamp"', "status", "customer", "payment_type",
         "payment_amount", "payment_method", "phone_number", "transaction_id",
         "seasonal_multiplier", "amount", "currency"),
        ("payment_amount", "amount"), ("payment_amount", "amount"),
    ),
    "recharge": _reasons(
        ("event_type", "sid", '"timestamp"', "status", "customer", "phone_number",
         "recharge_amount", "balance_before", "balance_after", "payment_method",
         "transaction_id", "amount", "currency"),
        ("recharge_amount", "balance_before", "balance_after", "amount"),
        ("recharge_amount", "amount"),
    ),
    "support": _reasons(
        ("event_type", "sid", '"timestamp"', "customer", "phone_number", "channel", "reason",
         "wait_time_seconds", "resolution_time_seconds", "agent_id"),
        ("wait_time_seconds", "resolution_time_seconds", "satisfaction_score"),
        ("wait_time_seconds", "resolution_time_seconds"), {"satisfaction_score": (1, 5)},
    ),
}

_NUMBERS = {
    "call": {"call_duration_seconds": "bigint", "amount": "double"},
    "sms": {
        "amount": "double", "jitter_ms": "double", "latency_ms": "bigint",
        "signal_strength_dbm": "bigint",
    },
    "payment": {"payment_amount": "double", "seasonal_multiplier": "double", "amount": "double"},
    "recharge": {
        "recharge_amount": "double", "balance_before": "double", "balance_after": "double",
        "amount": "double",
    },
    "support": {
        "wait_time_seconds": "bigint", "resolution_time_seconds": "bigint",
        "satisfaction_score": "bigint",
    },
}


def silver_sql(event_type: str, drop: str = "") -> str:
    casts = ", ".join(f"try_cast({c} as {t}) as {c}" for c, t in _NUMBERS[event_type].items())
    excluded = f"exclude ({drop})" if drop else ""
    reason = _REASONS[event_type].replace("'\"timestamp\" come", "'timestamp come")
    return f"""
        select * {excluded} replace ({casts}), {reason} as rejection_reason,
            {reason} is not null as is_rejected
        from ({FLAT[event_type]})"""


_MOMENT = """coalesce(try_cast("timestamp" as timestamp), timestamp '1970-01-01 00:00:00')"""


def _text(*names: str) -> str:
    return ", ".join(f"coalesce({n}, '') as {n}" for n in names)


def _tac_sql(side: str) -> str:
    return (
        f"case when length({side}_imei) >= 8 then substr({side}_imei, 1, 8) else '' end as {side}_tac"
    )


_FACT_BODY = {
    "calls": (
        "call",
        f"""sid as call_id, event_type,
            {_text('from_phone_number', 'to_phone_number', 'from_cell_site', 'to_cell_site',
                   'from_imei', 'to_imei')},
            {_tac_sql('from')}, {_tac_sql('to')}, {_MOMENT} as "timestamp", {_text('status')},
            coalesce(call_duration_seconds, 0) as call_duration_seconds,
            coalesce(amount, 0) as amount, {_text('currency', 'call_type')}""",
        ("event_type", "call_id", "from_phone_number", "to_phone_number"),
    ),
    "sms": (
        "sms",
        f"""sid as sms_id, event_type,
            {_text('from_phone_number', 'to_phone_number', 'from_imei', 'to_imei')},
            {_tac_sql('from')}, {_tac_sql('to')}, {_text('from_cell_site', 'to_cell_site')},
            {_MOMENT} as "timestamp", {_text('status')}, coalesce(jitter_ms, 0) as jitter_ms,
            coalesce(latency_ms, 0) as latency_ms,
            coalesce(signal_strength_dbm, 0) as signal_strength_dbm,
            coalesce(amount, 0) as amount, {_text('currency')}""",
        ("event_type", "sms_id", "from_phone_number", "to_phone_number"),
    ),
    "payment": (
        "payment",
        f"""sid as payment_id, event_type, customer as customer_phone,
            {_text('phone_number', 'payment_type')},
            coalesce(payment_amount, 0) as payment_amount, {_text('payment_method', 'status')},
            {_MOMENT} as "timestamp", {_text('transaction_id', 'invoice_number')},
            coalesce(seasonal_multiplier, 1.0) as seasonal_multiplier,
            coalesce(amount, 0) as amount, {_text('currency')}""",
        ("event_type", "payment_id", "customer_phone"),
    ),
    "recharge": (
        "recharge",
        f"""sid as recharge_id, {_text('transaction_id')}, event_type, customer as customer_phone,
            coalesce(balance_after, 0) as balance_after,
            coalesce(balance_before, 0) as balance_before, coalesce(amount, 0) as amount,
            {_text('currency')}, {_MOMENT} as "timestamp",
            {_text('payment_method', 'phone_number')}""",
        ("event_type", "recharge_id", "customer_phone"),
    ),
    "support": (
        "support",
        f"""sid as support_id, event_type, customer as customer_phone,
            {_text('phone_number', 'channel', 'reason')},
            coalesce(wait_time_seconds, 0) as wait_time_seconds,
            coalesce(resolution_time_seconds, 0) as resolution_time_seconds, {_text('agent_id')},
            coalesce(satisfaction_score, 0) as satisfaction_score, {_MOMENT} as "timestamp",
            coalesce(first_call_resolution, false) as first_call_resolution,
            coalesce(escalated, false) as escalated,
            coalesce(call_back_requested, false) as call_back_requested""",
        ("event_type", "support_id", "customer_phone", "escalated"),
    ),
}


def fact_sql(name: str, key: str = "transaction_sk", minute_of_hour: bool = False, sep: str = "") -> str:
    event_type, body, parts = _FACT_BODY[name]
    texts = [f"coalesce(cast({p} as varchar), '')" for p in (*parts, '"timestamp"')]
    glue = f" || '{sep}' || " if sep else " || "
    minute = 'minute("timestamp")' if minute_of_hour else 'hour("timestamp") * 60 + minute("timestamp")'
    return f"""
        select md5({glue.join(texts)}) as {key},
            md5(strftime("timestamp", '%Y-%m-%d')) as date_sk, cast({minute} as integer) as time_sk, *
        from (select {body} from ({silver_sql(event_type)}) where is_rejected is not true)"""


DIM_USER = f"""
    select distinct md5(cast(c_custkey as varchar) || {_phone('c_custkey')}) as user_sk,
        c_custkey as user_id, {_phone('c_custkey')} as phone_number, c_mktsegment as plan_type,
        case when c_custkey % 2 = 0 then 'Male' else 'Female' end as gender,
        case when c_custkey % 3 = 0 then '18-29' else '30-44' end as age_group,
        'City_' || cast(c_nationkey as varchar) as city,
        strftime(date '2020-01-01' + cast(c_custkey % 1000 as integer), '%Y-%m-%d') as activation_date,
        'Active' as status,
        strftime(date '2020-01-01' + cast(c_custkey % 1000 as integer), '%Y-%m-%d') as effective_from,
        '9999-12-31' as effective_to, true as is_current
    from customer"""

DIM_DEVICE = f"""
    select distinct md5({_tac('p_partkey')} || p_brand) as device_sk, {_tac('p_partkey')} as tac,
        p_brand as brand, p_name as model
    from part"""

DIM_CELL_SITE = f"""
    select distinct md5({_cell('s_suppkey')} || 'City_' || cast(s_nationkey as varchar)) as cell_sk,
        {_cell('s_suppkey')} as cell_id, 'City_' || cast(s_nationkey as varchar) as city,
        s_name as site_name, 22 + cast(s_suppkey % 90 as double) / 10 as latitude,
        25 + cast(s_suppkey % 70 as double) / 10 as longitude
    from supplier"""

DIM_AGENT = """
    select distinct md5(agent_id || name || department) as agent_sk, * from (
        select 'AG' || cast(1000 + s_suppkey as varchar) as agent_id, s_name as name,
            'Dept_' || cast(s_nationkey as varchar) as department,
            'City_' || cast(s_nationkey % 7 as varchar) as city,
            case when s_suppkey % 9 = 0 then 'Training' else 'Active' end as status
        from supplier)"""


_WHOLE = ("latency_ms", "wait_time_seconds")


def _sum(column: str) -> str:
    """Rounded sum; sums of whole numbers stay 64 bit wide."""
    if column in _WHOLE:
        return f"cast(sum({column}) as bigint)"
    return f"round(sum({column}), 2)"


def _daily(name: str, sums: list[str], group_by: list[str]) -> str:
    groups = ", ".join(["date_sk", *group_by])
    measures = ", ".join(f"{_sum(s)} as sum_{s}" for s in sums)
    return f"select {groups}, count(*) as n_rows, {measures} from ({fact_sql(name)}) group by {groups}"


_CHECKED = """
    select event_id, event_type,
        case when event_id % 7 = 0 then null else user_id end as customer,
        case when event_id % 11 = 0 then null when event_id % 11 = 1 then 'abc'
            when event_id % 11 = 2 then '-3' when event_id % 11 = 3 then '0'
            else cast(event_id % 6000 as varchar) end as amount,
        case when event_id % 13 = 0 then '  0105  ' when event_id % 13 = 1 then '0000000000'
            when event_id % 13 = 2 then '+201234' else '010' || cast(event_id as varchar) end as phone,
        case when event_id % 17 = 0 then 'INVALID_DATE' when event_id % 17 = 1 then null
            else strftime(ts, '%Y-%m-%d %H:%M:%S') end as moment
    from events"""


def _checked_sql(reason: str) -> str:
    return (
        f"select *, {reason} as rejection_reason, {reason} is not null as is_rejected "
        f"from ({_CHECKED})"
    )


_FLAGGED = """
    select o_orderkey, o_totalprice,
        case when o_orderkey % 3 = 0 then true when o_orderkey % 3 = 1 then false end as is_rejected
    from orders"""

_FOLDERS = f"""
    select *, '2025-01-0' || cast(o_orderkey % 5 + 1 as varchar) as event_date,
        '0' || cast(o_orderkey % 3 as varchar) as event_hour
    from ({FLAT['payment']})"""

_SCD_OPEN = "select c_custkey as user_id, c_mktsegment as plan_type, 'C' || c_nationkey as city from customer"

_SCD_LATEST = """
    select user_id, coalesce(stated, c_mktsegment, 'NEW') as plan_type, day from (
        select case when o_custkey % 10 = 0 then o_custkey + 1000000000 else o_custkey end as user_id,
            case when o_custkey % 4 = 0 then null else o_orderpriority end as stated,
            strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey as seq
        from orders) o
    left join customer c on o.user_id = c.c_custkey
    qualify row_number() over (partition by user_id order by day desc, seq desc) = 1"""

_SCD_CHANGES = """
    select user_id, coalesce(stated, c_mktsegment, 'NEW') as plan_type, day, seq from (
        select case when o_custkey % 10 = 0 then o_custkey + 1000000000 else o_custkey end as user_id,
            case when o_custkey % 4 = 0 then null else o_orderpriority end as stated,
            strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey as seq
        from orders) o
    left join customer c on o.user_id = c.c_custkey"""


def scd2_sql(late: str = "false") -> str:
    """Version chains over all changes; ``late`` adds a change in 1994 for those users."""
    return f"""
    with changes as ({_SCD_CHANGES}),
    daily as (
        select user_id, plan_type, day from changes
        qualify row_number() over (partition by user_id, day order by seq desc, plan_type desc) = 1
        union all
        select c_custkey, 'LATE', '1994-05-05' from customer where {late}),
    states as (
        select c_custkey as user_id, 'OLD' as plan_type, 'C0' as city, '1990-01-01' as day,
            '1998-01-01' as until, 0 as fresh from customer where c_custkey % 5 = 0
        union all
        select user_id, plan_type, city, '1998-01-01', '9999-12-31', 0 from ({_SCD_OPEN})
        union all
        select user_id, plan_type, null, day, '9999-12-31', 1 from daily),
    placed as (
        select *, max(fresh) over (partition by user_id) as touched,
            coalesce(last_value(city ignore nulls) over so_far, first_value(city ignore nulls) over rest) as known,
            row_number() over (partition by user_id, day order by fresh desc) as nth
        from states
        window so_far as (partition by user_id order by day, fresh rows between unbounded preceding and current row),
            rest as (partition by user_id order by day, fresh rows between current row and unbounded following)),
    versions as (
        select * from placed where touched = 0 or nth = 1
        qualify touched = 0 or lag(plan_type) over (partition by user_id order by day) is distinct from plan_type)
    select user_id, plan_type, known as city, day as effective_from,
        case when touched = 1 then least(until, lead(day, 1, '9999-12-31') over chain) else until end as effective_to,
        until = '9999-12-31' and (touched = 0 or lead(day) over chain is null) as is_current
    from versions
    window chain as (partition by user_id order by day)"""


_SCD2 = scd2_sql()

_VERSIONS = f"""
    select phone_number, plan_type || '-' || no as plan_type, city, lo, hi
    from ({DIM_USER}), (values ('0', timestamp '1900-01-01', timestamp '1997-01-01'),
        ('1', timestamp '1997-01-01', timestamp '1999-07-01'),
        ('2', timestamp '1999-07-01', timestamp '9999-12-31')) v(no, lo, hi)"""

_AS_OF = f"""
    select v.plan_type as user_plan_type, v.city as user_city, count(*) as n_rows,
        round(sum(f.amount), 2) as sum_amount
    from ({fact_sql('recharge')}) f left join ({_VERSIONS}) v
        on f.phone_number = v.phone_number and f."timestamp" >= v.lo and f."timestamp" < v.hi
    group by 1, 2"""

_RAW_USER = f"""
    select c_custkey,
        case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then '2021-03-04 05:06:07'
            when c_custkey % 5 = 2 then 'soon' else '2022-07-08' end as act,
        case when c_custkey % 10 = 0 then '2020-02-29' end as reg,
        case when c_custkey % 11 = 0 then null else c_custkey % 90 end as age,
        c_mktsegment
    from customer"""

_USER_SEED = f"""
    select row_number() over (order by c_custkey) as user_sk, {_phone('c_custkey')} as msisdn,
        coalesce(case when c_custkey % 6 = 0 then null else c_mktsegment end,
            case when c_custkey % 12 = 0 then 'Postpaid' end, 'Prepaid') as customer_type,
        case when c_custkey % 3 = 0 then 'Unknown' else 'Female' end as gender,
        case when c_custkey % 13 = 0 then '60+' when age is null then 'unknown'
            when age < 18 then '<18' when age < 30 then '18-29' when age < 45 then '30-44'
            when age < 60 then '45-59' else '60+' end as age_group,
        case when c_custkey % 8 = 0 then 'Giza' when c_custkey % 9 = 0 then 'Delta'
            else 'Unknown' end as city,
        strftime(try_cast(coalesce(act, reg) as date), '%Y-%m-%d') as activation_date,
        case when c_custkey % 7 = 0 then 'Inactive' else 'Active' end as status,
        strftime(try_cast(coalesce(act, reg) as date), '%Y-%m-%d') as effective_from,
        '9999-12-31' as effective_to, true as is_current
    from ({_RAW_USER.replace("'2021-03-04 05:06:07'", "'2021-03-04'")})"""

_DEVICE_SEED = f"""
    select device_sk, {_tac('p_partkey // 3')} || '0000000' as imei, {_tac('p_partkey // 3')} as tac,
        case when p_partkey % 4 <> 0 then p_brand when p_partkey % 8 = 0 then 'Other'
            else 'Unknown' end as brand,
        case when p_partkey % 5 = 0 then p_name else 'Generic' end as model,
        case when p_partkey % 6 = 0 then 'Android' else 'Unknown' end as os,
        p_partkey % 7 <> 0 as is_smartphone
    from (select *, row_number() over (order by p_partkey) as device_sk from part)
    where p_partkey % 50 <> 0
    qualify row_number() over (partition by p_partkey // 3 order by device_sk) = 1"""

_SEASON = "o_orderdate + to_hours(o_orderkey % 24)"

_CALLS = fact_sql("calls")

ORACLES: dict[str, str] = {
    "star_daily": f"""
        select strftime("timestamp", '%Y-%m-%d') as date_date, strftime("timestamp", '%Y') as date_year,
            case when hour("timestamp") < 12 then 'AM' else 'PM' end as time_am_pm,
            count(*) as n_rows, round(sum(amount), 2) as sum_amount,
            cast(sum(call_duration_seconds) as bigint) as sum_call_duration_seconds,
            round(avg(call_duration_seconds), 2) as avg_call_duration_seconds
        from ({_CALLS}) group by 1, 2, 3""",
    "bronze_scan": f"""
        select event_date, event_hour, count(*) as n_rows, count(*) as n_with_file,
            round(sum(try_cast(amount as double)), 2) as sum_amount
        from ({_FOLDERS}) group by 1, 2""",
    "bronze_scan_multiline": """
        select '2025-01-01' as event_date, event_type as channel, count(*) as n_rows from events group by 2""",
    "bronze_scan_concatenated": """
        with layouts as (
            select event_id % 4 as layout, event_type, event_id, event_id % 64 as file from events),
        reads as (
            select l.*, whole from layouts l, (values (true), (false)) w(whole) where layout > 0 or whole)
        select cast(layout as int) as layout, whole, event_type as channel, count(*) as n_rows,
            count(distinct event_id) as n_events, cast(0 as bigint) as n_malformed
        from reads group by 1, 2, 3
        union all
        select cast(layout as int), whole, null, count(distinct file), cast(0 as bigint), count(distinct file)
        from reads where layout > 1 group by 1, 2""",
    "silver_rescued_fields": """
        select case when event_id % 4 = 0 then 'V' || (event_id % 3) end as vendor, count(*) as n_rows,
            count(*) filter (event_id % 9 = 0) as n_bad
        from events group by 1""",
    "silver_two_runs_no_duplicates": """
        select case when event_id % 7 = 0 then 'r1' else 'r2' end as run_id, event_type as channel,
            count(*) as n_rows, count(distinct event_id) as n_events
        from events group by 1, 2""",
    "archive_same_run_twice": """
        select layer, event_type as channel, count(*) as n_rows, count(distinct event_id) as n_events
        from events, (values ('archive'), ('silver')) v(layer) group by 1, 2""",
    "raw_archive_then_purge": """
        select event_type as channel, count(*) as n_rows, count(distinct event_id) as n_lines from events group by 1
        union all select 'no json', 1, 1""",
    "silver_malformed_lines": """
        select case when event_id % 10 = 0 then 40 end as kept_chars, count(*) as n_rows,
            (select count(*) from events where event_id % 10 = 0) as n_rejected
        from events group by 1""",
    "bronze_scan_one_day": f"""
        select event_date, event_hour, count(*) as n_rows from ({_FOLDERS})
        where event_date = '2025-01-02' group by 1, 2""",
    "silver_malformed_first_line": """
        select case when event_id % 10 = 0 then 40 end as kept_chars, count(*) as n_rows,
            (select count(*) from events where event_id % 10 = 0) as n_rejected
        from events group by 1""",
    "seed_cell_site": DIM_CELL_SITE,
    "seed_user": DIM_USER,
    "seed_device": DIM_DEVICE,
    "seed_agent": DIM_AGENT,
    "seed_any_layout": DIM_CELL_SITE,
    "catalog_table": """
        select o_orderstatus, 2 * count(*) as n_rows, cast(2 * sum(o_orderkey) as bigint) as sum_key
        from orders group by 1""",
    "partition_overwrite": """
        select o_orderstatus, count(*) as n_rows, cast(sum(case when o_orderstatus = 'F' then -1
            else o_custkey end) as bigint) as sum_cust
        from orders group by 1""",
    "sql_view": f"""
        select customer as customer_phone, count(*) as n_rows, sum(coalesce(amount, 0)) as sum_amount
        from ({silver_sql('recharge')}) where is_rejected is not true group by 1""",
    "stream_landing": " union all ".join(
        f'select event_type, sid, "timestamp" from ({FLAT[kind]})'
        for kind in ("call", "sms", "payment", "recharge", "support")
    ),
    "stream_parse": f"""
        select sid, call_duration_seconds, amount, from_phone_number as key from ({FLAT['call']})""",
    "silver_calls": silver_sql("call"),
    "silver_sms": silver_sql("sms"),
    "silver_payment": silver_sql("payment", "o_orderkey"),
    "silver_recharge": silver_sql("recharge"),
    "silver_support": silver_sql("support"),
    **{f"fact_{n}": fact_sql(n) for n in _FACT_BODY},
    "fact_calls_legacy_keys": fact_sql("calls", "trasnaction_sk", True),
    "fact_payment_separated_keys": fact_sql("payment", sep="|"),
    "flatten_struct": """
        select o_orderkey, o_orderpriority as plain, o_custkey as customer_key,
            o_orderstatus as customer_status, o_totalprice as amount, 'EGP' as currency
        from orders""",
    "validate_rules": _checked_sql(
        _reasons(("customer", "amount"), ("amount",), ("amount",), {"amount": (0, 3600)})
    ),
    "format_rules": _checked_sql(
        _reasons(
            extra=(
                "case when try_cast(amount as double) < 0 then 'amount must not be negative, ' else '' end",
                "case when event_id % 13 <= 2 then 'phone must be a phone number, ' else '' end",
                "case when moment is not null and try_cast(moment as timestamp) is null "
                "then 'moment must be a timestamp, ' else '' end",
            )
        )
    ),
    "strict_schema_rules": f"""
        select event_type, sid, customer,
            case when customer is null then 'customer come with null value, ' else '' end
                || 'status come with null value, ' as rejection_reason,
            true as is_rejected
        from ({FLAT['support']})""",
    "rejection_report": f"""
        select event_type, reason, count(*) as n_rows from (
            select event_type, unnest(string_split(rejection_reason, ', ')) as reason
            from ({silver_sql('call')}) where is_rejected)
        where reason <> '' group by 1, 2""",
    "rejection_report_many_rules": """
        select o_orderstatus,
            'a_rather_long_column_name_' || lpad(cast(i as varchar), 2, '0') || ' come with null value' as reason,
            count(*) as n_rows
        from orders, range(40) t(i) where o_orderkey % 3 = 0 group by 1, 2""",
    "lookup_duplicate_dim_rows": """
        select kind, c_mktsegment, count(*) as n_rows, round(sum(o_totalprice), 2) as sum_price
        from orders left join (select c_custkey, least(c_mktsegment, 'ZZZ') as c_mktsegment from customer)
            on o_custkey = c_custkey, (values ('measured'), ('shuffled')) v(kind)
        group by 1, 2""",
    "valid_reject_split": f"""
        select case when is_rejected then 'rejected' else 'valid' end as side, count(*) as n_rows,
            round(sum(amount), 2) as sum_amount
        from ({silver_sql('payment')}) group by 1""",
    "accept_filter": f"select * from ({_FLAGGED}) where is_rejected is not true",
    "accept_strict": f"select * from ({_FLAGGED}) where is_rejected = false",
    "project_defaults": f"""
        select sid as support_id, customer as customer_phone,
            coalesce(phone_number, '') as phone_number,
            coalesce(cast(satisfaction_score as bigint), 0) as satisfaction_score,
            coalesce(escalated, false) as escalated, false as call_back_requested,
            cast(1.0 as double) as seasonal_multiplier
        from ({FLAT['support']})""",
    "publish_shape": f"""
        select event_type, sid, call_duration_seconds, status, "timestamp", call_type, phone_number,
            customer, from_phone_number, coalesce(from_cell_site, '') as from_cell_site,
            coalesce(from_imei, '') as from_imei, to_phone_number, to_cell_site, to_imei, amount,
            currency
        from ({silver_sql('call')}) where is_rejected = false""",
    "tac_extract": f"select sid, {_tac_sql('from')}, {_tac_sql('to')} from ({FLAT['sms']})",
    "ri_orphans": f"""
        select agent_id, count(*) as n_rows from ({fact_sql('support')}) f
        where not exists (select 1 from ({DIM_AGENT}) d where d.agent_id = f.agent_id)
        group by 1""",
    "integrity_report": " union all ".join(
        f"""select '{key}' as link, count(distinct {key}) as orphan_keys, count(*) as orphan_rows
            from ({_CALLS}) where {key} <> '' and {key} not in (select {dim_key} from ({dim}))"""
        for key, dim, dim_key in (
            ("from_phone_number", DIM_USER, "phone_number"),
            ("from_cell_site", DIM_CELL_SITE, "cell_id"),
            ("to_cell_site", DIM_CELL_SITE, "cell_id"),
        )
    ),
    "profile_tables": " union all ".join(
        f"""select '{t}' as table_name, cast(ordinal_position as integer) as position, column_name,
            (select count(*) from {t}) as row_count
            from information_schema.columns where table_name = '{t}'"""
        for t in ("orders", "lineitem", "customer")
    ),
    "sample_rows": "select least(count(*), 5) as n_rows from orders",
    "stream_parse_all_types": " union all ".join(
        f'select event_type, sid, "timestamp", {key} as key from ({FLAT[kind]})'
        for kind, key in (
            ("call", "from_phone_number"), ("sms", "from_phone_number"), ("payment", "customer"),
            ("recharge", "customer"), ("support", "customer"),
        )
    ),
    "schema_drift_all_types": """
        select distinct event_type, column_name, drift
        from (select 1 from lineitem limit 1), (select 1 from orders limit 1), (select 1 from events limit 1), (values
            ('call', 'phone_number', 'unexpected'), ('call', 'customer', 'unexpected'),
            ('call', 'qos_metrics', 'unexpected'), ('sms', 'customer_id', 'missing'),
            ('recharge', 'from', 'missing'), ('recharge', 'to', 'missing'), ('recharge', 'body', 'missing'),
            ('recharge', 'requires_followup', 'missing'), ('recharge', 'seasonal_multiplier', 'missing'),
            ('recharge', 'balance_before', 'unexpected'), ('recharge', 'balance_after', 'unexpected'),
            ('recharge', 'payment_method', 'unexpected')) v(event_type, column_name, drift)""",
    "schema_drift": """
        select distinct 'payment' as event_type, column_name, drift from orders,
            (values ('invoice_number', 'missing'), ('new_field', 'unexpected')) v(column_name, drift)""",
    "dim_user": DIM_USER,
    "dim_device": DIM_DEVICE,
    "dim_cell_site": DIM_CELL_SITE,
    "dim_agent": DIM_AGENT,
    "dim_date": """
        select md5(strftime(d, '%Y-%m-%d')) as date_sk, cast(d as date) as full_date,
            strftime(d, '%Y-%m-%d') as date, strftime(d, '%Y') as year, strftime(d, '%m') as month,
            strftime(d, '%d') as day, dayname(d) as day_of_week, isodow(d) >= 6 as is_weekend
        from (select unnest(generate_series(min(date_trunc('day', o_orderdate)),
            max(date_trunc('day', o_orderdate)), interval 1 day)) as d from orders)""",
    "dim_time_usage": """
        select cast(m as integer) as time_key, cast(m as varchar) as time_value,
            cast(m // 60 as varchar) as hour, cast(m % 60 as varchar) as minute,
            case when m // 60 < 12 then 'AM' else 'PM' end as am_pm,
            case when m // 60 < 6 then 'night' when m // 60 < 12 then 'morning'
                when m // 60 < 18 then 'afternoon' else 'evening' end as time_period,
            coalesce(n, 0) as n_events
        from range(1440) t(m) left join (
            select hour(ts) * 60 + minute(ts) as k, count(*) as n from events group by 1) u on m = k""",
    "user_seed": _USER_SEED,
    "device_seed": _DEVICE_SEED,
    "row_positions": """
        select o_orderdate, o_orderkey,
            row_number() over (order by o_orderdate, o_orderkey) as position
        from orders""",
    "first_row_wins": """
        select p_brand, p_partkey, p_name from part
        qualify row_number() over (partition by p_brand order by p_partkey) = 1""",
    "daily_sms": _daily("sms", ["amount", "latency_ms"], ["status"]),
    "daily_payment": _daily("payment", ["payment_amount"], ["payment_type"]),
    "daily_recharge": _daily("recharge", ["amount", "balance_after"], ["currency"]),
    "daily_support": _daily("support", ["wait_time_seconds"], ["channel", "reason"]),
    "calls_by_user": f"""
        select a.plan_type as from_user_plan_type, b.plan_type as to_user_plan_type,
            b.city as to_user_city, count(*) as n_rows, round(sum(amount), 2) as sum_amount
        from ({_CALLS}) f left join ({DIM_USER}) a on f.from_phone_number = a.phone_number
            left join ({DIM_USER}) b on f.to_phone_number = b.phone_number
        group by 1, 2, 3""",
    "payments_by_user": f"""
        select plan_type as user_plan_type, age_group as user_age_group, count(*) as n_rows,
            round(sum(payment_amount), 2) as sum_payment_amount
        from ({fact_sql('payment')}) f left join ({DIM_USER}) d on f.phone_number = d.phone_number
        group by 1, 2""",
    "calls_by_device": f"""
        select a.brand as from_device_brand, b.brand as to_device_brand, count(*) as n_rows,
            round(sum(amount), 2) as sum_amount
        from ({_CALLS}) f left join ({DIM_DEVICE}) a on f.from_tac = a.tac
            left join ({DIM_DEVICE}) b on f.to_tac = b.tac
        group by 1, 2""",
    "calls_by_cell_site": f"""
        select a.city as from_cell_city, b.city as to_cell_city, count(*) as n_rows,
            round(sum(amount), 2) as sum_amount
        from ({_CALLS}) f left join ({DIM_CELL_SITE}) a on f.from_cell_site = a.cell_id
            left join ({DIM_CELL_SITE}) b on f.to_cell_site = b.cell_id
        group by 1, 2""",
    "support_by_agent": f"""
        select d.department as agent_department, d.status as agent_status, count(*) as n_rows,
            cast(sum(wait_time_seconds) as bigint) as sum_wait_time_seconds,
            round(avg(resolution_time_seconds), 2) as avg_resolution_time_seconds
        from ({fact_sql('support')}) f left join ({DIM_AGENT}) d on f.agent_id = d.agent_id
        group by 1, 2""",
    "skewed_lookup": f"""
        select p.phone_number, d.city as user_city, count(*) as n_rows
        from (select case when o_orderkey % 3 = 0 then '01000000007' else phone_number end
              as phone_number from ({FLAT['payment']})) p
        left join ({DIM_USER}) d on p.phone_number = d.phone_number
        group by 1, 2""",
    "user_as_of": _AS_OF,
    "user_as_of_skewed": _AS_OF,
    "drill_across": f"""
        with p as (select date_sk, count(*) as n, round(sum(amount), 2) as s
                   from ({fact_sql('payment')}) group by 1),
        u as (select date_sk, count(*) as n, cast(sum(wait_time_seconds) as bigint) as s
              from ({fact_sql('support')}) group by 1)
        select coalesce(p.date_sk, u.date_sk) as date_sk, p.n as payment_n_rows,
            p.s as payment_sum_amount, u.n as support_n_rows, u.s as support_sum_amount
        from p full outer join u on p.date_sk = u.date_sk""",
    "manufacturer_lookup": f"""
        select sid, s.tac, brand as manufacturer
        from (select sid, substr(from_imei, 1, 8) as tac from ({FLAT['sms']})) s
        left join ({DIM_DEVICE}) d on s.tac = d.tac""",
    "load_counts": "select " + ", ".join(
        f"(select count(*) from ({fact_sql(n)})) as {n}" for n in _FACT_BODY
    ),
    "scd1_upsert": f"""
        select coalesce(o.user_id, n.user_id) as user_id,
            coalesce(n.plan_type, o.plan_type) as plan_type, o.city
        from ({_SCD_OPEN}) o full outer join ({_SCD_LATEST}) n on o.user_id = n.user_id""",
    "scd2_merge": _SCD2,
    "scd2_merge_again": _SCD2,
    "scd2_replay_old_batch": _SCD2,
    "scd2_late_change": scd2_sql("c_custkey % 3 = 0"),
    "scd2_stored_merge": _SCD2,
    "scd2_bucketed_merge": _SCD2,
    "call_distance": f"""
        select from_cell_site, count(km) as n_known, round(sum(km), 2) as sum_km,
            round(max(km), 4) as max_km
        from (
            select f.from_cell_site, 2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) as km
            from (
                select c.from_cell_site,
                    pow(sin((radians(b.latitude) - radians(a.latitude)) / 2), 2)
                    + cos(radians(a.latitude)) * cos(radians(b.latitude))
                    * pow(sin((radians(b.longitude) - radians(a.longitude)) / 2), 2) as h
                from ({_CALLS}) c left join ({DIM_CELL_SITE}) a on c.from_cell_site = a.cell_id
                    left join ({DIM_CELL_SITE}) b on c.to_cell_site = b.cell_id) f)
        group by 1""",
    "seasonal_multiplier": f"""
        select o_orderkey, round(
            (case when hour(m) between 8 and 18 then 1.3e0 when hour(m) >= 19 then 1.5e0
                when hour(m) <= 6 then 0.3e0 else 1e0 end)
            * (case when isodow(m) >= 6 then 1.4e0 else 1e0 end)
            * (case when month(m) = 9 then 1.6e0 else 1e0 end)
            * (case when month(m) = 9 and (hour(m) >= 20 or hour(m) <= 3) then 1.5e0 else 1e0 end)
            * (case when month(m) between 6 and 8 then 1.2e0 else 1e0 end), 2) as multiplier,
            case when hour(m) < 6 then 'night' when hour(m) < 12 then 'morning'
                when hour(m) < 18 then 'afternoon' else 'evening' end as period
        from (select o_orderkey, {_SEASON} as m from orders)""",
    "short_call_flag": """
        select case when l_returnflag = 'R' then 'International' else 'Local' end as call_type,
            cast(l_quantity as bigint) as seconds,
            case when l_returnflag = 'R' and l_quantity < 30 then 'WANGIRI_FRAUD' end as marker,
            count(*) as n_rows
        from lineitem group by 1, 2, 3""",
    "archive_snapshot": """
        select run_id, event_type as channel, count(*) as n_rows
        from events, (values ('2025010100'), ('2025010101')) r(run_id) group by 1, 2""",
    "run_manifest": """
        select distinct d as event_date, h as event_hour, true as all_apart,
            '/archive/support/' || replace(d, '-', '') || '/' || h as folder
        from events, (values ('2025-01-01', '03'), ('2025-01-01', '04'), ('2025-01-02', '03')) v(d, h)""",
    "purge_by_manifest": """
        select '2025-01-02' as event_date, event_type as channel, count(*) as n_rows
        from events group by 2""",
    "idempotent_publish": f"""
        select date_sk, count(*) as n_rows, round(sum(amount), 2) as sum_amount
        from ({_CALLS}) group by 1""",
    "publish_partitioned": f"""
        select cast("timestamp" as date) as event_day, count(*) as n_rows, round(sum(amount), 2) as sum_amount
        from ({fact_sql('sms')}) where "timestamp" >= '1971-01-01' and "timestamp" < '2024-01-16' group by 1""",
    "publish_conflicts": """
        with sent as (
            select cast(o_custkey as varchar) as k, o_orderstatus as v, bool_or(o_orderkey % 2 = 0) as early
            from orders group by 1, 2),
        published as (select k, coalesce(min(v) filter (early), min(v)) as v from sent group by 1)
        select 'published' as kind, v, count(*) as n_rows, count(distinct k) as n_keys from published group by 2
        union all
        select 'conflict', s.v, count(*), count(distinct s.k)
        from sent s join published p on s.k = p.k and s.v <> p.v group by 2""",
    "silver_publish_once": f"""
        select case when call_back_requested then 'r1' else 'r2' end as run_id, channel, count(*) as n_rows,
            count(distinct sid) as n_events
        from ({silver_sql('support')}) where is_rejected is false group by 1, 2""",
    "daily_incremental": f"""
        select status, cast(count(*) as bigint) as n_rows, round(sum(amount), 2) as sum_amount,
            round(avg(amount), 2) as avg_amount
        from ({fact_sql('sms')}) group by 1""",
    "stream_bad_lines": """
        select whole, case when event_id % 10 = 0 then 40 end as kept_chars, count(*) as n_rows,
            count(distinct case when event_id % 10 <> 0 then event_id end) as n_events,
            count(*) filter (event_id % 10 = 0) as n_rejected
        from events, (values (true), (false)) w(whole) group by 1, 2""",
    "stream_silver": f"""
        select sid, from_phone_number, to_cell_site, amount, latency_ms, rejection_reason, is_rejected
        from ({silver_sql('sms')})""",
    "stream_routing": """
        select event_type, count(*) as n_rows, cast(sum(event_id) as bigint) as sum_id
        from events group by 1""",
    "lakehouse_run": "select " + ", ".join(
        [
            f"(select count(distinct transaction_sk) from ({fact_sql(n)})) as fact_{n}"
            for n in _FACT_BODY
        ]
        + [
            f"(select count(*) from ({d})) as dim_{n}"
            for n, d in (
                ("user", DIM_USER), ("device", DIM_DEVICE), ("cell_site", DIM_CELL_SITE),
                ("agent", DIM_AGENT),
            )
        ]
        + ["cast(2557 as bigint) as dim_date", "cast(1440 as bigint) as dim_time"]
    ),
}
