"""Registered queries: every operator of the library on the whole shared test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import bindings as b
from telmart.functions.enrich import (
    haversine_km,
    period_of_day,
    seasonal_multiplier,
    short_call_flag,
    tac_of,
)
from telmart.functions.keys import MINUTE_OF_HOUR
from telmart.operators import joins, quality, shape
from telmart.operators.aggregates import daily_measures, drill_across, load_counts, merged_measures
from telmart.operators.dedup import first_row_per_key
from telmart.operators.position import with_position
from telmart.operators.scd import scd1_upsert, scd2_merge
from telmart.plans.dims import (
    build_device_seed,
    build_dim,
    build_dim_date,
    build_dim_date_covering,
    build_dim_time,
    build_user_seed,
)
from telmart.plans.facts import LEGACY_KEY_NAME, build_fact, with_event_day, with_rejected
from telmart.plans.jobs import (
    Layout,
    build_dims,
    build_facts,
    load_seed_dims,
    merge_dim,
    publish_silver,
    run_silver,
    store_bucketed_dim,
    update_measures,
)
from telmart.plans.silver import normalise, to_silver
from telmart.schemas import drift_report, observed_fields
from telmart.scratch import scratch_path
from telmart.sinks.archive import (
    archive_snapshot,
    archived_location,
    purge_bronze,
    run_manifest,
)
from telmart.sinks.jdbc import publishable
from telmart.sinks.tables import (
    OVERWRITE,
    balanced_for_write,
    publish_new_rows,
    touched_partitions,
    write_by_quality,
    write_table,
)
from telmart.sources.bronze import read_bronze
from telmart.sources.seeds import read_seed
from telmart.sources.tables import publish_view, read_table
from telmart.streaming.ingest import (
    COMPRESSION,
    LINES_PER_FILE,
    land_messages,
    message_key,
    parse_all_events,
    parse_events,
    read_bronze_stream,
    read_landed,
    route_by_type,
    stream_silver,
)

Query = Callable[[SparkSession, str], DataFrame]

# The days the test tables' orders and shipments lie in.
DATES = ("1995-01-01", "2001-12-31")

SILVER_EVENT = {
    "calls": "call", "sms": "sms", "payment": "payment", "recharge": "recharge",
    "support": "support",
}


def silver(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return to_silver(b.RAW_EVENTS[event_type](spark, sf_dir), event_type)


def fact(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    return build_fact(silver(spark, sf_dir, SILVER_EVENT[name]), name, **options)


def keys_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_rejected(silver(spark, sf_dir, SILVER_EVENT[name]), name)


def _new_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _counted(df: DataFrame, *group_by: str) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count(F.lit(1)).alias("n_rows"))


def _run(stream_query) -> None:
    """Wait for an availableNow stream; its failure is raised here."""
    stream_query.awaitTermination()


# --- silver and facts -------------------------------------------------------------


def silver_query(event_type: str) -> Query:
    """Flattened, validated, typed events; complex columns dropped."""
    return lambda spark, sf: shape.drop_complex_columns(silver(spark, sf, event_type))


def fact_query(name: str, **options) -> Query:
    return lambda spark, sf: fact(spark, sf, name, **options)


# --- sources ----------------------------------------------------------------------


def _payments_with_folders(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_payments(spark, sf)
    order_no = F.substring("transaction_id", 3, 20).cast("bigint")
    return raw.select(
        F.to_json(F.struct(*raw.columns)).alias("value"),
        F.concat(F.lit("2025-01-0"), (order_no % 5 + 1).cast("string")).alias("event_date"),
        F.concat(F.lit("0"), (order_no % 3).cast("string")).alias("event_hour"),
    )


def land_as_json(spark: SparkSession, sf: str, event_type: str, root: str) -> None:
    """Write an event type's raw events as JSON lines under one landing folder."""
    writer = b.RAW_EVENTS[event_type](spark, sf).write.mode("overwrite")
    writer = writer.option("compression", COMPRESSION).option("maxRecordsPerFile", LINES_PER_FILE)
    writer.json(f"{root}/{event_type}/2025-03-01/07")


def bronze_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    folders = _payments_with_folders(spark, sf)
    keys = ["event_date", "event_hour"]
    balanced_for_write(folders, keys).write.partitionBy(*keys).text(f"{root}/payment")
    bronze = read_bronze(spark, f"{root}/payment", "payment", multi_line=False)
    return bronze.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("source_file").contains("/event_date="), 1)).alias("n_with_file"),
        F.round(F.sum(F.col("billing_info.amount").cast("double")), 2).alias("sum_amount"),
    )


def _write_texts(
    events: DataFrame, value: str, folder: str, first: str = "", between: str = "", last: str = "", end: str = "\n"
) -> None:
    """One text for each value of ``file``, written row by row, so no task holds one; ``end`` follows every row."""
    order = Window.partitionBy("file").orderBy("sid")
    is_first, is_last = F.row_number().over(order) == 1, F.lead(F.lit(1)).over(order).isNull()
    row = F.concat(
        F.when(is_first, first).otherwise(""), F.col(value), F.when(is_last, last).otherwise(between)
    )
    rows = events.withColumn("row", row).sortWithinPartitions("file", "sid").select("file", F.col("row").alias("value"))
    rows.write.partitionBy("file").option("lineSep", end).text(folder)


def bronze_scan_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays, pretty-printed objects and JSON lines side by side, each file read whole."""
    root = scratch_path(spark, "landing")
    number = F.substring("sid", 3, 20).cast("bigint")
    events = b.raw_support(spark, sf).withColumn("file", F.pmod(number, F.lit(64)))
    flat = events.withColumn("value", F.to_json(F.struct(*[c for c in events.columns if c != "file"])))
    pretty = F.to_json(F.struct(*[c for c in events.columns if c != "file"]), {"pretty": "true"})
    folder = f"{root}/support/2025-01-01/03"
    flat.filter("file % 4 = 0").select("value").write.text(f"{folder}/lines")
    events.filter("file % 4 = 1").select(pretty.alias("value")).write.text(f"{folder}/pretty")
    _write_texts(flat.filter("file % 4 >= 2"), "value", f"{folder}/array", "[\n", ",", "\n]")
    bronze = read_bronze(spark, f"{root}/support", "support", keep_malformed=True, every_file=True)
    return _counted(bronze.filter("malformed_text is null"), "event_date", "channel")


def bronze_scan_concatenated(spark: SparkSession, sf: str) -> DataFrame:
    """Pretty objects in a row, several on a line, arrays with a broken item, lines after a cut one.

    Read whole and, where a value does not span lines, line by line.
    """
    root = scratch_path(spark, "landing")
    number = F.substring("sid", 3, 20).cast("bigint")
    events = b.raw_support(spark, sf).select(
        "sid",
        F.to_json(F.struct("*"), {"pretty": "true"}).alias("pretty"),
        F.to_json(F.struct("*")).alias("flat"),
        F.pmod(number, F.lit(64)).alias("file"),
    ).withColumn("open", F.expr("substr(flat, 1, length(flat) - 1)"))
    texts = {
        0: {"value": "pretty"},
        1: {"value": "open", "end": "}"},
        2: {"value": "flat", "first": '[{"sid": oops},', "between": ",", "last": "]", "end": " "},
        3: {"value": "flat", "first": '{"sid": "cut\n'},
    }
    scans = []
    for kind, text in texts.items():
        folder = f"{root}/{kind}/support"
        _write_texts(events.filter(f"file % 4 = {kind}"), folder=folder, **text)
        for multi_line in (True, False) if kind else (True,):
            scan = read_bronze(spark, folder, "support", multi_line=multi_line, keep_malformed=True)
            scans.append(scan.select(F.lit(kind).alias("layout"), F.lit(multi_line).alias("whole"), "channel", "sid", "malformed_text"))
    return reduce(DataFrame.unionByName, scans).groupBy("layout", "whole", "channel").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("sid").alias("n_events"),
        F.count("malformed_text").alias("n_malformed"),
    )


def silver_rescued_fields(spark: SparkSession, sf: str) -> DataFrame:
    """A field that no schema knows is kept in the archive; a boolean that is none is rejected."""
    layout, root = _lake(spark)
    number = F.substring("sid", 3, 20).cast("bigint")
    events = b.raw_support(spark, sf).withColumns({
        "escalated": F.when(number % 9 == 0, "maybe").otherwise(F.col("escalated").cast("string")),
        "vendor": F.when(number % 4 == 0, F.concat(F.lit("V"), number % 3)),
    })
    events.write.json(f"{root}/support/2025-03-01/07")
    run_silver(spark, layout, "r1", ["support"], on_error="raise", multi_line=False)
    archived = spark.table(layout.table("support_archive")).select(
        "sid", F.try_element_at("rescued_fields", F.lit("vendor")).alias("vendor")
    )
    silver = spark.table(layout.table("support")).select(
        "sid", F.col("rejection_reason").contains("escalated must be true or false").alias("bad")
    )
    return archived.join(silver, "sid").groupBy("vendor").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("bad"), 1)).alias("n_bad")
    )


def _lake(spark: SparkSession, **options) -> tuple[Layout, str]:
    root, tables = scratch_path(spark, "landing"), scratch_path(spark, "tables")
    database = _new_name("lake")
    spark.sql(f"create database {database} location '{tables}'")
    return Layout(root, database, tables, **options), root


def _land_support(spark: SparkSession, sf: str, folder: str, condition: str) -> None:
    b.raw_support(spark, sf).filter(condition).write.mode("append").json(folder)


def _silver_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    silver = spark.table(layout.table("support"))
    return silver.groupBy("run_id", "channel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("sid").alias("n_events")
    )


def silver_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A run, the same again, more files, a second run, and that one again."""
    layout, root = _lake(spark)
    folder = f"{root}/support/2025-03-01/07"
    for half, run_id in (("call_back_requested", "r1"), ("not call_back_requested", "r2")):
        _land_support(spark, sf, folder, half)
        for _ in range(2):
            run_silver(spark, layout, run_id, ["support"], on_error="raise", multi_line=False)
    return _silver_counts(spark, layout)


def archive_same_run_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Half the events, purged, then the other half under the same run id, purged: all are there."""
    layout, root = _lake(spark)
    folder = f"{root}/support/2025-03-01/07"
    for half in ("call_back_requested", "not call_back_requested"):
        _land_support(spark, sf, folder, half)
        run_silver(spark, layout, "r1", ["support"], on_error="raise", multi_line=False, purge=True)
    archived = spark.table(layout.table("support_archive")).select(F.lit("archive").alias("layer"), "channel", "sid")
    silver = spark.table(layout.table("support")).select(F.lit("silver").alias("layer"), "channel", "sid")
    return archived.unionAll(silver).groupBy("layer", "channel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("sid").alias("n_events")
    )


def raw_archive_then_purge(spark: SparkSession, sf: str) -> DataFrame:
    """The raw files, with a line that is no JSON, word for word in the raw archive afterwards."""
    layout, root = _lake(spark)
    folder = f"{root}/support/2025-03-01/07"
    _land_support(spark, sf, folder, "true")
    spark.range(1).select(F.lit("no json").alias("value")).write.mode("append").text(folder)
    run_silver(spark, layout, "r1", ["support"], on_error="raise", multi_line=False, purge=True)
    kept = spark.read.option("recursiveFileLookup", True).text(layout.raw_archive_root())
    channel = F.coalesce(F.get_json_object("value", "$.channel"), F.col("value"))
    return kept.select(channel.alias("channel"), "value").groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("value").alias("n_lines")
    )


def _silver_malformed(spark: SparkSession, sf: str, first: bool, **options) -> DataFrame:
    layout, root = _lake(spark)
    cut = b.raw_support(spark, sf).select(
        F.to_json(F.struct("*")).alias("value"), F.substring("sid", 3, 20).cast("bigint").alias("n")
    )
    if first:
        cut = cut.sortWithinPartitions(F.expr("n % 10 <> 0"))
    cut = cut.selectExpr("case when n % 10 = 0 then substr(value, 1, 40) else value end as value")
    cut.write.text(f"{root}/support/2025-03-01/07")
    run_silver(spark, layout, "r1", ["support"], on_error="raise", **options)
    texts = spark.table(layout.table("support_archive")).groupBy(
        F.length("malformed_text").alias("kept_chars")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    lost = spark.table(layout.table("support")).filter("sid is null and is_rejected").count()
    return texts.withColumn("n_rejected", F.lit(lost))


def silver_malformed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth event's line is cut: the archive keeps its text, silver rejects the row."""
    return _silver_malformed(spark, sf, first=False, multi_line=False)


def silver_malformed_first_line(spark: SparkSession, sf: str) -> DataFrame:
    """The same in the default mode, with the cut lines first in every file."""
    return _silver_malformed(spark, sf, first=True)


def bronze_scan_one_day(spark: SparkSession, sf: str) -> DataFrame:
    """Only the folders of one landing day are listed and read."""
    root = scratch_path(spark, "landing")
    folders = _payments_with_folders(spark, sf)
    keys = ["event_date", "event_hour"]
    balanced_for_write(folders, keys).write.partitionBy(*keys).text(f"{root}/payment")
    bronze = read_bronze(
        spark, f"{root}/payment", "payment", dates=["2025-01-02"], multi_line=False
    )
    return _counted(bronze, *keys)


def seed_cell_site(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "seed")
    b.seed_cell_sites(spark, sf).write.json(path)
    return build_dim(read_seed(spark, path, "cell_site", multi_line=False), "cell_site")


def _seed_dim(name: str, rows: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A seed written as JSON and read back by the default, as its dimension."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, "seed")
        rows(spark, sf).write.json(path)
        return build_dim(read_seed(spark, path, name), name)

    return query


def seed_any_layout(spark: SparkSession, sf: str) -> DataFrame:
    """The cell sites as JSON lines and as arrays side by side, read by the default."""
    root = scratch_path(spark, "seed")
    rows = b.seed_cell_sites(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    rows = rows.withColumn("file", F.pmod(F.xxhash64("value"), F.lit(16)))
    rows.filter("file < 8").select("value").write.text(f"{root}/lines")
    items = F.array_join(F.collect_list("value"), ",\n")
    arrays = rows.filter("file >= 8").groupBy("file").agg(F.concat(F.lit("[\n"), items, F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("file").text(f"{root}/array")
    return build_dim(read_seed(spark, f"{root}/{{lines,array/file=*}}", "cell_site"), "cell_site")


def catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """Create on first write, append on the second, read back by name."""
    name = _new_name("t_orders")
    rows = b.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, name)
    write_table(rows, name, path=path)
    # Columns are matched by name, so their order may differ.
    write_table(rows.select("o_totalprice", "o_orderkey", "o_orderstatus"), name)
    stored = read_table(spark, name)
    return stored.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_key")
    )


def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Overwriting replaces only the partitions that the new rows touch."""
    name = _new_name("t_status")
    rows = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_table(rows, name, partition_by=["o_orderstatus"], path=scratch_path(spark, name))
    replacement = rows.filter("o_orderstatus = 'F'").withColumn("o_custkey", F.lit(-1).cast("long"))
    write_table(replacement, name, mode=OVERWRITE, partition_by=["o_orderstatus"])
    return read_table(spark, name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_custkey").alias("sum_cust")
    )


def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    """The same staging as SQL text: a view over silver and a WITH query."""
    view = publish_view(silver(spark, sf, "recharge"), _new_name("v_recharge"))
    return spark.sql(
        f"""
        with accepted as (
            select sid as recharge_id, customer as customer_phone, coalesce(amount, 0) as amount
            from {view} where is_rejected is false or is_rejected is null
        )
        select customer_phone, count(*) as n_rows, sum(amount) as sum_amount
        from accepted group by customer_phone
        """
    )


def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of all types in one message stream, landed in folders and read back.

    A file that a failed attempt might have left is put beside the landed ones: it is not
    in the commit log and must not be read.
    """
    source, root = scratch_path(spark, "messages"), scratch_path(spark, "landing")
    arrival = F.timestamp_seconds(F.lit(1735700000) + F.length("value") % 7200)
    for event_type, events in b.RAW_EVENTS.items():
        raw = events(spark, sf)
        payload = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
        payload.withColumn("arrived_at", arrival).write.mode("append").option("compression", "zstd").parquet(source)
    schema = "value string, arrived_at timestamp"
    messages = spark.readStream.schema(schema).parquet(source)
    _run(land_messages(messages, root, scratch_path(spark, "checkpoint")))
    leftover = b.raw_payments(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    leftover.write.mode("append").option("compression", COMPRESSION).text(f"{root}/event_type=payment/event_date=2025-01-01/event_hour=02")
    landed = [
        read_landed(spark, root, event_type)
        .filter("event_date <> '' and event_hour <> ''")
        .select("event_type", "sid", "timestamp")
        for event_type in b.RAW_EVENTS
    ]
    return reduce(DataFrame.unionByName, landed)


def stream_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Typed columns and message keys from JSON payloads of mixed types."""
    parts = []
    for event_type in ("call", "recharge"):
        raw = b.RAW_EVENTS[event_type](spark, sf)
        parts.append(raw.select(F.to_json(F.struct(*raw.columns)).alias("value")))
    calls = parse_events(parts[0].union(parts[1]), "call")
    return calls.select(
        "sid", "call_duration_seconds", "billing_info.amount", message_key(calls).alias("key")
    )


def stream_parse_all(spark: SparkSession, sf: str) -> DataFrame:
    """One message stream of all types: each parsed by its own schema, with its messages' keys."""
    texts = [b.RAW_EVENTS[t](spark, sf).select(F.to_json(F.struct("*")).alias("value")) for t in b.RAW_EVENTS]
    return parse_all_events(reduce(DataFrame.unionAll, texts))


# --- shape and quality ------------------------------------------------------------


def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    nested = b.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "named_struct('key', o_custkey, 'status', o_orderstatus) as customer",
        "named_struct('amount', o_totalprice, 'currency', 'EGP') as billing_info",
        "o_orderpriority as plain",
    )
    # 'plain' is no struct and 'absent' no column: both are left alone.
    return shape.flatten_structs(
        nested, {"customer": "customer", "billing_info": "", "plain": "p", "absent": "a"}
    )


def _checked_values(spark: SparkSession, sf: str, rules: quality.RuleSet) -> DataFrame:
    rows = b.table(spark, sf, "events").selectExpr(
        "event_id",
        "event_type",
        "case when event_id % 7 = 0 then null else user_id end as customer",
        """case when event_id % 11 = 0 then null when event_id % 11 = 1 then 'abc'
           when event_id % 11 = 2 then '-3' when event_id % 11 = 3 then '0'
           else cast(event_id % 6000 as string) end as amount""",
        """case when event_id % 13 = 0 then '  0105  ' when event_id % 13 = 1 then '0000000000'
           when event_id % 13 = 2 then '+201234' else '010' || cast(event_id as string) end as phone""",
        """case when event_id % 17 = 0 then 'INVALID_DATE' when event_id % 17 = 1 then null
           else substr(cast(ts as string), 1, 19) end as moment""",
    )
    return quality.add_rejection_reason(rows, rules)


BASIC_RULES = quality.RuleSet(
    required=("customer", "amount", "absent"),
    numeric=("amount",),
    positive=("amount",),
    between={"amount": (0, 3600)},
)


def validate_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_values(spark, sf, BASIC_RULES)


def format_rules(spark: SparkSession, sf: str) -> DataFrame:
    rules = quality.RuleSet(
        non_negative=("amount",), formats={"phone": "phone", "moment": "timestamp"}
    )
    return _checked_values(spark, sf, rules)


def strict_schema_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Required columns that are absent count as violated."""
    rows = b.raw_support(spark, sf).select("event_type", "sid", "customer")
    rules = quality.RuleSet(required=("sid", "customer", "status"))
    return quality.add_rejection_reason(rows, rules, missing=quality.REJECT)


def rejection_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rejection_report(silver(spark, sf, "call"), "event_type")


def rejection_report_many_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Forty long column names, all null in a third of the rows: texts far over their limit."""
    orders = b.table(spark, sf, "orders")
    names = [f"a_rather_long_column_name_{i:02d}" for i in range(40)]
    wide = orders.select(
        "o_orderstatus",
        *[F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias(c) for c in names],
    )
    rules = quality.RuleSet(required=tuple(names))
    checked = quality.add_rejection_reason(wide, rules, keep_rules=True)
    return quality.rejection_report(checked, "o_orderstatus")


def lookup_duplicate_dim_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension with two rows per key: no fact row is doubled, by either kind of join."""
    facts = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    doubled = customers.unionAll(customers.withColumn("c_mktsegment", F.lit("ZZZ")))
    sides = [
        joins.lookup_join(facts, doubled, "o_custkey", "c_custkey", max_bytes=size).select(
            F.lit(label).alias("kind"), "*"
        )
        for label, size in (("measured", joins.MAX_BROADCAST_BYTES), ("shuffled", 0))
    ]
    return sides[0].unionAll(sides[1]).groupBy("kind", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("sum_price")
    )


def valid_reject_split(spark: SparkSession, sf: str) -> DataFrame:
    """Both outputs of one write, read back."""
    path = scratch_path(spark, "payments")
    write_by_quality(silver(spark, sf, "payment"), path)
    sides = [
        spark.read.parquet(f"{path}/quality={side}").select(F.lit(side).alias("side"), "amount")
        for side in ("valid", "rejected")
    ]
    return sides[0].unionByName(sides[1]).groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount"), 2).alias("sum_amount")
    )


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "o_totalprice",
        """case when o_orderkey % 3 = 0 then true when o_orderkey % 3 = 1 then false end
           as is_rejected""",
    )


def project_with_defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.raw_support(spark, sf).drop("call_back_requested")
    text = shape.Projected
    return shape.project_with_defaults(
        rows,
        [
            text("support_id", "sid"),
            text("customer_phone", "customer"),
            text("phone_number", "phone_number", "string", ""),
            text("satisfaction_score", "satisfaction_score", "bigint", 0),
            text("escalated", "escalated", "boolean", False),
            text("call_back_requested", "call_back_requested", "boolean", False),
            text("seasonal_multiplier", "seasonal_multiplier", "double", 1.0),
        ],
    )


def publish_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Silver calls as the warehouse takes them: clean rows, flat, without nulls."""
    return publishable(silver(spark, sf, "call"))


def tac_extract(spark: SparkSession, sf: str) -> DataFrame:
    flat = normalise(b.raw_sms(spark, sf), "sms")
    return flat.select(
        "sid", tac_of(F.col("from_imei")).alias("from_tac"), tac_of(F.col("to_imei")).alias("to_tac")
    )


def ri_orphans(spark: SparkSession, sf: str) -> DataFrame:
    agents = build_dim(b.seed_agents(spark, sf), "agent")
    return quality.orphan_keys(fact(spark, sf, "support"), "agent_id", agents, "agent_id")


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    users = build_dim(b.seed_users(spark, sf), "user")
    sites = build_dim(b.seed_cell_sites(spark, sf), "cell_site")
    return quality.integrity_report(
        fact(spark, sf, "calls"),
        {
            "from_phone_number": (users, "phone_number"),
            "from_cell_site": (sites, "cell_id"),
            "to_cell_site": (sites, "cell_id"),
        },
    )


def profile_tables(spark: SparkSession, sf: str) -> DataFrame:
    names = ("orders", "lineitem", "customer")
    profile = quality.profile_tables({n: b.table(spark, sf, n) for n in names})
    return profile.select("table_name", "position", "column_name", "row_count")


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Five rows to look at, whichever they are; here, how many and that they are real."""
    orders = b.table(spark, sf, "orders")
    sample = quality.sample_rows(orders.select("o_orderkey"))
    return orders.join(F.broadcast(sample), "o_orderkey", "left_semi").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_payments(spark, sf).withColumn("new_field", F.lit(1))
    lines = raw.drop("invoice_number").select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )
    return drift_report(observed_fields(lines), "payment")


def schema_drift_all(spark: SparkSession, sf: str) -> DataFrame:
    """Fields found in the events of every type against its contract."""
    reports = []
    for event_type, raw in b.RAW_EVENTS.items():
        lines = raw(spark, sf).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        reports.append(drift_report(observed_fields(lines), event_type))
    return reduce(DataFrame.unionByName, reports)


# --- dimensions -------------------------------------------------------------------


def _doubled(df: DataFrame) -> DataFrame:
    """Every row twice, so that the distinct has work to do."""
    return df.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")


def dim_user(spark: SparkSession, sf: str) -> DataFrame:
    return build_dim(_doubled(b.seed_users(spark, sf)), "user")


def dim_device(spark: SparkSession, sf: str) -> DataFrame:
    return build_dim(_doubled(b.seed_devices(spark, sf)), "device")


def dim_cell_site(spark: SparkSession, sf: str) -> DataFrame:
    return build_dim(_doubled(b.seed_cell_sites(spark, sf)), "cell_site")


def dim_agent(spark: SparkSession, sf: str) -> DataFrame:
    return build_dim(_doubled(b.seed_agents(spark, sf)), "agent")


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar that covers the orders, with the added attributes."""
    return build_dim_date_covering(b.table(spark, sf, "orders"), "o_orderdate", extended=True)


def dim_time_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Every minute of the day with the number of events in it."""
    usage = _counted(
        b.table(spark, sf, "events").select(
            (F.hour("ts") * 60 + F.minute("ts")).alias("minute_of_event")
        ),
        "minute_of_event",
    )
    minutes = build_dim_time(spark, extended=True)
    return minutes.join(
        F.broadcast(usage), F.col("time_key") == F.col("minute_of_event"), "left"
    ).select(*minutes.columns, F.coalesce("n_rows", F.lit(0)).alias("n_events"))


def user_seed(spark: SparkSession, sf: str) -> DataFrame:
    return build_user_seed(b.raw_users(spark, sf), ["c_custkey"])


def device_seed(spark: SparkSession, sf: str) -> DataFrame:
    return build_device_seed(b.raw_devices(spark, sf), ["p_partkey"])


def row_positions(spark: SparkSession, sf: str) -> DataFrame:
    orders = b.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return with_position(orders, "position", ["o_orderdate", "o_orderkey"])


def first_row_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The first part of every brand."""
    parts = b.table(spark, sf, "part").select("p_brand", "p_partkey", "p_name")
    return first_row_per_key(parts, ["p_brand"], ["p_partkey"])


# --- joins and aggregates ---------------------------------------------------------


def star_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Calls per day and half of the day: flatten, validate, accept, key, join, aggregate."""
    calls = fact(spark, sf, "calls")
    dated = joins.with_date(
        calls, build_dim_date(spark, *DATES, unknown_member=True), ["date", "year"], fixed_size=True
    )
    timed = joins.with_time(dated, build_dim_time(spark), ["am_pm"])
    return daily_measures(
        timed,
        ["date_date", "date_year", "time_am_pm"],
        sums=["amount", "call_duration_seconds"],
        averages=["call_duration_seconds"],
    )


def _daily(name: str, sums: list[str], group_by: list[str]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return daily_measures(fact(spark, sf, name), ["date_sk", *group_by], sums=sums)

    return query


def calls_by_user(spark: SparkSession, sf: str) -> DataFrame:
    users = build_dim(b.seed_users(spark, sf), "user")
    wide = joins.with_users(
        fact(spark, sf, "calls"), users, ["plan_type", "city"], keys_from=keys_of(spark, sf, "calls")
    )
    return daily_measures(
        wide, ["from_user_plan_type", "to_user_plan_type", "to_user_city"], sums=["amount"]
    )


def payments_by_user(spark: SparkSession, sf: str) -> DataFrame:
    users = build_dim(b.seed_users(spark, sf), "user")
    wide = joins.with_users(
        fact(spark, sf, "payment"), users, ["plan_type", "age_group"], keys_from=keys_of(spark, sf, "payment")
    )
    return daily_measures(wide, ["user_plan_type", "user_age_group"], sums=["payment_amount"])


def calls_by_device(spark: SparkSession, sf: str) -> DataFrame:
    devices = build_dim(b.seed_devices(spark, sf), "device")
    wide = joins.with_devices(
        fact(spark, sf, "calls"), devices, ["brand"], keys_from=keys_of(spark, sf, "calls")
    )
    return daily_measures(wide, ["from_device_brand", "to_device_brand"], sums=["amount"])


def calls_by_cell_site(spark: SparkSession, sf: str) -> DataFrame:
    sites = build_dim(b.seed_cell_sites(spark, sf), "cell_site")
    wide = joins.with_cell_sites(
        fact(spark, sf, "calls"), sites, ["city"], keys_from=keys_of(spark, sf, "calls")
    )
    return daily_measures(wide, ["from_cell_city", "to_cell_city"], sums=["amount"])


def support_by_agent(spark: SparkSession, sf: str) -> DataFrame:
    agents = build_dim(b.seed_agents(spark, sf), "agent")
    wide = joins.with_agent(fact(spark, sf, "support"), agents, ["department", "status"])
    return daily_measures(
        wide, ["agent_department", "agent_status"], sums=["wait_time_seconds"],
        averages=["resolution_time_seconds"],
    )


def skewed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The lookup of a dimension taken as too large to broadcast, on a hot key.

    A third of the payments get one customer's number and some none at all.
    """
    users = build_dim(b.seed_users(spark, sf), "user")
    payments = normalise(b.raw_payments(spark, sf), "payment").selectExpr(
        "transaction_id",
        """case when cast(substr(transaction_id, 3) as bigint) % 3 = 0 then '01000000007'
           else phone_number end as phone_number""",
    )
    wide = joins.lookup_join(
        payments, users, "phone_number", "phone_number", ["city"], "user_", max_bytes=0
    )
    return _counted(wide, "phone_number", "user_city")


def _user_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions per user, changing on fixed days."""
    days = ["1900-01-01", "1997-01-01", "1999-07-01", "9999-12-31"]
    spans = F.array(
        *[
            F.struct(
                F.lit(i).alias("no"), F.lit(days[i]).alias("start"), F.lit(days[i + 1]).alias("end")
            )
            for i in range(3)
        ]
    )
    users = build_dim(b.seed_users(spark, sf), "user")
    return users.select("*", F.inline(spans)).select(
        "phone_number",
        F.concat_ws("-", "plan_type", "no").alias("plan_type"),
        "city",
        F.col("start").alias("effective_from"),
        F.col("end").alias("effective_to"),
    )


def user_as_of(spark: SparkSession, sf: str) -> DataFrame:
    wide = joins.with_user_as_of(fact(spark, sf, "recharge"), _user_versions(spark, sf))
    return daily_measures(wide, ["user_plan_type", "user_city"], sums=["amount"])


def user_as_of_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """The same result without broadcasting the dimension."""
    wide = joins.with_user_as_of(
        fact(spark, sf, "recharge"), _user_versions(spark, sf), max_bytes=0
    )
    return daily_measures(wide, ["user_plan_type", "user_city"], sums=["amount"])


def drill_across_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Payments and support events side by side per date key."""
    parts = {
        "payment": daily_measures(fact(spark, sf, "payment"), ["date_sk"], sums=["amount"]),
        "support": daily_measures(
            fact(spark, sf, "support"), ["date_sk"], sums=["wait_time_seconds"]
        ).withColumnRenamed("sum_wait_time_seconds", "sum_amount"),
    }
    return drill_across(parts, ["date_sk"], ["n_rows", "sum_amount"])


def manufacturer_lookup(spark: SparkSession, sf: str) -> DataFrame:
    devices = build_dim(b.seed_devices(spark, sf), "device")
    flat = normalise(b.raw_sms(spark, sf), "sms")
    coded = flat.select("sid", tac_of(F.col("from_imei")).alias("tac"))
    return joins.with_manufacturer(coded, devices)


def fact_load_counts(spark: SparkSession, sf: str) -> DataFrame:
    return load_counts({n: fact(spark, sf, n) for n in SILVER_EVENT})


# --- slowly changing dimensions ---------------------------------------------------


def _scd_dim(spark: SparkSession, sf: str) -> DataFrame:
    open_rows = b.table(spark, sf, "customer").selectExpr(
        "c_custkey as user_id", "c_mktsegment as plan_type", "'C' || c_nationkey as city",
        "'1998-01-01' as effective_from", "'9999-12-31' as effective_to", "true as is_current",
    )
    closed = b.table(spark, sf, "customer").filter("c_custkey % 5 = 0").selectExpr(
        "c_custkey as user_id", "'OLD' as plan_type", "'C0' as city",
        "'1990-01-01' as effective_from", "'1998-01-01' as effective_to", "false as is_current",
    )
    return open_rows.unionByName(closed)


def _scd_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Plan changes from orders; some state the plan the user already has, some are new users."""
    orders = b.table(spark, sf, "orders").selectExpr(
        "case when o_custkey % 10 = 0 then o_custkey + 1000000000 else o_custkey end as user_id",
        "case when o_custkey % 4 = 0 then null else o_orderpriority end as stated",
        "substr(cast(o_orderdate as string), 1, 10) as effective_from",
        "o_orderkey as seq",
    )
    known = b.table(spark, sf, "customer").selectExpr("c_custkey as user_id", "c_mktsegment")
    wide = joins.lookup_join(orders, known, "user_id", "user_id")
    return wide.selectExpr(
        "user_id", "coalesce(stated, c_mktsegment, 'NEW') as plan_type", "effective_from", "seq"
    )


def scd1(spark: SparkSession, sf: str) -> DataFrame:
    dim = _scd_dim(spark, sf).filter("is_current").select("user_id", "plan_type", "city")
    return scd1_upsert(dim, _scd_changes(spark, sf), ["user_id"], ["effective_from", "seq"])


def scd2(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_merge(
        _scd_dim(spark, sf), _scd_changes(spark, sf), ["user_id"], ["plan_type"], order_by=["seq"]
    )


def scd2_again(spark: SparkSession, sf: str) -> DataFrame:
    """Merging a batch a second time changes nothing."""
    changes = _scd_changes(spark, sf)
    merged = scd2_merge(
        _scd_dim(spark, sf), changes, ["user_id"], ["plan_type"], order_by=["seq"]
    )
    return scd2_merge(merged, changes, ["user_id"], ["plan_type"], order_by=["seq"])


def scd2_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches in order of time, then the first one again: no later version is lost."""
    changes = _scd_changes(spark, sf)
    batches = [
        changes.filter("effective_from < '1996-01-01'"),
        changes.filter("effective_from between '1996-01-01' and '1997-12-31'"),
        changes.filter("effective_from > '1997-12-31'"),
    ]
    merged = _scd_dim(spark, sf)
    for batch in [*batches, batches[0]]:
        merged = scd2_merge(merged, batch, ["user_id"], ["plan_type"], order_by=["seq"])
    return merged


def scd2_late(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of 1994 that arrive after all others slot into history."""
    merged = scd2_merge(
        _scd_dim(spark, sf), _scd_changes(spark, sf), ["user_id"], ["plan_type"], order_by=["seq"]
    )
    late = b.table(spark, sf, "customer").filter("c_custkey % 3 = 0").selectExpr(
        "c_custkey as user_id", "'LATE' as plan_type", "'1994-05-05' as effective_from"
    )
    return scd2_merge(merged, late, ["user_id"], ["plan_type"])


def scd2_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A stored dimension, merged in place twice."""
    name = _new_name("t_dim_user")
    write_table(_scd_dim(spark, sf), name, path=scratch_path(spark, name))
    for _ in range(2):
        merge_dim(spark, Layout(), name, _scd_changes(spark, sf), ["user_id"], ["plan_type"], ["seq"])
    return read_table(spark, name)


def scd2_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the dimension in buckets, of which merges write those they touch."""
    layout, _ = _lake(spark)
    store_bucketed_dim(layout, "dim_user", _scd_dim(spark, sf), ["user_id"], buckets=7)
    for _ in range(2):
        merge_dim(spark, layout, "dim_user", _scd_changes(spark, sf), ["user_id"], ["plan_type"], ["seq"])
    return read_table(spark, layout.table("dim_user"))


# --- enrichment -------------------------------------------------------------------


def call_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Kilometres between the cell sites of both parties, summed per caller site."""
    sites = build_dim(b.seed_cell_sites(spark, sf), "cell_site")
    wide = joins.with_cell_sites(fact(spark, sf, "calls"), sites, ["latitude", "longitude"])
    km = haversine_km(
        F.col("from_cell_latitude"), F.col("from_cell_longitude"),
        F.col("to_cell_latitude"), F.col("to_cell_longitude"),
    )
    return wide.withColumn("km", km).groupBy("from_cell_site").agg(
        F.count("km").alias("n_known"), F.round(F.sum("km"), 2).alias("sum_km"),
        F.round(F.max("km"), 4).alias("max_km"),
    )


def seasonal(spark: SparkSession, sf: str) -> DataFrame:
    moment = F.expr("timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate)")
    orders = b.table(spark, sf, "orders").select("o_orderkey", moment.alias("moment"))
    return orders.select(
        "o_orderkey",
        seasonal_multiplier(F.col("moment")).alias("multiplier"),
        period_of_day(F.hour("moment")).alias("period"),
    )


def short_calls(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "lineitem").selectExpr(
        "case when l_returnflag = 'R' then 'International' else 'Local' end as call_type",
        "cast(l_quantity as bigint) as seconds",
    )
    marked = rows.withColumn("marker", short_call_flag(F.col("call_type"), F.col("seconds")))
    return _counted(marked, "call_type", "seconds", "marker")


# --- sinks, streams and jobs ------------------------------------------------------


def archive(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, one of them repeated: three writes, two snapshots."""
    name = _new_name("t_archive")
    path = scratch_path(spark, name)
    batch = normalise(b.raw_support(spark, sf), "support")
    for run_id in ("2025010100", "2025010101", "2025010100"):
        archive_snapshot(batch, name, run_id, path)
    return _counted(read_table(spark, name), "run_id", "channel")


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a run, and where they are archived; counted per folder."""
    root = scratch_path(spark, "landing")
    for day, hour in (("2025-01-01", "03"), ("2025-01-01", "04"), ("2025-01-02", "03")):
        b.raw_support(spark, sf).write.json(f"{root}/support/{day}/{hour}")
    bronze = read_bronze(spark, f"{root}/support", "support", multi_line=False)
    files = archived_location(run_manifest(bronze), "/archive", "support", "2025-09-09")
    return files.groupBy("event_date", "event_hour").agg(
        # How many files a write makes is Spark's choice; none may share a target.
        (F.count(F.lit(1)) == F.countDistinct("archived_file")).alias("all_apart"),
        F.min(F.regexp_extract("archived_file", "^(.*)/", 1)).alias("folder"),
    )


def purge_by_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Only the files of the run are deleted; those of the other day stay."""
    root = scratch_path(spark, "landing")
    for day in ("2025-01-01", "2025-01-02"):
        b.raw_support(spark, sf).write.json(f"{root}/support/{day}/03")
    folder = f"{root}/support"
    run = read_bronze(spark, folder, "support", dates=["2025-01-01"], multi_line=False)
    purge_bronze(run_manifest(run))
    return _counted(read_bronze(spark, folder, "support", multi_line=False), "event_date", "channel")


def idempotent_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Half a fact, then all of it, then all of it again: every row once."""
    name = _new_name("t_fact")
    path = scratch_path(spark, name)
    calls = fact(spark, sf, "calls")
    publish_new_rows(calls.filter("status = 'F'"), name, "transaction_sk", path=path)
    publish_new_rows(calls, name, "transaction_sk")
    publish_new_rows(calls, name, "transaction_sk")
    return daily_measures(read_table(spark, name), ["date_sk"], sums=["amount"])


def publish_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Half a fact, then all of it twice, by event day; then a range of days, for which partitions prune."""
    name = _new_name("t_fact")
    texts = with_event_day(fact(spark, sf, "sms"))
    for part in (texts.filter("amount > 50"), texts, texts):
        publish_new_rows(part, name, "transaction_sk", ["event_day"], path=scratch_path(spark, name))
    days = read_table(spark, name).filter("event_day between '1971-01-01' and '2024-01-15'")
    return days.groupBy("event_day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount"), 2).alias("sum_amount")
    )


def publish_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that share a key and differ, in one batch and against the table: kept apart, once."""
    name = _new_name("t_rows")
    rows = b.table(spark, sf, "orders").selectExpr(
        "cast(o_custkey as string) as k", "o_orderstatus as v", "o_orderkey % 2 = 0 as first_batch"
    )
    for part in (rows.filter("first_batch"), rows, rows):
        publish_new_rows(part.select("k", "v"), name, "k", path=scratch_path(spark, name))
    published = read_table(spark, name).select(F.lit("published").alias("kind"), "k", "v")
    conflicts = read_table(spark, f"{name}_conflicts").select(F.lit("conflict").alias("kind"), "k", "v")
    return published.unionByName(conflicts).groupBy("kind", "v").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("k").alias("n_keys")
    )


def silver_publish_once(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of silver copied to a warehouse whose first append breaks half-way; all copied again."""
    layout, root = _lake(spark)
    for half, run_id in (("call_back_requested", "r1"), ("not call_back_requested", "r2")):
        _land_support(spark, sf, f"{root}/support/2025-03-01/07", half)
        run_silver(spark, layout, run_id, ["support"], on_error="raise", multi_line=False)
    store, broken = scratch_path(spark, "warehouse"), []

    def append(rows: DataFrame, target: str, options) -> None:
        if not broken:
            broken.append(target)
            rows.filter("crc32(sid) % 2 = 0").write.mode("append").parquet(store)
            raise OSError("the warehouse is gone")
        rows.write.mode("append").parquet(store)

    def published(session: SparkSession, target: str, options, run_id: str) -> DataFrame:
        return session.read.parquet(store).filter(F.col("run_id") == run_id)

    for _ in range(3):
        publish_silver(
            spark, layout, {}, {"support": "silver_support"}, "continue", append=append, published=published
        )
    return spark.read.parquet(store).groupBy("run_id", "channel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("sid").alias("n_events")
    )


def daily_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Stored sums and counts, brought up to date after each of three publishes, the last one repeated."""
    layout, _ = _lake(spark)
    texts = with_event_day(fact(spark, sf, "sms"))
    thirds = [texts.filter(f"pmod(crc32(transaction_sk), 3) = {k}") for k in range(3)]
    for part in (*thirds, thirds[-1]):
        publish_new_rows(
            part, layout.table("fact_sms"), "transaction_sk", ["event_day"], path=layout.path("fact_sms")
        )
        update_measures(
            spark, layout, "fact_sms", "daily_sms", ["date_sk", "status"], ["amount"], ["amount"],
            days=touched_partitions(part, "event_day"),
        )
    stored = read_table(spark, layout.table("daily_sms"))
    return merged_measures(stored, ["status"], ["amount"], ["amount"])


def stream_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth event's line is cut: the stream keeps its text, read whole or line by line."""
    root = scratch_path(spark, "landing")
    lines = b.raw_support(spark, sf).select(
        F.to_json(F.struct("*")).alias("value"), F.substring("sid", 3, 20).cast("bigint").alias("n")
    )
    lines.selectExpr("case when n % 10 = 0 then substr(value, 1, 40) else value end as value").write.text(
        f"{root}/2025-02-01/10"
    )
    found = []
    for whole in (False, True):
        out = scratch_path(spark, "silver")
        bronze = read_bronze_stream(spark, root, "support", multi_line=whole)
        _run(stream_silver(bronze, "support", out, scratch_path(spark, "checkpoint")))
        found.append(spark.read.parquet(out).withColumn("whole", F.lit(whole)))
    return reduce(DataFrame.unionByName, found).groupBy(
        "whole", F.length("malformed_text").alias("kept_chars")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("sid").alias("n_events"),
        F.count(F.when(F.expr("is_rejected and sid is null"), 1)).alias("n_rejected"),
    )


def stream_silver_events(spark: SparkSession, sf: str) -> DataFrame:
    """Silver through a stream in two runs: the second finds only the new files."""
    root, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "silver", "checkpoint"))
    for half in (0, 1):
        part = b.raw_sms(spark, sf).filter(
            f"coalesce(length(`from`.imei) + length(body), 0) % 2 = {half}"
        )
        part.write.json(f"{root}/2025-02-0{half + 1}/10")
        bronze = read_bronze_stream(spark, root, "sms")
        _run(stream_silver(bronze, "sms", out, checkpoint))
    stored = spark.read.parquet(out)
    return stored.select(
        "sid", "from_phone_number", "to_cell_site", "amount", "latency_ms", "rejection_reason",
        "is_rejected",
    )


def stream_routing(spark: SparkSession, sf: str) -> DataFrame:
    """One event stream written to one folder per type."""
    out = scratch_path(spark, "routed")
    events = b.table(spark, sf, "events")
    source = scratch_path(spark, "events")
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    _run(route_by_type(stream, out, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_id")
    )


def lakehouse_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow: raw JSON of five types to silver, seeds to dimensions, facts, counts."""
    layout, root = _lake(spark)
    database = layout.database
    for event_type in b.RAW_EVENTS:
        land_as_json(spark, sf, event_type, root)
    run_silver(spark, layout, "2025030107", on_error="raise", multi_line=False)
    seeds = {
        "cell_site": b.seed_cell_sites, "user": b.seed_users,
        "device": b.seed_devices, "agent": b.seed_agents,
    }
    paths = {}
    for name, seed in seeds.items():
        paths[name] = f"{root}/seeds/{name}"
        seed(spark, sf).write.json(paths[name])
    load_seed_dims(spark, layout, paths, multi_line=False)
    build_dims(spark, layout, DATES)
    build_facts(spark, layout, ["sms", "support"])
    # The test rows of the others spread over 2,500 days; a partition for each would be tiny.
    whole = replace(layout, fact_partitions=())
    build_facts(spark, whole, ["calls", "payment", "recharge"])
    for again, name in ((layout, "sms"), (whole, "calls")):  # once more: adds nothing
        build_facts(spark, again, [name])
    names = ["calls", "sms", "payment", "recharge", "support"]
    stored = {f"fact_{n}": spark.table(f"{database}.fact_{n}") for n in names}
    dims = ["user", "device", "cell_site", "agent", "date", "time"]
    stored.update({f"dim_{n}": spark.table(f"{database}.dim_{n}") for n in dims})
    return load_counts(stored)


QUERIES: dict[str, Query] = {
    "star_daily": star_daily,
    "bronze_scan": bronze_scan,
    "bronze_scan_multiline": bronze_scan_multiline,
    "bronze_scan_concatenated": bronze_scan_concatenated,
    "silver_rescued_fields": silver_rescued_fields,
    "silver_two_runs_no_duplicates": silver_two_runs,
    "archive_same_run_twice": archive_same_run_twice,
    "raw_archive_then_purge": raw_archive_then_purge,
    "silver_malformed_lines": silver_malformed_lines,
    "silver_malformed_first_line": silver_malformed_first_line,
    "bronze_scan_one_day": bronze_scan_one_day,
    "seed_cell_site": seed_cell_site,
    "seed_user": _seed_dim("user", b.seed_users),
    "seed_device": _seed_dim("device", b.seed_devices),
    "seed_agent": _seed_dim("agent", b.seed_agents),
    "seed_any_layout": seed_any_layout,
    "catalog_table": catalog_table,
    "partition_overwrite": partition_overwrite,
    "sql_view": sql_view,
    "stream_landing": stream_landing,
    "stream_parse": stream_parse,
    "stream_parse_all_types": stream_parse_all,
    **{f"silver_{n}": silver_query(t) for n, t in SILVER_EVENT.items()},
    **{f"fact_{n}": fact_query(n) for n in SILVER_EVENT},
    "fact_calls_legacy_keys": fact_query(
        "calls", time_mode=MINUTE_OF_HOUR, key_name=LEGACY_KEY_NAME
    ),
    "fact_payment_separated_keys": fact_query("payment", sep="|"),
    "flatten_struct": flatten_struct,
    "validate_rules": validate_rules,
    "format_rules": format_rules,
    "strict_schema_rules": strict_schema_rules,
    "rejection_report": rejection_report,
    "rejection_report_many_rules": rejection_report_many_rules,
    "lookup_duplicate_dim_rows": lookup_duplicate_dim_rows,
    "valid_reject_split": valid_reject_split,
    "accept_filter": lambda spark, sf: shape.accepted(_flagged(spark, sf)),
    "accept_strict": lambda spark, sf: shape.strictly_accepted(_flagged(spark, sf)),
    "project_defaults": project_with_defaults,
    "publish_shape": publish_shape,
    "tac_extract": tac_extract,
    "ri_orphans": ri_orphans,
    "integrity_report": integrity_report,
    "profile_tables": profile_tables,
    "sample_rows": sample_rows,
    "schema_drift": schema_drift,
    "schema_drift_all_types": schema_drift_all,
    "dim_user": dim_user,
    "dim_device": dim_device,
    "dim_cell_site": dim_cell_site,
    "dim_agent": dim_agent,
    "dim_date": dim_date,
    "dim_time_usage": dim_time_usage,
    "user_seed": user_seed,
    "device_seed": device_seed,
    "row_positions": row_positions,
    "first_row_wins": first_row_wins,
    "daily_sms": _daily("sms", ["amount", "latency_ms"], ["status"]),
    "daily_payment": _daily("payment", ["payment_amount"], ["payment_type"]),
    "daily_recharge": _daily("recharge", ["amount", "balance_after"], ["currency"]),
    "daily_support": _daily("support", ["wait_time_seconds"], ["channel", "reason"]),
    "calls_by_user": calls_by_user,
    "payments_by_user": payments_by_user,
    "calls_by_device": calls_by_device,
    "calls_by_cell_site": calls_by_cell_site,
    "support_by_agent": support_by_agent,
    "skewed_lookup": skewed_lookup,
    "user_as_of": user_as_of,
    "user_as_of_skewed": user_as_of_skewed,
    "drill_across": drill_across_facts,
    "manufacturer_lookup": manufacturer_lookup,
    "load_counts": fact_load_counts,
    "scd1_upsert": scd1,
    "scd2_merge": scd2,
    "scd2_merge_again": scd2_again,
    "scd2_replay_old_batch": scd2_replay,
    "scd2_late_change": scd2_late,
    "scd2_stored_merge": scd2_stored,
    "scd2_bucketed_merge": scd2_bucketed,
    "call_distance": call_distance,
    "seasonal_multiplier": seasonal,
    "short_call_flag": short_calls,
    "archive_snapshot": archive,
    "run_manifest": manifest,
    "purge_by_manifest": purge_by_manifest,
    "idempotent_publish": idempotent_publish,
    "publish_partitioned": publish_partitioned,
    "publish_conflicts": publish_conflicts,
    "silver_publish_once": silver_publish_once,
    "daily_incremental": daily_incremental,
    "stream_silver": stream_silver_events,
    "stream_bad_lines": stream_bad_lines,
    "stream_routing": stream_routing,
    "lakehouse_run": lakehouse_run,
}
