from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from telmart.plans.silver import to_silver, with_partition_day
from telmart.sources.bronze import read_bronze
from telmart.streaming import ingest
from tests.conftest import rows_of
from tests.test_quality import CALL, SUPPORT
from tests.test_sources_sinks import event, land


def test_stream_equals_batch_and_reads_files_once(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / n) for n in ("call", "out", "checkpoint"))
    land(tmp_path, "call/2025-01-01/03", "a.json", event(CALL), event(CALL, sid=None), lines=True)

    def run():
        bronze = ingest.read_bronze_stream(spark, root, "call", max_files_per_trigger=1)
        ingest.stream_silver(bronze, "call", out, checkpoint).awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 2
    assert run().count() == 2
    land(tmp_path, "call/2025-01-02/03", "a.json", event(CALL, sid="CA9"), lines=True)
    found = run()
    batch = with_partition_day(to_silver(read_bronze(spark, root, "call", multi_line=False), "call"))
    columns = [c for c in batch.columns if c not in ("qos_metrics", "landing_day")]
    assert rows_of(found.select(*columns)) == rows_of(batch.select(*columns))


def test_consumed_files_are_archived_with_their_path(spark, tmp_path):
    root, moved = str(tmp_path / "call"), str(tmp_path / "moved")
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        land(tmp_path, f"call/{day}/03", "a.json", event(CALL), lines=True)
        bronze = ingest.read_bronze_stream(spark, root, "call", archive_dir=moved)
        ingest.stream_silver(
            bronze, "call", str(tmp_path / "out"), str(tmp_path / "checkpoint")
        ).awaitTermination()
    archived = sorted(str(p) for p in (tmp_path / "moved").rglob("a.json"))
    assert any(p.endswith("2025-01-01/03/a.json") for p in archived)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_landing_layout(spark, tmp_path):
    source, root = str(tmp_path / "messages"), str(tmp_path / "landing")
    payloads = [json.dumps(event(CALL)), json.dumps(event(SUPPORT)), "no json", '{"event_type":"x"}']
    rows = [(p, "2025-01-01 13:30:00") for p in payloads]
    df = spark.createDataFrame(rows, "value string, t string")
    df.select("value", F.col("t").cast("timestamp").alias("arrived_at")).write.parquet(source)
    messages = spark.readStream.schema("value string, arrived_at timestamp").parquet(source)
    ingest.land_messages(messages, root, str(tmp_path / "checkpoint")).awaitTermination()
    for event_type, n in (("call", 1), ("support", 1)):
        bronze = read_bronze(spark, f"{root}/event_type={event_type}", event_type, multi_line=False)
        assert rows_of(bronze.select("event_type", "event_date", "event_hour")) == [
            (event_type, "2025-01-01", "13")
        ] * n
        landed = ingest.read_landed(spark, root, event_type)
        assert landed.columns == bronze.columns and landed.count() == n
    unknown = spark.read.text(f"{root}/event_type=unknown/event_date=2025-01-01/event_hour=13")
    assert sorted(r["value"] for r in unknown.collect()) == sorted(payloads[2:])


def test_landed_files_are_compressed_and_bounded(spark, tmp_path):
    source, root = str(tmp_path / "messages"), str(tmp_path / "landing")
    lines = spark.range(0, 10, 1, 1).selectExpr("""'{"event_type":"call","sid":"' || id || '"}' as value""", "timestamp'2025-01-01 07:00:00' as t")
    lines.write.parquet(source)
    messages = spark.readStream.schema("value string, t timestamp").parquet(source)
    ingest.land_messages(messages, root, str(tmp_path / "checkpoint"), "t", lines_per_file=4).awaitTermination()
    files = [p for p in (tmp_path / "landing").rglob("part-*")]
    assert len(files) == 3 and all(p.name.endswith(".gz") for p in files)
    assert rows_of(ingest.read_landed(spark, root, "call").select("sid")) == [(str(k),) for k in range(10)]
    assert read_bronze(spark, f"{root}/event_type=call", "call").count() == 10


def test_messages(spark):
    lines = spark.createDataFrame([(json.dumps(event(CALL)),), (json.dumps(event(SUPPORT)),)], "value string")
    calls = ingest.parse_events(lines, "call")
    assert calls.count() == 1
    # A call without customer and phone number is keyed by the caller's number.
    assert calls.select(ingest.message_key(calls).alias("k")).first()["k"] == "01012345678"
    support = ingest.as_messages(ingest.parse_events(lines, "support")).first()
    assert support["key"] == "01012345678" and json.loads(support["value"])["sid"] == "SU1"


def test_all_types_in_one_pass_are_those_of_each_type(spark):
    broken = json.dumps(event(CALL))[:-9]
    payloads = [
        *[json.dumps(event(e, sid=s)) for e in (CALL, SUPPORT) for s in ("1", None)], broken, "no json", "[]",
        '{"event_type": "x", "sid": "2"}', '{"event_type": "payment", "sid": "3", "billing_info": "free", "customer": ""}',
        '{"event_type": "sms", "from": {"phone_number": "4"}}', None,
    ]
    messages = spark.createDataFrame([(p,) for p in payloads], "value string")
    each = []
    for event_type in ingest.EVENT_TYPES:
        events = ingest.parse_events(messages, event_type)
        each += rows_of(events.select("event_type", "sid", "timestamp", ingest.message_key(events).alias("key")))
    assert rows_of(ingest.parse_all_events(messages)) == sorted(each, key=repr) and len(each) >= 6


def test_computed_messages_are_computed_once(spark):
    messages = spark.range(3).select(F.to_json(F.struct(F.lit("call").alias("event_type"), "id")).alias("value"))
    for events in (ingest.parse_events(messages, "call"), ingest.parse_all_events(messages)):
        plan = events._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("StructsToJsonEvaluator") == 1 and events.count() == 3


def test_routing_replaces_a_repeated_batch(spark, tmp_path):
    source, root = str(tmp_path / "events"), str(tmp_path / "routed")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "event_type string, v int").write.parquet(source)

    def run(checkpoint):
        stream = spark.readStream.schema("event_type string, v int").parquet(source)
        ingest.route_by_type(stream, root, str(tmp_path / checkpoint)).awaitTermination()
        return rows_of(spark.read.parquet(root).select("event_type", "v"))

    expected = [("a", 1), ("a", 2), ("b", 3)]
    assert run("first") == expected
    # A lost checkpoint makes batch 0 run again.
    assert run("second") == expected


def test_kafka_options(spark):
    options = ingest.kafka_options("host:9092", ["call", "sms"], max_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "call,sms",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000",
    }
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.read_messages(spark, options)
