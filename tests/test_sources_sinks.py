from __future__ import annotations

import json
from pathlib import Path
from unittest import mock

import pytest

from telmart.plans import jobs
from telmart.plans.facts import build_fact
from telmart.plans.silver import normalise, to_silver
from telmart.schemas import raw_schema
from telmart.scratch import scratch_path, shared_root
from telmart.sinks import archive, jdbc, tables
from telmart.sources.bronze import landing_paths, read_bronze
from telmart.sources.seeds import read_seed
from telmart.sources.tables import read_table, row_count
from tests.conftest import rows_of
from tests.test_quality import CALL, SUPPORT, events


def event(base, **changes):
    """A raw event as its JSON object."""
    out = {**base, **changes}
    for side in ("from", "to"):
        if isinstance(out.get(side), tuple):
            out[side] = dict(zip(("phone_number", "cell_site", "imei"), out[side]))
    if isinstance(out.get("billing_info"), tuple):
        out["billing_info"] = dict(zip(("amount", "currency"), out["billing_info"]))
    return out


def land(root: Path, folder: str, file: str, *objects, lines=False):
    target = root / folder / file
    target.parent.mkdir(parents=True, exist_ok=True)
    if lines:
        target.write_text("\n".join(json.dumps(o) for o in objects))
    else:
        target.write_text(json.dumps(list(objects) if len(objects) > 1 else objects[0], indent=1))
    return target


def test_bronze_scan(spark, tmp_path):
    land(tmp_path, "call/2025-01-01/03", "a.json", event(CALL), event(CALL, sid="CA2"))
    land(tmp_path, "call/2025-01-01/04", "a.json", event(CALL, sid="CA3", call_duration_seconds=480))
    land(tmp_path, "call/event_date=2025-01-02/event_hour=05", "b.json", event(CALL, sid="CA4"))
    land(tmp_path, "call", "loose.json", event(CALL, sid="CA5", billing_info={"amount": "abc"}))
    bronze = read_bronze(spark, f"{tmp_path}/call", "call")
    found = {r["sid"]: (r["event_date"], r["event_hour"]) for r in bronze.collect()}
    assert found == {
        "CA1": ("2025-01-01", "03"), "CA2": ("2025-01-01", "03"), "CA3": ("2025-01-01", "04"),
        "CA4": ("2025-01-02", "05"), "CA5": ("", ""),
    }
    sources = {Path(r["source_file"]).name for r in bronze.select("source_file").distinct().collect()}
    assert sources == {"a.json", "b.json", "loose.json"}
    one_day = read_bronze(spark, f"{tmp_path}/call", "call", dates=["2025-01-02"])
    assert [r["sid"] for r in one_day.collect()] == ["CA4"]
    one_hour = read_bronze(spark, f"{tmp_path}/call", "call", dates=["2025-01-01"], hours=["04"])
    assert [r["sid"] for r in one_hour.collect()] == ["CA3"]
    # Numbers arrive as text, so "abc" can be reported and 480 be typed.
    silver = {r["sid"]: r for r in to_silver(bronze, "call").collect()}
    assert silver["CA5"]["rejection_reason"].startswith("currency come with null value, amount must")
    assert silver["CA3"]["call_duration_seconds"] == 480
    with pytest.raises(ValueError):
        landing_paths("/x", hours=["03"])


def test_json_lines_are_read_whole(spark, tmp_path):
    land(tmp_path, "s/2025-01-01/03", "a.json", *[event(SUPPORT, sid=f"SU{i}") for i in range(9)], lines=True)
    for multi_line in (False, True):
        assert read_bronze(spark, f"{tmp_path}/s", "support", multi_line=multi_line).count() == 9


@pytest.mark.parametrize("multi_line", [False, True])
def test_malformed_records_keep_their_text(spark, tmp_path, multi_line):
    file = land(tmp_path, "s/2025-01-01/03", "a.json", event(SUPPORT), event(SUPPORT, sid="SU2"), lines=True)
    file.write_text(file.read_text() + '\n{"sid": broken\n\n')
    found = read_bronze(spark, f"{tmp_path}/s", "support", multi_line=multi_line, keep_malformed=True)
    assert sorted(r["malformed_text"] or "" for r in found.collect()) == ["", "", '{"sid": broken']


def test_seed_scan(spark, tmp_path):
    file = land(tmp_path, "seed", "agent.json", {"agent_id": "AG1", "name": "N"}, {"agent_id": "AG2"})
    seed = read_seed(spark, str(file), "agent")
    assert seed.columns == ["agent_id", "name", "department", "city", "status"]
    assert row_count(seed) == 2


def test_seed_lines_are_read_whole(spark, tmp_path):
    file = land(tmp_path, "seed", "agent.json", *[{"agent_id": f"AG{i}"} for i in range(5)], lines=True)
    land(tmp_path, "seed", "more.json", {"agent_id": "AG5"}, {"agent_id": "AG6"})
    seed = read_seed(spark, str(file.parent), "agent")
    assert sorted(r["agent_id"] for r in seed.collect()) == [f"AG{i}" for i in range(7)]


@pytest.mark.parametrize("broken", ['{"sid": "SU0", "cha', '{"sid": broken}', "no json", "[1]", '{"sid": "SU0",'])
def test_broken_first_line_loses_no_others(spark, tmp_path, broken):
    file = land(tmp_path, "s/2025-01-01/03", "a.json", event(SUPPORT), event(SUPPORT, sid="SU2"), lines=True)
    file.write_text(broken + "\n" + file.read_text())
    found = read_bronze(spark, f"{tmp_path}/s", "support", keep_malformed=True).collect()
    assert len(found) == 3 and sum(r["sid"] is not None for r in found) >= 2
    assert {event(SUPPORT)["sid"], "SU2"} <= {r["sid"] for r in found}


def test_table_writes(spark, name):
    assert read_table(spark, name) is None
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    tables.write_table(df, name, partition_by=["p"])
    tables.write_table(df.select("v", "p"), name, partition_by=["p"])
    assert rows_of(read_table(spark, name).select("p", "v")) == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]
    tables.write_table(df.filter("p = 'a'"), name, tables.OVERWRITE, ["p"])
    assert rows_of(read_table(spark, name).select("p", "v")) == [("a", 1), ("b", 2), ("b", 2)]


def test_overwrite_spares_other_partitions_in_any_session(spark, name):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "static")
    try:
        df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
        tables.write_table(df, name, partition_by=["p"])
        tables.write_table(df.filter("p = 'a'"), name, tables.OVERWRITE, ["p"])
        assert spark.table(name).count() == 2
        assert spark.conf.get(setting) == "static"
    finally:
        spark.conf.set(setting, before)


def test_unknown_columns_are_not_dropped(spark, name):
    tables.write_table(spark.sql("select 1 as a"), name)
    with pytest.raises(ValueError, match="new"):
        tables.write_table(spark.sql("select 1 as a, 2 as new"), name)


def test_other_formats_use_the_catalog_writer(spark):
    df = mock.MagicMock()
    catalog = df.sparkSession.catalog
    catalog.tableExists.return_value = False
    df.columns = df.sparkSession.table.return_value.columns = ["a"]
    tables.write_table(df, "c.t", table_format="iceberg")
    df.writeTo.return_value.using.return_value.create.assert_called_once()
    catalog.tableExists.return_value = True
    tables.write_table(df, "c.t", table_format="iceberg")
    df.select.return_value.writeTo.return_value.append.assert_called_once()
    tables.write_table(df, "c.t", tables.OVERWRITE, table_format="iceberg")
    df.select.return_value.writeTo.return_value.overwritePartitions.assert_called_once()


def test_publish_is_idempotent(spark, name):
    silver = to_silver(
        events(
            spark, "call", {}, {}, {"sid": "CA2"}, {"sid": "CA3", "timestamp": "2025-05-07 00:00:00"}
        ),
        "call",
    )
    fact = build_fact(silver, "calls")
    for _ in range(2):
        tables.publish_new_rows(fact, name, "transaction_sk", ["date_sk"])
        assert sorted(r["call_id"] for r in spark.table(name).collect()) == ["CA1", "CA2", "CA3"]
    more = build_fact(to_silver(events(spark, "call", {}, {"sid": "CA9"}), "call"), "calls")
    tables.publish_new_rows(more, name, "transaction_sk", ["date_sk"])
    assert spark.table(name).count() == 4


def test_publish_scans_only_touched_partitions(spark, name):
    df = spark.createDataFrame([("k1", "d1"), ("k2", "d2")], "k string, d string")
    tables.publish_new_rows(df, name, "k", ["d"])
    assert tables.touched_partitions(df.filter("d = 'd1'"), "d") == ["d1"]
    assert sorted(tables.touched_partitions(df, "d")) == sorted({r["d"] for r in df.collect()})
    tables.publish_new_rows(df, name, "k", ["d"])
    assert spark.table(name).count() == 2


def test_archive_and_manifest(spark, tmp_path, name):
    land(tmp_path, "support/2025-01-01/03", "a.json", event(SUPPORT))
    land(tmp_path, "support/2025-01-01/04", "a.json", event(SUPPORT, sid="SU2"))
    land(tmp_path, "support", "with space.json", event(SUPPORT, sid="SU3"))
    bronze = read_bronze(spark, f"{tmp_path}/support", "support")
    for _ in range(2):
        snapshot = archive.archive_snapshot(normalise(bronze, "support"), name, "2025010105")
    assert snapshot.count() == 3 and spark.table(name).count() == 3
    manifest = archive.run_manifest(snapshot)
    placed = archive.archived_location(manifest, f"{tmp_path}/arch", "support", "2025-02-02")
    late = land(tmp_path, "support/2025-01-01/03", "late.json", event(SUPPORT, sid="SU4"))
    for _ in range(2):
        archive.archive_files(placed)
    kept = sorted(str(p.relative_to(tmp_path / "arch")) for p in (tmp_path / "arch").rglob("*.json"))
    assert kept[:2] == ["support/20250101/03/a.json", "support/20250101/04/a.json"]
    assert len(kept) == 3 and kept[2].startswith("support/20250202/") and "/support/with" in kept[2]
    archive.purge_bronze(manifest, dates=["2025-01-01"], hours=["03"])
    left = sorted(p.name for p in (tmp_path / "support").rglob("*.json"))
    assert left == ["a.json", "late.json", "with space.json"]
    for _ in range(2):
        archive.purge_bronze(manifest)
    assert [p for p in (tmp_path / "support").rglob("*.json")] == [late]


def test_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert scratch_path(spark, "x").startswith(f"{root}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shared_folder_is_required_on_a_cluster():
    remote = mock.MagicMock()
    remote.conf.get.return_value = None
    remote.sparkContext.getCheckpointDir.return_value = None
    remote.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError):
        shared_root(remote)


def test_jdbc_options():
    options = jdbc.jdbc_options(host="h", port=1, database="d", user="u", password="p")
    assert options["url"] == "jdbc:clickhouse://h:1/d" and "ssl" not in options
    env = {"W_URL": "jdbc:x", "W_SSL": "true", "W_COMPRESS": "0", "W_PASSWORD": "s"}
    found = jdbc.jdbc_options_from_env(env, prefix="W_", batch_size=5000, connections=8)
    assert found == {
        "url": "jdbc:x", "user": "default", "password": "s", "driver": jdbc.DEFAULT_DRIVER,
        "ssl": "true", "compress": "0", "batchsize": "5000", "numPartitions": "8",
    }


def test_jdbc_append_and_publish():
    df = mock.MagicMock()
    jdbc.append_jdbc(df, "t", {"url": "jdbc:x"})
    df.write.format.assert_called_with("jdbc")
    with mock.patch.object(jdbc, "new_rows") as fresh, mock.patch.object(jdbc, "touched_partitions", return_value=["a", "b'"]):
        jdbc.publish_jdbc(df, "t", {"url": "jdbc:x", "user": "u"}, "sk", "date_sk")
    call = df.sparkSession.read.jdbc.call_args.kwargs
    assert call["table"] == "(select sk from t where date_sk in ('a', 'b''')) published"
    assert len(call["predicates"]) == 16 and call["properties"] == {"user": "u"}
    fresh.return_value.write.format.assert_called_with("jdbc")


def small_lake(spark, tmp_path, name):
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    layout = jobs.Layout(str(tmp_path / "bronze"), name, str(tmp_path / "tables"))
    land(tmp_path, "bronze/call/2025-05-06/13", "a.json", event(CALL), event(CALL, sid=None))
    land(tmp_path, "bronze/support/2025-05-06/13", "b.json", event(SUPPORT))
    return layout


def test_lakehouse_jobs(spark, tmp_path, name):
    layout = small_lake(spark, tmp_path, name)
    status = jobs.run_silver(spark, layout, "2025050613", purge=True)
    assert dict(r[:2] for r in rows_of(status)) == {
        "call": "ok", "support": "ok", "sms": "failed", "payment": "failed", "recharge": "failed",
    }
    assert not list((tmp_path / "bronze").rglob("*.json"))
    assert rows_of(spark.table(f"{name}.calls").select("sid", "is_rejected", "landing_day")) == sorted(
        [("CA1", False, "2025-05-06"), (None, True, "2025-05-06")], key=repr
    )
    with pytest.raises(Exception):
        jobs.run_silver(spark, layout, "x", ["sms"], on_error=jobs.RAISE)

    seeds = {
        "agent": land(tmp_path, "seeds", "a.json", {"agent_id": "AG1001", "name": "N", "department": "D"}),
        "user": land(tmp_path, "seeds", "u.json", {"user_sk": 1, "msisdn": "01012345678", "is_current": True}),
        "device": land(tmp_path, "seeds", "d.json", {"tac": "35846279", "brand": "Samsung"}),
        "cell_site": land(tmp_path, "seeds", "c.json", {"cell_id": "CELL00001", "city": "Cairo"}),
    }
    with pytest.raises(LookupError):
        jobs.build_dims(spark, layout)
    for _ in range(2):
        jobs.load_seed_dims(spark, layout, {k: str(v) for k, v in seeds.items()})
        status = jobs.build_dims(spark, layout, extended=True)
        assert status.filter("status = 'ok'").count() == 6
    assert [spark.table(f"{name}.dim_{d}").count() for d in ("agent", "date", "time")] == [1, 365, 1440]

    for _ in range(2):
        status = jobs.build_facts(spark, layout, ["calls", "SUPPORT"])
        assert [r["status"] for r in status.collect()] == ["ok", "ok"]
        assert spark.table(f"{name}.fact_calls").count() == 1
    with pytest.raises(LookupError):
        jobs.build_facts(spark, layout)
    with pytest.raises(ValueError):
        jobs.build_facts(spark, layout, ["data"])
    missing = jobs.build_facts(spark, layout, ["sms"], on_error=jobs.CONTINUE).first()
    assert (missing["step"], missing["status"]) == ("fact_sms", "failed")

    sent = {}
    jobs.publish_silver(
        spark, layout, {}, {"calls": "silver_calls", "support": "silver_support"},
        append=lambda df, target, options: sent.update({target: df.collect()}),
    )
    assert [r["sid"] for r in sent["silver_calls"]] == ["CA1"]
    assert "is_rejected" not in sent["silver_support"][0].asDict()
    with pytest.raises(ValueError):
        jobs.run_steps(spark, {}, "ignore")


def test_events_are_in_one_run_only(spark, tmp_path, name):
    layout = small_lake(spark, tmp_path, name)
    for run in ("2025050613", "2025050613", "2025050614"):
        jobs.bronze_to_silver(spark, layout, "call", run)
    calls = spark.table(f"{name}.calls")
    assert rows_of(calls.groupBy("run_id").count()) == [("2025050613", 2)]
    land(tmp_path, "bronze/call/2025-05-06/14", "a.json", event(CALL, sid="CA9"))
    jobs.bronze_to_silver(spark, layout, "call", "2025050614")
    assert rows_of(spark.table(f"{name}.calls").groupBy("run_id").count()) == [("2025050613", 2), ("2025050614", 1)]
    # A fact build of one run reads only its silver partition.
    silver = jobs._silver_rows(spark, layout, "calls", ["2025050614"])
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and silver.count() == 1
    jobs.build_facts(spark, layout, ["calls"], run_ids=["2025050699"])
    assert spark.table(f"{name}.fact_calls").count() == 0
    jobs.build_facts(spark, layout, ["calls"], run_ids=["2025050614"])
    assert spark.table(f"{name}.fact_calls").count() == 1


def test_a_purged_run_can_be_repeated(spark, tmp_path, name):
    layout = small_lake(spark, tmp_path, name)
    jobs.bronze_to_silver(spark, layout, "call", "2025050613", purge=True)
    assert not list((tmp_path / "bronze/call").rglob("*.json"))
    # The same file name again, with other content, and a line that is no JSON.
    file = land(tmp_path, "bronze/call/2025-05-06/13", "a.json", event(CALL, sid="CA7"), lines=True)
    file.write_text(file.read_text() + "\nnot json")
    jobs.bronze_to_silver(spark, layout, "call", "2025050613", purge=True)
    assert sorted(r[0] or "" for r in spark.table(f"{name}.calls").select("sid").collect()) == ["", "", "CA1", "CA7"]
    archived = spark.table(f"{name}.calls_archive")
    assert [r[0] for r in archived.select("malformed_text").collect() if r[0]] == ["not json"]
    assert len(list((tmp_path / "bronze_archive").rglob("*.json"))) >= 1


def test_archived_paths_do_not_collide(spark):
    files = [
        ("s3a://b/call/2025-01-01/03/x/a.json", "2025-01-01", "03"), ("s3a://b/call/2025-01-01/03/y/a.json", "2025-01-01", "03"),
        ("s3a://b/call/p/a.json", "", ""), ("s3a://b/call/q/a.json", "", ""), ("s3a://b/call/2025-01-01/a.json", "2025-01-01", ""),
    ]
    frame = spark.createDataFrame(files, "source_file string, event_date string, event_hour string")
    placed = archive.archived_location(frame, "/arch", "call", "2025-09-09")
    assert [r["archived_file"] for r in placed.collect()] == [
        "/arch/call/20250101/03/x/a.json", "/arch/call/20250101/03/y/a.json",
        "/arch/call/20250909/b/call/p/a.json", "/arch/call/20250909/b/call/q/a.json", "/arch/call/20250101/a.json",
    ]


def test_bronze_to_silver_does_not_shuffle(spark):
    silver = to_silver(spark.createDataFrame([], raw_schema("sms")), "sms")
    assert "Exchange" not in silver._jdf.queryExecution().executedPlan().toString()
