"""Work that follows the change: intake ledger, buckets, publishing, stored measures."""

from __future__ import annotations

import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telmart.operators.aggregates import daily_measures, merged_measures, partial_measures
from telmart.operators.scd import scd2_merge
from telmart.plans import jobs
from telmart.scratch import shared_root
from telmart.sinks import archive, intake, tables, versioned
from telmart.sources.bronze import raw_files, read_bronze
from tests.conftest import rows_of


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lake(spark, tmp_path, name):
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    return jobs.Layout(f"{tmp_path}/bronze", name, f"{tmp_path}/tables")


def land(tmp_path, day, file, *sids):
    folder = tmp_path / "bronze" / "support" / day / "07"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text("\n".join(json.dumps({"sid": s, "channel": "app"}) for s in sids))


def sids(spark, layout):
    return sorted(r["sid"] for r in spark.table(layout.table("support_archive")).collect())


def run(spark, layout, run_id, **options):
    jobs.run_silver(spark, layout, run_id, ["support"], on_error="raise", **options)


def test_a_run_reads_its_own_days_of_the_ledger_only(spark, tmp_path, lake):
    for k in range(3):
        land(tmp_path, f"2025-01-0{k + 1}", "a.json", f"S{k}")
        run(spark, lake, f"r{k}")
    run(spark, lake, "r9", dates=["2025-01-02"])
    assert sids(spark, lake) == ["S0", "S1", "S2"]
    table = lake.table("support_archive")
    files = intake.listed(raw_files(spark, f"{lake.bronze_root}/support", ["2025-01-02"]))
    plan = plan_of(intake.unstored_files(files, table))
    scans = re.findall(r"FileScan parquet.*", plan)
    assert scans and all("landing_day" in s.split("PartitionFilters: ")[1].split("]")[0] for s in scans)
    assert "sid" not in plan  # no scan of the archive
    assert intake.unstored_files(files, table).isEmpty()


def test_listing_reads_no_content(spark, tmp_path, lake):
    land(tmp_path, "2025-01-01", "a.json", "S0")
    plan = plan_of(raw_files(spark, f"{lake.bronze_root}/support"))
    assert "content" not in re.search(r"ReadSchema: (\S*)", plan)[1]


def test_a_run_that_broke_off_neither_loses_nor_repeats(spark, tmp_path, lake, monkeypatch):
    land(tmp_path, "2025-01-01", "a.json", "S0", "S1")
    run(spark, lake, "r0")
    land(tmp_path, "2025-01-01", "b.json", "S2", "S3")
    monkeypatch.setattr(archive, "mark_stored", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # its rows are in the archive, perhaps in part
        run(spark, lake, "r1")
    monkeypatch.undo()
    assert sids(spark, lake) == ["S0", "S1", "S2", "S3"]
    land(tmp_path, "2025-01-01", "c.json", "S4")
    for run_id in ("r2", "r2", "r1"):
        run(spark, lake, run_id)
        assert sids(spark, lake) == ["S0", "S1", "S2", "S3", "S4"]
    silver = spark.table(lake.table("support"))
    assert rows_of(silver.groupBy("run_id").count()) == [("r0", 2), ("r2", 3)]


def test_a_claim_without_rows_is_taken_in_later(spark, tmp_path, lake, monkeypatch):
    land(tmp_path, "2025-01-01", "a.json", "S0")
    run(spark, lake, "r0")
    land(tmp_path, "2025-01-02", "b.json", "S1")
    monkeypatch.setattr(archive, "write_table", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        run(spark, lake, "r1")
    monkeypatch.undo()
    run(spark, lake, "r2")
    assert sids(spark, lake) == ["S0", "S1"]


def test_rows_are_not_shuffled_to_a_short_list_of_files(spark, tmp_path, lake, monkeypatch):
    """Before, the list counted as large as its raw files are, and the rows of a file met in one task."""
    plans, write = [], archive.write_table

    def observed(df, *args, **options):
        plans.append(plan_of(df))
        write(df, *args, **options)

    monkeypatch.setattr(archive, "write_table", observed)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")
    try:
        for part, run_id in enumerate(("r0", "r0", "r1")):
            land(tmp_path, "2025-01-01", f"{part}.json", *[f"S{part}-{k:05d}" for k in range(3000)])
            if part:
                (tmp_path / "bronze/support" / f"{part}.json").write_text(json.dumps({"sid": f"S{part}-none"}))
            run(spark, lake, run_id, multi_line=False)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 3
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p and "ShuffledHash" not in p for p in plans)
    archived = spark.table(lake.table("support_archive"))
    assert rows_of(archived.groupBy("run_id", "event_date", "event_hour").count()) == [
        ("r0", "", "", 1), ("r0", "2025-01-01", "07", 6000), ("r1", "", "", 1), ("r1", "2025-01-01", "07", 3000),
    ]
    assert archived.select("sid").distinct().count() == 9002
    assert not [f for f in Path(shared_root(spark)).glob("files-*")]


def test_an_archive_without_ledger_gets_one(spark, tmp_path, lake):
    land(tmp_path, "2025-01-01", "a.json", "S0")
    run(spark, lake, "r0")
    spark.sql(f"drop table {lake.table('support_archive_files')}")
    tmp = tmp_path / "tables" / "support_archive_files"
    tables.write_table(spark.range(0), lake.table("other"))
    assert not spark.catalog.tableExists(lake.table("support_archive_files")) or tmp.exists()
    fresh = jobs.Layout(lake.bronze_root, lake.database, f"{tmp_path}/more")
    land(tmp_path, "2025-01-01", "b.json", "S1")
    run(spark, fresh, "r1")
    assert sids(spark, lake) == ["S0", "S1"]


def test_new_columns_reach_an_older_archive(spark, name):
    tables.write_table(spark.createDataFrame([("a", "r0")], "v string, run_id string"), name, partition_by=["run_id"])
    newer = spark.createDataFrame([("b", {"k": "v"}, "r1")], "v string, more map<string,string>, run_id string")
    tables.add_columns(newer, name)
    tables.write_table(newer, name, partition_by=["run_id"])
    assert rows_of(spark.table(name).select("v", "more")) == [("a", None), ("b", {"k": "v"})]


# Buckets

DIM = "user_id long, plan string, effective_from string, effective_to string, is_current boolean"


def dim_rows(n):
    return [(k, "A", "2020-01-01", "9999-12-31", True) for k in range(n)]


def files_of(tmp_path, table):
    return {str(p) for p in (tmp_path / "tables" / f"{table}__buckets").rglob("*.parquet")}


def test_merges_write_touched_buckets_only(spark, tmp_path, lake):
    dim = spark.createDataFrame(dim_rows(200), DIM)
    jobs.store_bucketed_dim(lake, "dim_user", dim, ["user_id"], buckets=16)
    before = files_of(tmp_path, "dim_user")
    changes = spark.createDataFrame([(5, "B", "2021-05-05"), (6, "B", "2021-05-05")], "user_id long, plan string, effective_from string")
    touched = {r[0] for r in changes.select(versioned.bucket_of(["user_id"], 16)).collect()}
    jobs.merge_dim(spark, lake, "dim_user", changes, ["user_id"], ["plan"])
    new = files_of(tmp_path, "dim_user") - before
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in new} == touched and len(touched) <= 2
    assert before <= files_of(tmp_path, "dim_user")  # nothing was rewritten in place
    wanted = scd2_merge(dim, changes, ["user_id"], ["plan"])
    stored = spark.table(lake.table("dim_user"))
    assert rows_of(stored) == rows_of(wanted.select(*stored.columns))
    assert "PartitionFilters" in plan_of(stored) and "version" in plan_of(stored)
    jobs.merge_dim(spark, lake, "dim_user", changes.limit(0), ["user_id"], ["plan"])
    assert rows_of(spark.table(lake.table("dim_user"))) == rows_of(wanted.select(*stored.columns))
    assert versioned.remove_old_versions(spark, lake.table("dim_user")) == len(touched)
    assert rows_of(spark.table(lake.table("dim_user"))) == rows_of(wanted.select(*stored.columns))
    with pytest.raises(ValueError):
        versioned.merge_versioned(changes, lake.table("dim_user"), ["plan"], lambda a, b: a)


def test_readers_see_the_old_state_until_the_switch(spark, lake, monkeypatch):
    name = lake.table("dim_user")
    jobs.store_bucketed_dim(lake, "dim_user", spark.createDataFrame(dim_rows(20), DIM), ["user_id"], buckets=4)
    changes = spark.createDataFrame([(3, "B", "2021-05-05")], "user_id long, plan string, effective_from string")
    old = rows_of(spark.table(name))
    monkeypatch.setattr(versioned, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        jobs.merge_dim(spark, lake, "dim_user", changes, ["user_id"], ["plan"])
    monkeypatch.undo()
    assert rows_of(spark.table(name)) == old
    jobs.merge_dim(spark, lake, "dim_user", changes, ["user_id"], ["plan"])
    assert spark.table(name).count() == 21 and versioned.is_versioned(spark, name)
    # All rows at once, to none and back.
    for n in (0, 7):
        jobs.store_bucketed_dim(lake, "dim_user", spark.createDataFrame(dim_rows(n), DIM), ["user_id"], buckets=4)
        assert spark.table(name).count() == n
    assert not versioned.is_versioned(spark, lake.table("absent"))


def test_new_keys_open_buckets(spark, lake):
    jobs.store_bucketed_dim(lake, "dim_user", spark.createDataFrame(dim_rows(1), DIM), ["user_id"], buckets=64)
    changes = spark.createDataFrame([(k, "N", "2021-05-05") for k in range(1, 40)], "user_id long, plan string, effective_from string")
    jobs.merge_dim(spark, lake, "dim_user", changes, ["user_id"], ["plan"])
    assert sorted(r["user_id"] for r in spark.table(lake.table("dim_user")).collect()) == list(range(40))


def test_a_long_chain_takes_linear_work(spark):
    """20,000 days of one key; frames to the end of the chain took the square of that."""
    dim = spark.createDataFrame([(1, "A", "1900-01-01", "9999-12-31", True)], DIM)
    days = spark.range(20_000).select(
        F.lit(1).cast("long").alias("user_id"), F.concat(F.lit("P"), F.col("id") % 7).alias("plan"),
        F.date_add(F.lit("1950-01-01"), F.col("id").cast("int")).cast("string").alias("effective_from"),
    )
    merged = scd2_merge(dim, days, ["user_id"], ["plan"])
    assert merged.count() == 20_001
    assert merged.filter("is_current").first()["effective_from"] == "2004-10-03"
    # Frames that grow from the start of a chain, whichever way it is read; none to its end.
    frames = re.findall(r"specifiedwindowframe\(RowFrame, (\S+), (\S+)\)", plan_of(merged))
    assert all(a.startswith("unboundedpreceding") or "Following" not in b for a, b in frames)


# Publishing


def test_conflicting_rows_are_set_apart(spark, name):
    def publish(*rows):
        return tables.publish_new_rows(spark.createDataFrame(rows, "k string, v int"), name, "k")

    assert publish(("a", 1)) == tables.PublishReport(1, 1, 0, 0)
    assert not spark.catalog.tableExists(f"{name}_conflicts")
    found = publish(("b", 1), ("b", 1), ("b", 2), ("a", 9), ("a", 1))
    assert found == tables.PublishReport(5, 1, 2, 2)
    assert rows_of(spark.table(name)) == [("a", 1), ("b", 1)]
    assert rows_of(spark.table(f"{name}_conflicts")) == [("a", 9), ("b", 2)]
    assert publish(("b", 1), ("b", 2), ("a", 9)) == tables.PublishReport(3, 0, 1, 2)
    assert rows_of(spark.table(f"{name}_conflicts")) == [("a", 9), ("b", 2)]  # once
    assert publish() == tables.PublishReport(0, 0, 0, 0)


def test_publishing_leaves_nothing_in_the_shared_folder(spark, tmp_path, name):
    """Nor does a batch without news write to the table."""
    left = lambda: sorted(p.name for p in Path(shared_root(spark).removeprefix("file:")).glob("pending-*"))
    before, rows = left(), spark.range(5).selectExpr("cast(id as string) as k", "id as v")
    tables.publish_new_rows(rows, name, "k", path=str(tmp_path / "t"))
    files = sorted((tmp_path / "t").rglob("part-*"))
    assert tables.publish_new_rows(rows, name, "k") == tables.PublishReport(5, 0, 5, 0)
    assert left() == before and sorted((tmp_path / "t").rglob("part-*")) == files


def test_nulls_of_other_columns_are_other_rows(spark, name):
    rows = spark.createDataFrame([("a", None, 1), ("b", 1, None)], "k string, v int, w int")
    tables.publish_new_rows(rows, name, "k")
    turned = spark.createDataFrame([("a", 1, None), ("b", 1, None)], "k string, v int, w int")
    assert tables.publish_new_rows(turned, name, "k") == tables.PublishReport(2, 0, 1, 1)


def test_day_ranges_prune_a_published_fact(spark, name):
    rows = spark.range(60).selectExpr(
        "cast(id as string) as k", "date_add(date '2025-01-01', cast(id % 30 as int)) as event_day"
    )
    tables.publish_new_rows(rows, name, "k", ["event_day"])
    week = spark.table(name).filter("event_day between '2025-01-05' and '2025-01-07'")
    assert week.count() == 6
    assert "event_day" in plan_of(week).split("PartitionFilters: ")[1].split("]")[0]
    assert len({p for p in week.inputFiles() if re.search("event_day=2025-01-0[567]", p)}) <= len(week.inputFiles())
    assert tables.publish_new_rows(rows, name, "k", ["event_day"]).new == 0


SILVER = "sid string, amount double, is_rejected boolean, rejection_reason string, landing_day string, run_id string"


@pytest.fixture
def silver_runs(spark, lake):
    rows = [(f"s{k % 4}", 1.0, k % 5 == 0, None, "d", f"r{k // 10}") for k in range(20)]  # with copies
    tables.write_table(spark.createDataFrame(rows, SILVER), lake.table("support"), partition_by=["landing_day", "run_id"])
    return sorted((r[0], r[5]) for r in rows if not r[2])


def test_broken_and_repeated_publishing_adds_every_row_once(spark, lake, silver_runs):
    store, calls = [], []

    def append(rows, target, options):
        calls.append(target)
        found = [tuple(r) for r in rows.select("sid", "amount", "run_id", "landing_day").collect()]
        store.extend(found if len(calls) > 1 else found[:3])
        if len(calls) == 1:
            raise OSError("gone")

    def published(session, target, options, run_id):
        rows = [r for r in store if r[2] == run_id]
        return session.createDataFrame(rows, "sid string, amount double, run_id string, landing_day string")

    def publish(**options):
        return jobs.publish_silver(
            spark, lake, {}, {"support": "t"}, "continue", append=append, published=published, **options
        ).first()["status"]

    assert [publish(), publish(), publish()] == ["failed", "ok", "ok"]
    assert sorted((r[0], r[2]) for r in store) == silver_runs
    assert len(calls) == 3  # the broken one, its repair, and the other run
    assert publish(run_ids=["r1"]) == "ok" and len(calls) == 3


# Measures


def test_stored_measures_equal_whole_ones(spark, lake):
    fact = spark.range(200).selectExpr(
        "cast(id as string) as k", "date_add(date '2025-01-01', cast(id % 5 as int)) as event_day", "id % 3 as g",
        "case when id % 4 = 0 then null else cast(id as double) end as amount",
    )
    table = lake.table("fact_x")
    for part in (fact.filter("id < 90" if "id" in fact.columns else "cast(k as int) < 90"), fact, fact):
        tables.publish_new_rows(part, table, "k", ["event_day"])
        days = tables.touched_partitions(part, "event_day")
        jobs.update_measures(spark, lake, "fact_x", "measures", ["g"], ["amount"], ["amount"], days)
    merged = merged_measures(spark.table(lake.table("measures")), ["g"], ["amount"], ["amount"])
    assert rows_of(merged) == rows_of(daily_measures(fact, ["g"], ["amount"], ["amount"]))
    empty = merged_measures(partial_measures(fact.filter("g is null"), ["g"], ["amount"]), ["g"], ["amount"])
    assert empty.count() == 0
    with pytest.raises(LookupError):
        jobs.update_measures(spark, lake, "absent", "measures", ["g"])
