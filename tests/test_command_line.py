from __future__ import annotations

import pytest

from telmart.__main__ import _arguments, run
from telmart.plans import jobs
from tests.conftest import rows_of
from tests.test_quality import CALL
from tests.test_sources_sinks import event, land


def test_jobs_from_the_command_line(spark, tmp_path, name):
    land(tmp_path, "bronze/call/2025-05-06/13", "a.json", event(CALL), event(CALL, sid="CA2"))
    agent = land(tmp_path, "seeds", "agent.json", {"agent_id": "AG1", "name": "N", "department": "D"})
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    where = ["--database", name, "--table-root", f"{tmp_path}/tables"]

    def job(*words):
        return run(spark, _arguments([*words, *where]))

    status = job("silver", "call", "--bronze", f"{tmp_path}/bronze", "--run-id", "r1", "--gather")
    assert rows_of(status) == [("call", "ok", None)]
    assert rows_of(job("seeds", f"agent={agent}")) == [("seed_agent", "ok", None)]
    for _ in range(2):
        assert rows_of(job("facts", "calls")) == [("fact_calls", "ok", None)]
    profile = job("profile", "fact_calls", "absent")
    assert {(r["table_name"], r["row_count"]) for r in profile.collect()} == {("fact_calls", 2)}

    assert job("counts", "fact_calls", "calls", "absent").first().asDict() == {"fact_calls": 2, "calls": 2}
    with pytest.raises(ValueError):
        job("purge", "call", "--bronze", f"{tmp_path}/bronze")
    assert list((tmp_path / "bronze").rglob("a.json"))
    purge = ("purge", "call", "--bronze", f"{tmp_path}/bronze", "--runs", "r1")
    assert rows_of(job(*purge, "--dates", "2025-05-07")) == [("call", "ok", None)]
    assert list((tmp_path / "bronze").rglob("a.json"))
    assert rows_of(job(*purge, "--hours", "13")) == [("call", "ok", None)]
    assert not list((tmp_path / "bronze").rglob("a.json"))
    assert list((tmp_path / "bronze_archive").rglob("a.json"))


def test_masters_and_merges_from_the_command_line(spark, tmp_path, name):
    master = land(tmp_path, "masters", "user.json", {"msisdn": "01012345678", "age": 30}, {"msisdn": "01112345678"})
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    where = ["--database", name, "--table-root", f"{tmp_path}/tables"]

    def job(*words):
        return run(spark, _arguments([*words, *where]))

    assert rows_of(job("masters", f"user={master}")) == [("seed_user", "ok", None)]
    assert spark.table(f"{name}.seed_user").count() == 2
    with pytest.raises(ValueError):
        job("masters", f"agent={master}")
    layout = jobs.Layout("", name, f"{tmp_path}/tables")
    dim = spark.createDataFrame(
        [("u", "A", "2020-01-01", "9999-12-31", True)],
        "user string, plan string, effective_from string, effective_to string, is_current boolean",
    )
    jobs.store_bucketed_dim(layout, "dim_x", dim, ["user"], buckets=4)
    changes = spark.createDataFrame([("u", "B", "2021-01-01")], "user string, plan string, effective_from string")
    changes.write.parquet(f"{tmp_path}/changes")
    status = job("merge", "dim_x", f"{tmp_path}/changes", "--keys", "user", "--tracked", "plan")
    assert rows_of(status) == [("dim_x", "ok", None)]
    assert rows_of(spark.table(f"{name}.dim_x").select("plan", "effective_from", "is_current")) == [
        ("A", "2020-01-01", False), ("B", "2021-01-01", True),
    ]
    with pytest.raises(ValueError):
        job("merge", "dim_x")
