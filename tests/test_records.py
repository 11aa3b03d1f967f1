"""Cutting raw text into records, rescued fields and boolean rules."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from telmart.functions.casts import to_boolean
from telmart.plans.jobs import Layout, load_seed_dims, run_silver
from telmart.schemas import raw_schema
from telmart.sources.bronze import raw_files, read_bronze
from telmart.sources import records
from telmart.sources.records import (
    RESCUED, cut_records, file_records, line_records, parsed, piecewise_cutter, scanner,
)
from telmart.sources.seeds import read_seed
from telmart.streaming.ingest import read_bronze_stream, stream_silver

ONE, TWO, THREE = '{"sid": "1"}', '{"sid":"2","x":{"y":["}{", "a\\"]{b"]}}', '{"sid":"3"}'
PRETTY = json.dumps({"sid": "1", "x": {"y": [{"z": 1}, {"z": 2}]}}, indent=2)
LAYOUTS = {
    "lines": (f"{ONE}\n{TWO}\r\n\n{THREE}\n", [ONE, TWO, THREE]),
    "on one line": (f"{ONE}{TWO} {THREE}", [ONE, TWO, THREE]),
    "with commas": (f"{ONE},{TWO}\n,{THREE}", [ONE, TWO, THREE]),
    "pretty": (f"{PRETTY}\n{PRETTY}\n", [PRETTY, PRETTY]),
    "one": (PRETTY, [PRETTY]),
    "array": (f"[{ONE}, {TWO},\n{THREE}]", [ONE, TWO, THREE]),
    "arrays": (f"[{ONE}]\n[{TWO},{THREE}]", [ONE, TWO, THREE]),
    "array of arrays": (f"[[{ONE}],[{TWO}]]", [ONE, TWO]),
    "broken item": (f'[{ONE},{{"sid": oops}},{THREE}]', [ONE, '{"sid": oops}', THREE]),
    "broken pretty item": (f'[\n  {ONE},\n  {{\n    "sid": oops\n  }},\n  {THREE}\n]', [ONE, '{\n    "sid": oops\n  }', THREE]),
    "cut in a string": (f'{{"sid": "cu\n{TWO}\n{THREE}', ['{"sid": "cu', TWO, THREE]),
    "cut before a value": (f'{{"sid":\n{TWO}\n{THREE}', ['{"sid":', TWO, THREE]),
    "cut at the end": (f'{ONE}\n{{"sid": "cu', [ONE, '{"sid": "cu']),
    "no json": ("no json", ["no json"]),
    "text between": (f"{ONE} and {TWO}\n{THREE}", [ONE, f"and {TWO}", THREE]),
    "numbers": (f"[1, {ONE}, null]", ["1", ONE, "null"]),
    "empty": ("", []),
    "blank": (" \r\n\t\n", []),
    "empty array": ("[]", []),
    "byte order mark": (f"﻿[{ONE}]", [ONE]),
}


def bare(text):
    try:
        return json.loads(text)
    except ValueError:
        return text.strip()


@pytest.mark.parametrize("name", LAYOUTS)
def test_scanner_finds_every_value(name):
    text, wanted = LAYOUTS[name]
    assert [bare(r) for r in scanner()(text)] == [bare(w) for w in wanted]


def test_files_and_lines_give_the_same_records(spark):
    rows = [(n, t) for n, (t, _) in LAYOUTS.items()]
    texts = spark.createDataFrame([*rows, ("null", None)], "name string, value string")
    found = {r["name"]: r["r"] or [] for r in texts.select("name", file_records().alias("r")).collect()}
    for name, (_, wanted) in LAYOUTS.items():
        assert [bare(r) for r in found[name]] == [bare(w) for w in wanted], name
    assert found["null"] == []
    lines = texts.select("name", F.posexplode(F.split("value", "\n")).alias("at", "value"))
    by_line = lines.select("name", "at", F.posexplode(line_records()).alias("no", "r")).collect()
    for name, (text, wanted) in LAYOUTS.items():
        if "pretty" in name or name == "one":
            continue  # a value over several lines needs the whole file
        got = [bare(r["r"]) for r in sorted(by_line, key=lambda r: (r["at"], r["no"])) if r["name"] == name]
        assert got == [bare(w) for w in wanted], name


def test_scanner_is_linear_in_broken_lines():
    text = "\n".join('{"a": {"b": [' for _ in range(20_000))
    assert len(scanner()(text)) == 20_000
    deep = '{"a":' * 50_000
    assert scanner()(deep) == [deep]


@pytest.mark.parametrize("step", [1, 2, 7])
@pytest.mark.parametrize("whole", [True, False])
def test_pieces_give_the_records_of_the_whole(step, whole):
    odd = [
        '  {"a": oops\n    {"b": 1}\n  {"c": 2}', '{"a": "x \\\\" } y", oops} {"b": "}"}\n', '12 , 13\n1.5, tru\n"x",{"a":1}',
        '[{"a": oops "}, {"b": 1}]\n{"c": [1,\n2]}', '\t {"a": {"b": [}\n\t [{"c": 1}]', '{"a": "\\ud83d\\ude00"}{', "-Infinity]12",
    ]
    for text in [*odd, *(t for t, _ in LAYOUTS.values()), "".join(t for t, _ in LAYOUTS.values())]:
        cut, found = piecewise_cutter(whole), []
        for at in range(0, len(text), step):
            found += cut(text[at : at + step], False)
        found += cut("", True)
        parts = [text] if whole else text.replace("\r\n", "\n").split("\n")
        assert found == [r for part in parts for r in scanner()(part)], text


def test_pieces_are_held_no_longer_than_their_values():
    cut = piecewise_cutter(True)
    assert sum(len(cut(piece, False)) for piece in ['[{"sid": oops},', *[TWO + ","] * 50]) >= 49
    cut = piecewise_cutter(True)
    assert cut(PRETTY[:40], False) == [] and len(cut(PRETTY[40:] + "\n" + PRETTY[:10], False)) == 1
    deep = piecewise_cutter(True)
    assert sum(len(deep('{"a": [', False)) for _ in range(20_000)) == 0 and len(deep("", True)) == 1


@pytest.mark.parametrize("mode", ["lines", "whole", "every file"])
def test_large_files_and_lines_are_cut_in_pieces(spark, tmp_path, monkeypatch, mode):
    monkeypatch.setattr(records, "LONGEST_TEXT", 200)
    folder = tmp_path / "support" / "2025-01-01" / "07"
    folder.mkdir(parents=True)
    many = [f'{{"sid": "{k}", "channel": "é}}{{"}}' for k in range(40)]
    layouts = {
        "line": "".join(many), "line and end": "".join(many) + "\n", "array": f'[{{"sid": oops}},{",".join(many)}]',
        "lines": "\n".join(many), "mark": "\ufeff" + " ".join(many), "cut": "\r\n".join([" ".join(many), '{"sid": "cut', many[0]]),
        "open": "".join(many) + '{"sid": "cut', "text": "x" * 300, "small": "\n".join(many[:3]), "one value": json.dumps({"sid": "v", "reason": "y" * 500}),
    }
    if mode != "lines":
        layouts |= {"pretty": "\n".join(json.dumps(json.loads(m), indent=2) for m in many), "small pretty": PRETTY}
    for name, text in layouts.items():
        (folder / f"{name}.json").write_text(text)
    found = read_bronze(
        spark, f"{tmp_path}/support", "support", multi_line=mode != "lines", keep_malformed=True, every_file=mode == "every file"
    )
    if mode == "lines":
        texts = [line for text in layouts.values() for line in text.split("\n")]
    else:
        texts = list(layouts.values())
    wanted = [r for text in texts for r in scanner()(text)]
    rows = found.collect()
    assert sorted(r["malformed_text"] for r in rows if r["malformed_text"]) == sorted(
        r for r in wanted if not isinstance(bare(r), dict)
    )
    assert sorted(r["sid"] or "" for r in rows if not r["malformed_text"]) == sorted(
        bare(r)["sid"] for r in wanted if isinstance(bare(r), dict)
    )
    assert {(r["event_date"], r["event_hour"]) for r in rows} == {("2025-01-01", "07")}
    assert {r["source_file"] for r in rows} == {r["source_file"] for r in raw_files(spark, f"{tmp_path}/support").collect()}
    assert "MapInPandas" in found._jdf.queryExecution().optimizedPlan().toString()


def test_every_file_can_be_read_whole(spark, tmp_path):
    folder = tmp_path / "support" / "2025-01-01" / "07"
    folder.mkdir(parents=True)
    for name, text in (("lines", f"{ONE}\n{THREE}"), ("list", f"[\n{ONE},\n{THREE}\n]"), ("pretty", PRETTY)):
        (folder / f"{name}.json").write_text(text)
    found = read_bronze(spark, f"{tmp_path}/support", "support", every_file=True)
    assert sorted(r["sid"] for r in found.collect()) == ["1", "1", "1", "3", "3"]
    # No file is read by lines: each is one text.
    texts = [t for t, _ in records.texts_of(
        lambda o: spark.read.format(o.get("format", "text")).options(**o).load(str(folder)), True, lambda t: t, every_file=True
    )]
    assert [t.count() for t in texts] == [3, 0]


def test_clean_texts_do_not_reach_the_scanner(spark):
    texts = spark.createDataFrame([(f"{ONE}\n{THREE}",), (f"[{ONE},{THREE}]",), (PRETTY,)], "value string")
    plan = texts.select(file_records())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    # The scanner's input is null for them: cutting by columns gives all there is.
    assert texts.select(F.size(file_records()).alias("n")).agg(F.sum("n")).first()[0] == 5
    assert spark.range(1).select(cut_records(F.lit(None).cast("string")).isNull()).first()[0]


def test_long_lines_take_time_in_proportion(spark):
    """A hundred thousand objects on a line, and as many after a broken one; by appending to arrays this took hours."""
    many = ",".join([TWO] * 100_000)
    texts = spark.createDataFrame([(many.replace(",{", "{"),), (f'[{{"sid": oops}},{many}]',)], "value string")
    found = texts.select(F.size(line_records()).alias("n")).collect()
    assert [r["n"] for r in found] == [100_000, 100_001]


def test_only_files_with_values_over_lines_are_read_whole(spark, tmp_path):
    folder = tmp_path / "support" / "2025-01-01" / "07"
    folder.mkdir(parents=True)
    by_line = {
        "lines": f"{ONE}\n\n{THREE}\r\n", "list": f"[\n{ONE},\n{THREE}\n]\n", "cut": f'{{"sid": "cut\n{ONE}\n{{"sid":"4",\n{ONE}{THREE}',
        "cut list": f'{{"sid": ["cu\n{ONE}',
        "cut after a value": f'{{"sid": "1"\n{ONE}',
    }
    whole = {"pretty": PRETTY, "goes on": '{"sid":\n{"a":1}}', "in array": '{"x":[\n{"a":1}]}', "item": '{"x":[{"y":1},\n{"a":1}]}'}
    for name, text in {**by_line, **whole}.items():
        (folder / f"{name}.json").write_text(text)
    found = read_bronze(spark, f"{tmp_path}/support", "support", keep_malformed=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"{name.replace(' ', '%20')}.json" in plan for name in whole)
    assert not any(f"{name.replace(' ', '%20')}.json" in plan for name in by_line)
    wanted = [r for text in [*by_line.values(), *whole.values()] for r in scanner()(text)]
    assert found.count() == len(wanted)
    assert sorted(r["malformed_text"] for r in found.filter("malformed_text is not null").collect()) == sorted(
        r for r in wanted if not isinstance(bare(r), dict)
    )
    assert found.filter("malformed_text is null").count() == sum(isinstance(bare(r), dict) for r in wanted)


def test_bronze_reads_every_layout(spark, tmp_path):
    for k, (text, _) in enumerate(LAYOUTS.values()):
        folder = tmp_path / "support" / "2025-01-01" / "07"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{k}.json").write_text(text)
    found = read_bronze(spark, f"{tmp_path}/support", "support", keep_malformed=True).collect()
    wanted = [bare(w) for _, records in LAYOUTS.values() for w in records]
    sids = sorted(r["sid"] for r in found if r["sid"])
    assert sids == sorted(w["sid"] for w in wanted if isinstance(w, dict))
    kept = sorted(r["malformed_text"].strip() for r in found if r["malformed_text"])
    assert kept == sorted(str(w) if not w is None else "null" for w in wanted if not isinstance(w, dict))
    assert raw_files(spark, f"{tmp_path}/support").count() == len(LAYOUTS) - 1  # not the empty one


def test_unknown_fields_are_rescued(spark):
    values = [
        '{"sid":"1","vendor":"v","billing_info":{"amount":1,"tax":{"rate":2}},"deep":{"a":[1]}}',
        '{"sid":"2","billing_info":{"amount":1}}',
        '{"sid":"3","billing_info":"free"}',
        "no json",
    ]
    texts = spark.createDataFrame([(v,) for v in values], "value string")
    rows = parsed(texts, line_records(), raw_schema("payment"), True, True).collect()
    assert [r[RESCUED] for r in rows] == [
        {"vendor": "v", "deep": '{"a":[1]}', "billing_info.tax": '{"rate":2}'}, None, {"billing_info": "free"}, None,
    ]
    assert rows[0]["billing_info"]["amount"] == "1" and rows[2]["sid"] == "3"


def test_unknown_fields_are_rescued_without_structs(spark):
    values = [
        '{"sid":"1","reason":{"code":[1]},"channel":null}', '{"sid":"2","vendor":{"a":1},"note":null}',
        "{'sid':'3','Sid':'x'}", '{"sid":"4"', "{}", '{"sid":"5","sid":"6"}',
    ]
    texts = spark.createDataFrame([(v,) for v in values], "value string")
    frame = parsed(texts, F.array("value"), raw_schema("support"), True, True)
    rows = frame.collect()
    assert [r[RESCUED] for r in rows] == [None, {"vendor": '{"a":1}', "note": None}, {"Sid": "x"}, None, None, None]
    assert rows[0]["reason"] == '{"code":[1]}' and rows[3]["malformed_text"] == values[3]
    # All fields' texts are read only of records with a name that the schema lacks.
    assert "jsonObjectKeys" in frame._jdf.queryExecution().optimizedPlan().toString()


def test_fields_texts_are_read_only_of_records_with_unknown_names(spark):
    values = [
        '{"sid":"1","billing_info":{"amount":1,"currency":"E"}}', '{"sid":"2","billing_info":null}', '{"sid":"3"}',
        '{"sid":"4","billing_info":{"amount":1,"tax":{"rate":2}}}', '{"sid":"5","billing_info":"free"}',
        '{"sid":"6","billing_info":[1]}', '{"sid":"7","billing_info":{"tax":1},"billing_info":{"amount":2}}',
        '{"sid":"8","vendor":null}', '{"sid":"9","billing_info":{}}', "no json", '{"sid":"10","billing_info":{"amount":',
        '{"sid":"11","billing_info":{"amount":{"a":1}}}',
    ]
    texts = spark.createDataFrame([(v,) for v in values], "value string")
    frame = parsed(texts, F.array("value"), raw_schema("payment"), True, True)
    assert [r[RESCUED] for r in frame.collect()] == [
        None, None, None, {"billing_info.tax": '{"rate":2}'}, {"billing_info": "free"}, {"billing_info": "[1]"},
        {"billing_info.tax": "1"}, {"vendor": None}, None, None, None, None,
    ]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "jsonObjectKeys" in plan
    assert [c for c in frame.columns if c.startswith("__")] == []


def test_a_line_is_judged_once(spark, tmp_path):
    folder = tmp_path / "support" / "2025-01-01" / "07"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"sid":"1"}\n{"sid":"2"}{"sid":"3"}\n\n no json\n [{"sid":"4"},{"sid":"5"}]\n {"sid":"6"}, \n')
    bronze = read_bronze(spark, f"{tmp_path}/support", "support", multi_line=False, keep_malformed=True)
    assert [c for c in bronze.columns if c.startswith("__")] == []
    plan = bronze._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(value#") == 1
    assert sorted((r["sid"] or "", r["malformed_text"] or "") for r in bronze.collect()) == [
        ("", "no json"), *[(str(k), "") for k in range(1, 7)],
    ]


def test_booleans_that_are_none_are_rejected_and_kept(spark, tmp_path, name):
    event = {
        "event_type": "support", "sid": "SU1", "customer": "c", "phone_number": "1", "channel": "app", "reason": "r",
        "wait_time_seconds": 5, "resolution_time_seconds": 9, "agent_id": "A", "satisfaction_score": 3,
        "timestamp": "2025-01-01 07:00:00", "status": "x", "escalated": True, "extra": 1,
    }
    folder = tmp_path / "bronze" / "support" / "2025-01-01" / "07"
    folder.mkdir(parents=True)
    others = [{**event, "sid": "SU2", "escalated": "maybe"}, {**event, "sid": "SU3", "escalated": None}, {**event, "sid": "SU4", "escalated": "FALSE"}]
    (folder / "a.json").write_text("\n".join(json.dumps(e) for e in [event, *others]))
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    layout = Layout(f"{tmp_path}/bronze", name, f"{tmp_path}/tables")
    run_silver(spark, layout, "r1", ["support"], on_error="raise")
    rows = {r["sid"]: r for r in spark.table(f"{name}.support").collect()}
    assert [rows[f"SU{k}"]["escalated"] for k in (1, 2, 3, 4)] == [True, None, None, False]
    assert [rows[f"SU{k}"]["is_rejected"] for k in (1, 2, 3, 4)] == [False, True, False, False]
    assert "escalated must be true or false" in rows["SU2"]["rejection_reason"]
    archived = spark.table(f"{name}.support_archive").filter("sid = 'SU2'").first()
    assert archived["escalated"] == "maybe" and archived[RESCUED]["extra"] == "1"
    assert RESCUED not in spark.table(f"{name}.support").columns


def test_boolean_names(spark):
    values = spark.createDataFrame([("true",), (" False ",), ("1",), ("yes",), ("",), (None,)], "v string")
    assert [r[0] for r in values.select(to_boolean(F.col("v"))).collect()] == [True, False, None, None, None, None]


def test_seeds_leave_malformed_records_out_and_keep_their_text(spark, tmp_path, name):
    file = tmp_path / "agent.json"
    file.write_text('[{"agent_id": "AG1"}, {"agent_id": oops}, {"agent_id": "AG2"}]{"agent_id": "AG3"}')
    assert sorted(r["agent_id"] for r in read_seed(spark, str(file), "agent").collect()) == ["AG1", "AG2", "AG3"]
    kept = read_seed(spark, str(file), "agent", keep_malformed=True).filter("malformed_text is not null")
    assert [r["malformed_text"] for r in kept.collect()] == ['{"agent_id": oops}']
    spark.sql(f"create database {name} location '{tmp_path}/tables'")
    load_seed_dims(spark, Layout("", name, f"{tmp_path}/tables"), {"agent": str(file)})
    assert spark.table(f"{name}.seed_agent").count() == 3
    assert spark.table(f"{name}.seed_agent_malformed").first()[0] == '{"agent_id": oops}'


@pytest.mark.parametrize("whole", [False, True])
def test_streams_lose_no_record(spark, tmp_path, whole):
    folder = tmp_path / "in" / "2025-01-01" / "07"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(f'{ONE}{THREE}\n{{"sid": "cut\n{TWO}\n')
    bronze = read_bronze_stream(spark, f"{tmp_path}/in", "support", multi_line=whole)
    stream_silver(bronze, "support", f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r["sid"] or "" for r in rows) == ["", "1", "2", "3"]
    assert [r["malformed_text"] for r in rows if r["sid"] is None] == ['{"sid": "cut']
