from __future__ import annotations

import pytest

from telmart.operators import shape
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def nested(spark):
    return spark.sql(
        "select 1 as id, named_struct('a', 1, 'b', 'x') as `from`, named_struct('amount', 2.5) as bill"
    )


def test_flatten(nested):
    flat = shape.flatten_structs(nested, {"from": "from", "bill": "", "id": "p", "none": ""})
    assert flat.columns == ["id", "from_a", "from_b", "amount"]
    assert flat.count() == 1
    again = shape.flatten_structs(flat, {"from": "from", "bill": ""})
    assert again.columns == flat.columns


def test_null_struct_gives_null_fields(spark):
    df = spark.sql("select cast(null as struct<a: int>) as s")
    assert rows_of(shape.flatten_structs(df, {"s": "s"})) == [(None,)]


def test_field_with_the_name_of_its_struct(spark):
    df = spark.sql("select named_struct('x', 1, 'y', 2) as x")
    assert rows_of(shape.flatten_structs(df, {"x": ""}).select("x", "y")) == [(1, 2)]


def test_conflicts(spark):
    df = spark.sql("select 'old' as a, named_struct('a', 'new') as s")
    with pytest.raises(ValueError):
        shape.flatten_structs(df, {"s": ""})
    assert rows_of(shape.flatten_structs(df, {"s": ""}, shape.OVERWRITE)) == [("new",)]


def test_nested_pruning_reaches_the_scan(spark, nested, tmp_path):
    nested.write.parquet(str(tmp_path / "n"))
    flat = shape.flatten_structs(spark.read.parquet(str(tmp_path / "n")), {"from": "from"})
    plan = flat.select("from_a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<from:struct<a:int>>" in plan


def test_accept_filter_is_pushed_down(spark, tmp_path):
    df = spark.sql("select id, cast(null as boolean) as is_rejected from range(3)")
    df.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = shape.accepted(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualNullSafe(is_rejected,false),IsNull(is_rejected))]" in plan


def test_project_with_defaults(spark):
    df = spark.createDataFrame([("7", None), ("abc", "x")], "n string, s string")
    specs = [
        shape.Projected("number", "n", "bigint", 0), shape.Projected("text", "s", "string", ""),
        shape.Projected("raw", "s"), shape.Projected("absent", "zzz", "double", 1.0),
        shape.Projected("absent_null", "zzz", "boolean"),
    ]
    found = shape.project_with_defaults(df, specs)
    assert rows_of(found) == [(0, "x", "x", 1.0, None), (7, "", None, 1.0, None)]
    assert dict(found.dtypes)["absent_null"] == "boolean"


def test_publish_shaping(spark):
    df = spark.sql(
        """select cast(null as string) as s, cast(null as boolean) as b, cast(null as bigint) as l,
           cast(null as decimal(5,2)) as d, cast(null as date) as day, array(1) as a,
           map('k', 1) as m, named_struct('x', 1) as st, false as is_rejected,
           cast(null as string) as rejection_reason"""
    )
    flat = shape.fill_nulls_by_type(shape.drop_complex_columns(shape.drop_quality_flags(df)))
    assert flat.columns == ["s", "b", "l", "d", "day"]
    row = flat.first()
    assert (row["s"], row["b"], row["l"], row["d"], row["day"]) == ("", False, 0, 0, None)
