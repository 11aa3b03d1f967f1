from __future__ import annotations

import pytest

from telmart.operators.scd import scd1_upsert, scd2_merge
from telmart.plans.jobs import Layout, merge_dim
from telmart.sinks.tables import write_table
from tests.conftest import rows_of

DIM = "id int, plan string, city string, effective_from string, effective_to string, is_current boolean"
END = "9999-12-31"


def dim(spark):
    return spark.createDataFrame(
        [
            (1, "A", "x", "2024-01-01", END, True),
            (2, "A", "x", "2024-01-01", END, True),
            (3, "A", "x", "2023-01-01", "2024-01-01", False),
            (3, "B", "x", "2024-01-01", END, True),
            (5, "A", "x", "2024-01-01", END, True),
        ],
        DIM,
    )


def changes(spark):
    return spark.createDataFrame(
        [
            (1, "B", "2025-01-01"), (1, "C", "2025-02-01"),  # two versions
            (2, "A", "2025-01-01"),  # nothing new
            (4, "N", "2025-01-01"),  # unseen
            (5, "Z", "2024-01-01"),  # correction of the open version
        ],
        "id int, plan string, effective_from string",
    )


def test_scd2(spark):
    merged = scd2_merge(dim(spark), changes(spark), ["id"], ["plan"])
    expected = [
        (1, "A", "x", "2024-01-01", "2025-01-01", False),
        (1, "B", "x", "2025-01-01", "2025-02-01", False),
        (1, "C", "x", "2025-02-01", END, True),
        (2, "A", "x", "2024-01-01", END, True),
        (3, "A", "x", "2023-01-01", "2024-01-01", False),
        (3, "B", "x", "2024-01-01", END, True),
        (4, "N", None, "2025-01-01", END, True),
        (5, "Z", "x", "2024-01-01", END, True),
    ]
    assert rows_of(merged) == expected
    again = scd2_merge(merged, changes(spark), ["id"], ["plan"])
    assert rows_of(again) == expected


def test_scd2_tracks_nulls(spark):
    nulls = spark.createDataFrame([(1, None, "2025-01-01")], "id int, plan string, effective_from string")
    merged = scd2_merge(dim(spark), nulls, ["id"], ["plan"])
    assert (1, None, "x", "2025-01-01", END, True) in rows_of(merged)


def merged_rows(spark, versions, *batches):
    frame = spark.createDataFrame(versions, DIM)
    for batch in batches:
        new = spark.createDataFrame(batch, "id int, plan string, effective_from string")
        frame = scd2_merge(frame, new, ["id"], ["plan"])
    return rows_of(frame.select("plan", "effective_from", "effective_to", "is_current"))


def test_old_batches_do_not_overwrite_later_versions(spark):
    first = [(1, "A", "x", "2024-01-01", END, True)]
    b, c = [(1, "B", "2024-03-01")], [(1, "C", "2024-06-01")]
    expected = [
        ("A", "2024-01-01", "2024-03-01", False), ("B", "2024-03-01", "2024-06-01", False),
        ("C", "2024-06-01", END, True),
    ]
    assert merged_rows(spark, first, b, c, b) == expected
    assert merged_rows(spark, first, c, b, c) == expected
    assert merged_rows(spark, first, [*c, *b]) == expected


def test_late_change_makes_the_next_one_redundant(spark):
    first = [(1, "A", "x", "2024-01-01", "2024-06-01", False), (1, "C", "x", "2024-06-01", END, True)]
    expected = [("A", "2024-01-01", "2024-03-01", False), ("C", "2024-03-01", END, True)]
    assert merged_rows(spark, first, [(1, "C", "2024-03-01")]) == expected


def test_null_start_counts_as_the_earliest_day(spark):
    first = [(1, "A", "x", None, END, True)]
    expected = [("A", None, "2024-03-01", False), ("B", "2024-03-01", END, True)]
    assert merged_rows(spark, first, [(1, "B", "2024-03-01")]) == expected
    assert merged_rows(spark, first, [(1, "Z", None)]) == [("Z", None, END, True)]


def test_closed_keys_stay_closed_until_a_later_change(spark):
    first = [(1, "A", "x", "2024-01-01", "2024-02-01", False)]
    assert merged_rows(spark, first, [(1, "A", "2024-01-15")]) == [("A", "2024-01-01", "2024-02-01", False)]
    assert merged_rows(spark, first, [(1, "B", "2024-05-01")]) == [
        ("A", "2024-01-01", "2024-02-01", False), ("B", "2024-05-01", END, True),
    ]
    assert merged_rows(spark, first, [(1, "A", "2024-05-01")]) == [
        ("A", "2024-01-01", "2024-02-01", False), ("A", "2024-05-01", END, True),
    ]


def test_a_dropped_version_leaves_no_gap(spark):
    first = [(1, "A", "x", "2024-01-01", END, True)]
    batches = [(1, "B", "2023-06-01")], [(1, "B", "2024-01-01")], [(1, "C", "2024-03-01")]
    assert merged_rows(spark, first, *batches) == [
        ("B", "2023-06-01", "2024-03-01", False), ("C", "2024-03-01", END, True),
    ]


def test_scd1(spark):
    old = dim(spark).filter("is_current").select("id", "plan", "city")
    new = spark.createDataFrame(
        [(1, "P", None, 1), (1, "Q", None, 2), (9, "R", "y", 1)],
        "id int, plan string, city string, seq int",
    )
    assert rows_of(scd1_upsert(old, new, ["id"], ["seq"])) == [
        (1, "Q", "x"), (2, "A", "x"), (3, "B", "x"), (5, "A", "x"), (9, "R", "y"),
    ]
    strict = scd1_upsert(old, new, ["id"], ["seq"], keep_old_when_null=False)
    assert (1, "Q", None) in rows_of(strict)


def test_stored_dimension_is_merged_in_place(spark, name):
    write_table(dim(spark), name)
    for _ in range(2):
        merge_dim(spark, Layout(), name, changes(spark), ["id"], ["plan"])
        stored = spark.table(name)
        assert stored.count() == 8 and stored.filter("is_current").count() == 5
    with pytest.raises(LookupError):
        merge_dim(spark, Layout(), f"{name}_x", changes(spark), ["id"], ["plan"])
