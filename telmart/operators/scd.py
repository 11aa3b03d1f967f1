"""Slowly changing dimension merges (no MERGE INTO needed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telmart.operators.dedup import last_row_per_key

OPEN_END = "9999-12-31"


def _both_sides(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the keys; each side is one struct, null where it has no row."""
    left = old.select(*keys, F.struct(*old.columns).alias("__old"))
    right = new.select(*keys, F.struct(*new.columns).alias("__new"))
    return left.join(right, list(keys), "full_outer")


def scd1_upsert(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    changed_at: Sequence[str],
    keep_old_when_null: bool = True,
) -> DataFrame:
    """Overwrite attributes in place and add new keys.

    Of several changes to one key the latest by ``changed_at`` counts. Both join sides then hold one row
    per key, so no key can be hot in the join. Columns the changes lack stay as they are.
    """
    given = [c for c in dim.columns if c in changes.columns]
    candidates = changes.select(*dict.fromkeys([*given, *changed_at]))
    latest = last_row_per_key(candidates, keys, changed_at)
    both = _both_sides(dim, latest.select(*given), keys)

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old = F.col("__old").getField(name)
        if name not in given:
            return old.alias(name)
        new = F.col("__new").getField(name)
        if keep_old_when_null:
            return F.coalesce(new, old).alias(name)
        return F.when(F.col("__new").isNull(), old).otherwise(new).alias(name)

    return both.select(*[value(c) for c in dim.columns])


def scd2_merge(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str = "effective_from",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Insert changes into the version chains of their keys.

    ``dim`` carries effective_from, effective_to and is_current. ``changes`` carries the
    keys, the tracked attributes, optionally other attributes, and the day ``effective``
    from which they hold; a batch may bring any number of changes per key, in any order.
    Of several changes of one key and day the latest counts (``order_by`` orders them).

    Stored versions and changes of a touched key form one chain in order of their days:

    * a change on the day a version starts corrects that version;
    * a change between two days slots into history: the version before it ends on its
      day, and it ends where the next one starts;
    * a state with the same tracked attributes as the one before it is no version;
    * the last version is open, unless it is a stored one that was closed already;
    * a start that is null counts as the earliest day.

    So running a batch again, however old, changes nothing. Attributes the changes lack are
    those of the stored version before them (or else the first one after). Versions of
    other keys stay as they are. One shuffle by key; changes are reduced to one a key and
    day first, so a chain has at most as many rows as there are days.
    """
    start_type, end_type = dim.schema["effective_from"].dataType, dim.schema["effective_to"].dataType
    attributes = [c for c in dim.columns if c not in (*keys, "effective_from", "effective_to", "is_current")]
    given = [c for c in attributes if c in changes.columns]
    ordered = changes.select(*dict.fromkeys([*keys, *given, effective, *order_by]))
    daily = last_row_per_key(ordered, [*keys, effective], order_by)
    new = daily.select(
        *[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in keys],
        *[
            (F.col(c) if c in given else F.lit(None)).cast(dim.schema[c].dataType).alias(c)
            for c in attributes
        ],
        F.col(effective).cast(start_type).alias("effective_from"),
        F.lit(OPEN_END).cast(end_type).alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(True).alias("__new"),
    )
    rows = dim.withColumn("__new", F.lit(False)).unionByName(new)
    chain = W.partitionBy(*keys).orderBy(F.col("effective_from").asc_nulls_first(), "__new")
    whole = chain.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # What comes after a row, read backwards: a frame that grows by a row needs one pass, one
    # to the end of the chain would be gone through again for every row.
    back = W.partitionBy(*keys).orderBy(F.col("effective_from").desc_nulls_last(), F.desc("__new"))
    after, later = back.rowsBetween(W.unboundedPreceding, 0), back.rowsBetween(W.unboundedPreceding, -1)
    stored = F.when(~F.col("__new"), F.struct(*attributes))
    nearest = F.coalesce(
        F.last(stored, ignorenulls=True).over(chain), F.last(stored, ignorenulls=True).over(after)
    )
    # A stored end counts where a gap follows; else it is just the next version's start.
    next_stored = F.last(F.when(~F.col("__new"), F.struct("effective_from")), ignorenulls=True).over(later)
    open_end = F.lit(OPEN_END).cast(end_type)
    gap = F.coalesce(F.col("effective_to") < next_stored.getField("effective_from"), F.lit(False))
    ended = next_stored.isNull() & ~F.coalesce("is_current", F.lit(False))
    rows = rows.withColumns({
        "__until": F.when(gap | ended, F.coalesce("effective_to", open_end)).otherwise(open_end),
        "__touched": F.max("__new").over(whole),
        "__nearest": nearest,
        "__replaced": F.coalesce(
            F.lead(F.struct("effective_from")).over(chain) == F.struct("effective_from"), F.lit(False)
        ),
    }).filter("not __touched or not __replaced")
    carried = {
        c: F.when(F.col("__new"), F.col("__nearest").getField(c)).otherwise(F.col(c))
        for c in attributes
        if c not in given
    }
    rows = rows.withColumns(carried)
    before = F.lag(F.struct("__until", F.struct(*tracked).alias("state"))).over(chain)
    same = before.getField("state").eqNullSafe(F.struct(*tracked)) & before.isNotNull()
    unbroken = before.getField("__until") >= F.coalesce(F.col("effective_from").cast(end_type), open_end)
    rows = rows.withColumn("__same", F.coalesce(same & unbroken, F.lit(False))).filter(
        "not __touched or not __same"
    )
    following = F.lead(F.struct("effective_from")).over(chain)
    end = F.least("__until", following.getField("effective_from").cast(end_type))
    return rows.withColumns({
        "__end": F.when(F.col("__touched"), end).otherwise(F.col("effective_to")),
        "__current": F.when(
            F.col("__touched"), following.isNull() & (F.col("__until") == open_end)
        ).otherwise(F.col("is_current")),
    }).select(
        *[
            {"effective_to": F.col("__end"), "is_current": F.col("__current")}
            .get(c, F.col(c)).cast(dim.schema[c].dataType).alias(c)
            for c in dim.columns
        ]
    )
