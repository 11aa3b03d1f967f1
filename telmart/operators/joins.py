"""Dimension lookups that stay balanced when keys are skewed.

A dimension is broadcast only once its size has been measured (or is fixed by
construction). A larger one is joined by a shuffle in which frequent keys are salted: a key
that holds a share of the rows gets that share of all salts, its fact rows are spread over
them and its dimension rows are repeated for each. All other keys, and the rest of the
dimension, shuffle as usual. So a hot key costs no more than its rows do, and which keys
count as frequent changes where rows are joined, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmart.functions.keys import KEY_NAMES
from telmart.operators.dedup import first_row_per_key

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A broadcast version list is searched row by row, so it must be short.
MAX_BROADCAST_VERSIONS = 64
# Keys that the sketch for frequent ones tracks at most; beyond that only the balance suffers.
MAX_TRACKED_KEYS = 100_000
SALTS_PER_PARTITION = 4
# A measured dimension whose share of a partition is at most this is hashed there, and facts are not sorted.
MAX_HASHED_BYTES = 16 * 1024 * 1024
# Columns that tell a fact's rows apart, cheapest first: an id costs less than the key hashed from it and more.
SPREADING = ("call_id", "sms_id", "payment_id", "recharge_id", "support_id", *KEY_NAMES)

_KEY = "__lookup_key"
_SALT = "__lookup_salt"
_SIDE_SALT = "__lookup_side_salt"
_FAN_KEY, _FAN = "__lookup_fan_key", "__lookup_fan"
_SPREAD = "__lookup_spread"


def _column_bytes(field: T.StructField) -> Column:
    """Bytes of one value: 16 for its slot, plus the content of variable-length types."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        content = F.octet_length(F.to_json(F.struct(column)))
    elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
        content = F.octet_length(column)
    else:
        return F.lit(16)
    return F.coalesce(content, F.lit(0)) + 16


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame: every row's slots and the exact bytes of its text and nested values."""
    row = reduce(lambda a, b: a + b, [_column_bytes(f) for f in df.schema.fields], F.lit(16))
    return int(df.agg(F.sum(row.cast("bigint")).alias("size")).first()["size"] or 0)


def _fits(side: DataFrame, max_bytes: int) -> bool:
    return max_bytes > 0 and measured_bytes(side) <= max_bytes


def _partitions(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or conf.get("spark.sql.shuffle.partitions"))


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float | None = None) -> dict[str, dict]:
    """Per column the non-null values that hold at least about ``share`` of the rows, and that share.

    By default half of a shuffle partition's fair share, below which a key cannot
    unbalance one. One pass of Spark's top-k sketch for all columns: its memory does not
    grow with the data, nothing but the sketches is shuffled, and each list has at most
    ``1 / share`` entries.
    """
    names = list(dict.fromkeys(keys))
    share = 1 / (2 * _partitions(df)) if share is None else share
    most = max(1, min(math.ceil(1 / share), MAX_TRACKED_KEYS // 10))
    sketches = [F.expr(f"approx_top_k(`{k}`, {most}, {10 * most})").alias(k) for k in names]
    found = df.agg(F.count(F.lit(1)).alias("__rows"), *sketches).first()
    rows = max(1, found["__rows"])
    return {
        k: {
            top["item"]: min(1.0, top["count"] / rows)
            for top in found[k]
            if top["item"] is not None and top["count"] >= share * rows
        }
        for k in names
    }


def _fan_out(df: DataFrame, key: str, frequent: Mapping[object, float]) -> DataFrame | None:
    """(key, number of salts) of the frequent keys: at most one small row per key found."""
    salts = SALTS_PER_PARTITION * _partitions(df)
    rows = [(item, max(2, math.ceil(held * salts))) for item, held in frequent.items()]
    if not rows:
        return None
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(_FAN_KEY, key_type), T.StructField(_FAN, T.IntegerType())])
    return df.sparkSession.createDataFrame(rows, schema)


def _row_hash(df: DataFrame, spread_by: Sequence[str] | None) -> Column:
    """A number that differs between rows, and is the same when a row is computed again.

    It hashes the row's own id or key where the frame has one, so that no other column has to
    be read, and else all columns; and the source partition, so copies of a row spread out.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)
    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]
    names = spread_by or [c for c in SPREADING if c in flat][:1] or flat
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in names])


def _salted(
    fact: DataFrame, key: str, fan: DataFrame | None, spread_by: Sequence[str] | None
) -> DataFrame:
    """Add the salt: of a frequent key's rows within its fan-out, of rows without key over all, else 0."""
    every = SALTS_PER_PARTITION * _partitions(fact)
    many = F.when(F.col(f"`{key}`").isNull(), F.lit(every))
    if fan is not None:
        fact = fact.join(F.broadcast(fan), F.col(f"`{key}`") == F.col(_FAN_KEY), "left")
        many = F.coalesce(many, F.col(_FAN))
    salt = F.when(many.isNotNull(), F.pmod(_row_hash(fact, spread_by), many).cast("int")).otherwise(0)
    return fact.withColumn(_SALT, salt).drop(_FAN_KEY, _FAN)


def _repeated(side: DataFrame, fan: DataFrame | None) -> DataFrame:
    """Dimension rows once per salt of their key."""
    if fan is None:
        return side.withColumn(_SIDE_SALT, F.lit(0))
    wide = side.join(F.broadcast(fan), F.col(_KEY) == F.col(_FAN_KEY), "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col(_FAN), F.lit(1)) - 1)
    return wide.withColumn(_SIDE_SALT, F.explode(salts)).drop(_FAN_KEY, _FAN)


def _attributes(dim: DataFrame, dim_key: str, columns: Sequence[str] | None, prefix: str):
    names = columns if columns is not None else [c for c in dim.columns if c != dim_key]
    return dim.filter(F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias(_KEY), *[F.col(c).alias(f"{prefix}{c}") for c in names]
    )


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    how: str = "left",
    condition: Column | None = None,
    fixed_size: bool = False,
    max_bytes: int = MAX_BROADCAST_BYTES,
    frequent: Mapping[object, float] | None = None,
    unique: bool = False,
    spread_by: Sequence[str] | None = None,
    side_bytes: int | None = None,
) -> DataFrame:
    """Add dimension columns (named ``<prefix><column>``) to a fact.

    Of several dimension rows with one key the first in the order of the columns asked for
    is taken, so every fact row stays one row (and its sums right); ``unique`` says that there
    is one anyway. ``condition`` lifts that, as it may tell such rows apart: it may further
    restrict matches, naming fact columns and prefixed dimension columns. ``fixed_size`` says
    that the dimension's size is bounded by construction (a calendar, the minutes of a day),
    so it needs no measuring. ``max_bytes=0`` rules a broadcast out. ``frequent`` gives the
    fact's frequent keys and their shares when the caller has looked for them already, and
    ``spread_by`` columns that tell rows apart, for frames without a key of their own.
    ``side_bytes`` is the dimension's size when the caller has measured it already.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup is a left or an inner join")
    side = _attributes(dim, dim_key, columns, prefix)
    if condition is None and not fixed_size and not unique:
        # One row per key, whatever the dimension holds: a lookup never multiplies facts.
        side = first_row_per_key(side, [_KEY])
    clash = set(side.columns) & set(fact.columns)
    if clash:
        raise ValueError(f"lookup would repeat columns {sorted(clash)}; give a prefix")
    on = F.col(fact_key) == F.col(_KEY)
    if condition is not None:
        on = on & condition
    if side_bytes is None and max_bytes > 0 and not fixed_size:
        side_bytes = measured_bytes(side)
    if fixed_size or (max_bytes > 0 and side_bytes <= max_bytes):
        return fact.join(F.broadcast(side), on, how).drop(_KEY)
    hot = frequent_keys(fact, [fact_key])[fact_key] if frequent is None else frequent
    fan = _fan_out(fact, fact_key, hot)
    on = on & (F.col(_SALT) == F.col(_SIDE_SALT))
    repeated = _repeated(side, fan)
    if side_bytes is not None and side_bytes <= MAX_HASHED_BYTES * _partitions(fact):
        repeated = repeated.hint("shuffle_hash")
    joined = _salted(fact, fact_key, fan, spread_by).join(repeated, on, how)
    return joined.drop(_KEY, _SALT, _SIDE_SALT)


def unmatched_keys(keyed: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows of ``keyed`` (one per key) that have no row in the dimension."""
    known = dim.select(F.col(dim_key).alias(_KEY)).filter(f"{_KEY} is not null").distinct()
    return keyed.join(known, F.col(key) == F.col(_KEY), "left_anti")


def with_date(fact: DataFrame, dim_date: DataFrame, columns=None, **options) -> DataFrame:
    return lookup_join(fact, dim_date, "date_sk", "date_sk", columns, "date_", **options)


def with_time(fact: DataFrame, dim_time: DataFrame, columns=None, **options) -> DataFrame:
    """dim_time always has 1440 rows; facts must carry minute-of-day keys."""
    options.setdefault("fixed_size", True)
    return lookup_join(fact, dim_time, "time_sk", "time_key", columns, "time_", **options)


def _lookup_roles(
    fact: DataFrame,
    dim: DataFrame,
    dim_key: str,
    columns: Sequence[str] | None,
    key_suffix: str,
    noun: str,
    fixed_size: bool = False,
    max_bytes: int = MAX_BROADCAST_BYTES,
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Look a dimension up once per role: from_ and to_, or the one key a fact has.

    The dimension is measured, frequent keys are looked for, and rows are hashed for their
    salts once for all roles. ``keys_from`` is a cheaper frame with the same keys to look in,
    such as the stored fact to which earlier lookups have been added.
    """
    roles = [(f"{r}_{key_suffix}", f"{r}_") for r in ("from", "to")]
    roles = [(k, p) for k, p in roles if k in fact.columns] or [(key_suffix, "")]
    names = columns if columns is not None else [c for c in dim.columns if c != dim_key]
    dim = first_row_per_key(dim.select(dim_key, *[c for c in names if c != dim_key]), [dim_key])
    size = None if fixed_size or not max_bytes else measured_bytes(_attributes(dim, dim_key, columns, ""))
    small = fixed_size or (size is not None and size <= max_bytes)
    keys = [k for k, _ in roles]
    hot = {} if small else frequent_keys(fact if keys_from is None else keys_from, keys)
    if not small:
        # One number travels through the shuffles instead of the columns it is made from.
        fact = fact.withColumn(_SPREAD, _row_hash(fact, spread_by))
    for key, prefix in roles:
        fact = lookup_join(
            fact, dim, key, dim_key, columns, f"{prefix}{noun}_",
            fixed_size=small, max_bytes=0, frequent=hot.get(key), unique=True,
            spread_by=[_SPREAD], side_bytes=size, **options,
        )
    return fact.drop(_SPREAD)


def with_users(fact: DataFrame, dim_user: DataFrame, columns=None, **options) -> DataFrame:
    """Current user attributes for the caller and the called party, or the one customer."""
    current = dim_user.filter("is_current")
    return _lookup_roles(
        fact, current, "phone_number", columns, "phone_number", "user", **options
    )


def with_devices(fact: DataFrame, dim_device: DataFrame, columns=None, **options) -> DataFrame:
    return _lookup_roles(fact, dim_device, "tac", columns, "tac", "device", **options)


def with_cell_sites(fact: DataFrame, dim_cell: DataFrame, columns=None, **options) -> DataFrame:
    return _lookup_roles(fact, dim_cell, "cell_id", columns, "cell_site", "cell", **options)


def with_agent(fact: DataFrame, dim_agent: DataFrame, columns=None, **options) -> DataFrame:
    return lookup_join(fact, dim_agent, "agent_id", "agent_id", columns, "agent_", **options)


def with_manufacturer(
    df: DataFrame, dim_device: DataFrame, tac: str = "tac", **options
) -> DataFrame:
    """Device brand by type allocation code, as ``manufacturer``."""
    brands = dim_device.select("tac", F.col("brand").alias("manufacturer"))
    return lookup_join(df, brands, tac, "tac", ["manufacturer"], "", **options)


def _as_moment(column: Column) -> Column:
    return column.try_cast("timestamp_ntz")


def as_of_join(
    fact: DataFrame,
    versions: DataFrame,
    fact_key: str,
    key: str,
    moment: str,
    columns: Sequence[str],
    prefix: str = "",
    since: str = "effective_from",
    until: str = "effective_to",
    max_bytes: int = MAX_BROADCAST_BYTES,
    frequent: Mapping[object, float] | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns of the version that holds at the fact's moment: since <= moment < until.

    A bound that is null is open. Versions of a key follow one another; should two overlap,
    the one that starts last counts (of equal starts the one that ends last), so a fact row stays one row.

    No fact row meets every version of its key. A small dimension with few versions a key is
    broadcast as one sorted list per key. Else versions and facts of a key go into one
    ordering by time, along which the last version is carried: one pass, whatever the
    number of versions. Frequent keys are salted, their versions repeated for every salt.
    """
    names = [f"{prefix}{c}" for c in columns]
    clash = set(names) & set(fact.columns)
    if clash:
        raise ValueError(f"lookup would repeat columns {sorted(clash)}; give a prefix")
    # Fields are in the order by which versions are sorted; null ends are the latest.
    version = F.struct(
        _as_moment(F.col(since)).alias("since"),
        _as_moment(F.col(until)).isNull().alias("open"),
        _as_moment(F.col(until)).alias("until"),
        F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)]).alias("row"),
    )
    side = versions.filter(F.col(key).isNotNull()).select(F.col(key).alias(_KEY), version.alias("__version"))
    at = F.col(moment).cast("timestamp_ntz")
    kept = [F.col(f"`{c}`") for c in fact.columns]

    def chosen(found: Column) -> list[Column]:
        ends = found.getField("until")
        holds = found.isNotNull() & (ends.isNull() | (at < ends))
        return [F.when(holds, found.getField("row").getField(n)).alias(n) for n in names]

    if _fits(side, max_bytes):
        lists = side.groupBy(_KEY).agg(F.sort_array(F.collect_list("__version")).alias("__versions"))
        longest = side.groupBy(_KEY).count().agg(F.max("count")).first()[0] or 0
        if longest <= MAX_BROADCAST_VERSIONS:
            started = F.filter("__versions", lambda v: v["since"].isNull() | (v["since"] <= at))
            wide = fact.join(F.broadcast(lists), F.col(f"`{fact_key}`") == F.col(_KEY), "left")
            found = wide.withColumn("__version", F.try_element_at(started, F.lit(-1)))
            return found.select(*kept, *chosen(F.col("__version")))

    hot = frequent_keys(fact, [fact_key])[fact_key] if frequent is None else frequent
    fan = _fan_out(fact, fact_key, hot)
    events = _salted(fact, fact_key, fan, spread_by).select(
        "*", F.col(f"`{fact_key}`").alias(_KEY), at.alias("__at"), F.lit(1).alias("__kind")
    )
    starts = _repeated(side, fan).select(
        _KEY, F.col(_SIDE_SALT).alias(_SALT), F.col("__version.since").alias("__at"), F.lit(0).alias("__kind"), "__version"
    )
    together = events.unionByName(starts, allowMissingColumns=True)
    in_time = Window.partitionBy(_KEY, _SALT).orderBy(
        F.col("__at").asc_nulls_first(), "__kind", F.col("__version.open"), F.col("__version.until")
    )
    carried = F.last("__version", ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    found = together.withColumn("__found", carried).filter("__kind = 1")
    return found.select(*kept, *chosen(F.col("__found")))


def with_user_as_of(
    fact: DataFrame,
    dim_user: DataFrame,
    fact_key: str = "phone_number",
    moment: str = "timestamp",
    columns: Sequence[str] = ("plan_type", "city"),
    prefix: str = "user_",
    **options,
) -> DataFrame:
    """User attributes valid at the fact's moment: effective_from <= moment < effective_to."""
    return as_of_join(fact, dim_user, fact_key, "phone_number", moment, columns, prefix, **options)
