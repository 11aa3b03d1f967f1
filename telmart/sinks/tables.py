"""Catalog table writes: create or append, partition overwrite, idempotent publish."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from telmart.operators.dedup import first_row_per_key
from telmart.scratch import discard, scratch_path, shared_root

APPEND = "append"
OVERWRITE = "overwrite"


def balanced_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each partition's rows into few files.

    A rebalance, not a plain repartition: adaptive execution merges small pieces and
    splits a partition that holds far more rows than the others.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Replace touched partitions only, whatever the session's own setting.

    An insert by table name takes the mode from the session and not from the writer.
    """
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = APPEND,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    path: str | None = None,
    gather: bool = True,
) -> None:
    """Create the table when absent; else append, or replace the partitions present in ``df``.

    Columns are matched by name. Formats other than parquet, such as iceberg, go through
    the catalog's own ``writeTo``. ``gather=False`` saves the shuffle that gathers the
    rows of a partition, for rows that lie in one or few partitions anyway.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists:
        known = spark.table(name).columns
        extra = [c for c in df.columns if c not in known]
        if extra:
            raise ValueError(f"table {name} has no columns {extra}")
        df = df.select(*known)
    rows = balanced_for_write(df, partition_by) if gather else df
    if table_format != "parquet":
        writer = rows.writeTo(name)
        if not exists:
            writer = writer.using(table_format)
            (writer.partitionedBy(*map(F.col, partition_by)) if partition_by else writer).create()
        elif mode == OVERWRITE:
            writer.overwritePartitions()
        else:
            writer.append()
        return
    if not exists:
        creator = rows.write.format("parquet").mode("append")
        if partition_by:
            creator = creator.partitionBy(*partition_by)
        if path:
            creator = creator.option("path", path)
        creator.saveAsTable(name)
        return
    writer = rows.write
    if mode == OVERWRITE:
        with _dynamic_overwrite(spark):
            writer.insertInto(name, overwrite=True)
    else:
        writer.insertInto(name)
    spark.catalog.refreshTable(name)


def replace_table(df: DataFrame, name: str, table_format: str = "parquet") -> None:
    """Replace all rows of an unpartitioned table, also by rows computed from itself.

    The new rows are checkpointed to the shared folder first: the table is not read while
    it is rewritten, and a complete copy exists should the write break off.
    """
    shared_root(df.sparkSession)
    write_table(df.checkpoint(), name, OVERWRITE, (), table_format)


def replace_rows(df: DataFrame, name: str, partition: Mapping[str, str], table_format: str = "parquet") -> None:
    """Replace one partition by rows computed from it; it goes when there are none."""
    spark = df.sparkSession
    shared_root(spark)
    rows = df.checkpoint()
    if rows.isEmpty():
        terms = {c: str(v).replace("\\", "\\\\").replace("'", "\\'") for c, v in partition.items()}
        if table_format == "parquet":
            spec = ", ".join(f"`{c}` = '{v}'" for c, v in terms.items())
            spark.sql(f"alter table {name} drop if exists partition ({spec})")
        else:
            spark.sql(f"delete from {name} where " + " and ".join(f"`{c}` = '{v}'" for c, v in terms.items()))
        return
    write_table(rows, name, OVERWRITE, list(partition), table_format, gather=False)


def add_columns(df: DataFrame, name: str) -> None:
    """Give an existing table the columns of ``df`` that it lacks; older rows have nulls there."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return
    known = spark.table(name).columns
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in known]
    if new:
        spark.sql(f"alter table {name} add columns ({', '.join(new)})")


def write_by_quality(validated: DataFrame, path: str, mode: str = APPEND) -> None:
    """Valid and rejected rows in one pass, below quality=valid and quality=rejected."""
    side = F.when(F.col("is_rejected"), "rejected").otherwise("valid")
    rows = validated.withColumn("quality", side)
    rows.write.mode(mode).partitionBy("quality").parquet(path)


def touched_partitions(df: DataFrame, column: str) -> list:
    """Partition values a batch holds: one small value per folder that it will write to."""
    return [row[0] for row in df.select(column).distinct().collect()]


def _known_keys(existing: DataFrame, key: str) -> DataFrame:
    return existing.select(key).distinct()


def new_rows(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key ``existing`` does not hold yet, one per key.

    Known keys go first, so what is reduced to one row per key is only what is new.
    """
    unseen = df.join(_known_keys(existing, key), key, "left_anti").select(*df.columns)
    return first_row_per_key(unseen, [key])


@dataclass(frozen=True)
class PublishReport:
    """What became of a batch's rows; ``new`` + ``same`` + ``conflicting`` = ``rows``.

    ``same`` rows are copies of published ones; ``conflicting`` ones share the key of a
    published row and differ from it.
    """

    rows: int
    new: int
    same: int
    conflicting: int


def _digest(columns: Sequence[str]) -> Column:
    """A hash of a whole row; nulls of different columns differ."""
    shown = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*shown, *[c.isNull() for c in shown])


_DIGEST, _KNOWN, _LEAST, _MOST = "__digest", "__known", "__least", "__most"


def _unpublished(df: DataFrame, existing: DataFrame | None, key: str, path: str) -> tuple[DataFrame, int]:
    """Rows that the table does not hold, stored, with digest and whether their key is known; all rows' number.

    One shuffle by key. Of the table only keys and digests are shuffled.
    """
    digested = df.withColumn(_DIGEST, _digest(df.columns))
    counted = Observation()
    seen = digested.observe(counted, F.count(F.lit(1)).alias("rows"))
    if existing is None:
        pending = seen.withColumn(_KNOWN, F.lit(False))
    else:
        held = existing.select(key, _digest(df.columns).alias(_DIGEST)).groupBy(key).agg(
            F.min(_DIGEST).alias(_LEAST), F.max(_DIGEST).alias(_MOST)
        )
        joined = seen.join(held, key, "left")
        same = F.coalesce(F.col(_DIGEST).isin(F.col(_LEAST), F.col(_MOST)), F.lit(False))
        pending = joined.filter(~same).select(*df.columns, _DIGEST, F.col(_LEAST).isNotNull().alias(_KNOWN))
    pending.write.parquet(path)
    return df.sparkSession.read.schema(pending.schema).parquet(path), counted.get["rows"]


def _one_per_key(pending: DataFrame, key: str, repeats: bool) -> DataFrame:
    """The first row of each key; only keys that occur more than once (``repeats``: there are any) are sorted out."""
    if not repeats:
        return pending
    repeated = pending.groupBy(key).count().filter("count > 1").select(key)
    alone = pending.join(repeated, key, "left_anti").select(*pending.columns)
    return alone.unionByName(first_row_per_key(pending.join(repeated, key, "left_semi"), [key]))


def publish_new_rows(
    df: DataFrame,
    name: str,
    key: str,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    path: str | None = None,
) -> PublishReport:
    """Append only unseen keys, so publishing a batch again changes nothing.

    Keys must determine the partition (fact keys do: they hash the event's timestamp), so
    only the table partitions that the batch touches are scanned for them. A row whose key
    is published with other content, or comes with other content in the same batch after the
    first such row, is not lost: it goes to ``<name>_conflicts``, once.
    """
    spark = df.sparkSession
    touched = touched_partitions(df, partition_by[0]) if partition_by else None
    existing = None
    if spark.catalog.tableExists(name):
        existing = spark.table(name)
        if touched is not None:
            column = F.col(partition_by[0])
            named = column.isin([v for v in touched if v is not None])
            existing = existing.filter(named | column.isNull() if None in touched else named)
    stored = scratch_path(spark, "pending")
    pending, rows = _unpublished(df, existing, key, stored)
    unseen = pending.filter(f"not {_KNOWN}")
    # One shuffle, of hashes of the keys reduced in the tasks: how many rows and, nearly always, keys there are.
    tally = pending.groupBy(F.xxhash64(key).alias("hash"), _KNOWN).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pending"),
        F.coalesce(F.sum(F.when(F.col(_KNOWN), F.col("n"))), F.lit(0)).alias("known"),
        F.count(F.when(~F.col(_KNOWN), 1)).alias("new"),
    ).first().asDict()
    repeats = tally["pending"] - tally["known"] > tally["new"]
    if repeats:  # equal hashes may be of different keys
        tally["new"] = unseen.select(key).distinct().count()
        repeats = tally["pending"] - tally["known"] > tally["new"]
    chosen = _one_per_key(unseen, key, repeats)
    gather = touched is None or len(touched) > 1
    if tally["new"] or not spark.catalog.tableExists(name):
        write_table(chosen.select(*df.columns), name, APPEND, partition_by, table_format, path, gather)
    # Copies of a row in one batch have its digest and are no conflict.
    picks = chosen.select(F.col(key), F.col(_DIGEST).alias("__pick"))
    differing = pending.limit(0)
    if repeats:
        # Null-safe, as a null key is a key like any other here.
        same_key = unseen[key].eqNullSafe(picks[key])
        differing = unseen.join(picks, same_key & (F.col(_DIGEST) != F.col("__pick")), "left_semi")
    conflicts = pending.filter(_KNOWN).unionByName(differing) if tally["pending"] > tally["new"] else differing
    conflicting = conflicts.count() if tally["pending"] > tally["new"] else 0
    if conflicting:
        _quarantine(conflicts.select(*df.columns, _DIGEST), f"{name}_conflicts", key, table_format, path)
    discard(spark, stored)
    return PublishReport(rows, tally["new"], rows - tally["new"] - conflicting, conflicting)


def _quarantine(conflicts: DataFrame, name: str, key: str, table_format: str, path: str | None) -> None:
    """Keep conflicting rows, each of them once however often it is published."""
    columns = [c for c in conflicts.columns if c != _DIGEST]
    rows = conflicts.dropDuplicates([key, _DIGEST])
    if conflicts.sparkSession.catalog.tableExists(name):
        held = conflicts.sparkSession.table(name).select(key, _digest(columns).alias(_DIGEST))
        rows = rows.join(held, [key, _DIGEST], "left_anti")
    write_table(rows.select(*columns), name, APPEND, (), table_format, f"{path}_conflicts" if path else None)
