"""User-level jobs. Each returns a status frame: one row per step."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmart.functions.keys import KEY_NAME, MINUTE_OF_DAY
from telmart.operators.aggregates import partial_measures
from telmart.operators.scd import scd2_merge
from telmart.plans.dims import (
    DIM_MODELS,
    build_device_seed,
    build_dim,
    build_dim_date,
    build_dim_time,
    build_user_seed,
)
from telmart.plans.facts import EVENT_DAY, FACT_MODELS, build_fact, with_event_day
from telmart.plans.silver import SILVER_MODELS, normalise, validate, with_partition_day
from telmart.schemas import EVENT_TYPES
from telmart.sinks.archive import (
    archive_files,
    archive_snapshot,
    archived_location,
    purge_bronze,
    run_manifest,
)
from telmart.sinks.jdbc import SILVER_TARGETS, append_jdbc, publish_jdbc, publishable, published_jdbc
from telmart.sinks.tables import OVERWRITE, publish_new_rows, replace_table, write_table
from telmart.sinks.versioned import (
    BUCKETS,
    is_versioned,
    merge_versioned,
    replace_versioned,
    rows_table,
)
from telmart.sources.bronze import raw_files, read_bronze
from telmart.sources.records import MALFORMED, RESCUED
from telmart.sources.seeds import read_seed
from telmart.sources.tables import read_table

log = logging.getLogger(__name__)

CONTINUE = "continue"
RAISE = "raise"

STATUS_DDL = "step string, status string, error string"


@dataclass(frozen=True)
class Layout:
    """Where a lakehouse keeps its layers.

    ``database`` prefixes table names ('' for none); ``table_root``, when given, is the
    folder below which new tables are stored, else the catalog's warehouse decides.
    Facts are partitioned by ``event_day``, the day of their moment beside the hashed date key,
    so a run touches the partitions of its own days only and filters on days and ranges
    of days prune; empty ``fact_partitions`` leaves them whole.
    """

    bronze_root: str = ""
    database: str = ""
    table_root: str | None = None
    table_format: str = "parquet"
    fact_partitions: tuple[str, ...] = (EVENT_DAY,)
    raw_archive: str = ""

    def raw_archive_root(self) -> str:
        """Where raw files are copied before a purge; beside the landing root by default."""
        return self.raw_archive or f"{self.bronze_root.rstrip('/')}_archive"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def path(self, name: str) -> str | None:
        return f"{self.table_root.rstrip('/')}/{name}" if self.table_root else None


def run_steps(
    spark: SparkSession, steps: Mapping[str, Callable[[], None]], on_error: str
) -> DataFrame:
    """Run steps in order; a failed one is recorded ('continue') or ends the job ('raise')."""
    if on_error not in (CONTINUE, RAISE):
        raise ValueError("on_error is 'continue' or 'raise'")
    outcome = []
    for name, step in steps.items():
        try:
            step()
            outcome.append((name, "ok", None))
        except Exception as error:
            log.error("%s failed: %s", name, error)
            if on_error == RAISE:
                raise
            outcome.append((name, "failed", str(error)))
    return spark.createDataFrame(outcome, STATUS_DDL)


def bronze_to_silver(
    spark: SparkSession,
    layout: Layout,
    event_type: str,
    run_id: str,
    dates: Sequence[str] | None = None,
    hours: Sequence[str] | None = None,
    multi_line: bool = True,
    purge: bool = False,
    gather: bool = False,
) -> None:
    """One run of one event type.

    Raw files that no run has taken in yet are read once, into the run's archive partition,
    with the text of records that are no JSON and all fields the schema does not know; silver rows and the manifest both come from
    there. A run that is repeated takes in what landed meanwhile and derives all of its
    silver rows anew, so it neither loses nor repeats events, and an event is in one run
    only. ``purge`` copies the run's raw files below ``layout.raw_archive`` before it
    deletes them. Rows are not shuffled; a run over many landing days (a backfill) should
    ``gather`` its silver rows by day, which keeps the number of files down.
    """
    model = SILVER_MODELS[event_type]
    root = f"{layout.bronze_root.rstrip('/')}/{event_type}"
    # Listed before the scan lists them: a file that lands in between waits for the next run.
    files = raw_files(spark, root, dates, hours)
    bronze = read_bronze(
        spark, root, event_type, dates, hours, multi_line, keep_malformed=True, keep_rescued=True
    )
    archive = f"{model.table}_archive"
    snapshot = archive_snapshot(
        normalise(bronze, event_type), layout.table(archive), run_id,
        layout.path(archive), layout.table_format, files,
    )
    silver = with_partition_day(validate(snapshot.drop(MALFORMED, RESCUED, "source_modified"), event_type))
    write_table(
        silver, layout.table(model.table), OVERWRITE, ["landing_day", "run_id"],
        layout.table_format, layout.path(model.table), gather,
    )
    if purge:
        files = run_manifest(snapshot)
        archive_files(archived_location(files, layout.raw_archive_root(), event_type, run_id[:8]))
        purge_bronze(files)


def run_silver(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    event_types: Sequence[str] = EVENT_TYPES,
    on_error: str = CONTINUE,
    **options,
) -> DataFrame:
    """All event types, by default going on after a failed one."""
    return run_steps(
        spark,
        {t: lambda t=t: bronze_to_silver(spark, layout, t, run_id, **options) for t in event_types},
        on_error,
    )


def _silver_rows(
    spark: SparkSession, layout: Layout, table: str, run_ids: Sequence[str] | None
) -> DataFrame:
    silver = read_table(spark, layout.table(table))
    if silver is None:
        raise LookupError(f"silver table {table} is missing")
    return silver if run_ids is None else silver.filter(F.col("run_id").isin(list(run_ids)))


def load_seed_dims(
    spark: SparkSession,
    layout: Layout,
    paths: Mapping[str, str],
    on_error: str = RAISE,
    multi_line: bool = True,
) -> DataFrame:
    """Store seed files as ``seed_<name>`` tables; ``paths`` maps seed name to file.

    A seed is a full snapshot: loading it again replaces the table's rows. The texts of
    records that are no JSON go to ``seed_<name>_malformed``.
    """

    def save(rows: DataFrame, table: str) -> None:
        write_table(rows, layout.table(table), OVERWRITE, (), layout.table_format, layout.path(table))

    def load(name: str) -> None:
        rows = read_seed(spark, paths[name], name, multi_line, keep_malformed=True)
        save(rows.filter(F.col(MALFORMED).isNull()).drop(MALFORMED), f"seed_{name}")
        save(rows.filter(F.col(MALFORMED).isNotNull()).select(MALFORMED), f"seed_{name}_malformed")

    return run_steps(spark, {f"seed_{n}": lambda n=n: load(n) for n in paths}, on_error)


def load_masters(
    spark: SparkSession,
    layout: Layout,
    paths: Mapping[str, str],
    on_error: str = RAISE,
    multi_line: bool = True,
) -> DataFrame:
    """Build the user and device seeds from their masters; ``paths`` maps 'user', 'device' to files.

    The seed tables are replaced, as ``load_seed_dims`` replaces them.
    """
    builders = {"user": build_user_seed, "device": build_device_seed}
    unknown = [n for n in paths if n not in builders]
    if unknown:
        raise ValueError(f"there is no master for {unknown}; there are {sorted(builders)}")

    def load(name: str) -> None:
        table = f"seed_{name}"
        rows = builders[name](read_seed(spark, paths[name], f"raw_{name}", multi_line))
        write_table(rows, layout.table(table), OVERWRITE, (), layout.table_format, layout.path(table))

    return run_steps(spark, {f"seed_{n}": lambda n=n: load(n) for n in paths}, on_error)


def purge_runs(
    spark: SparkSession,
    layout: Layout,
    run_ids: Sequence[str],
    event_types: Sequence[str] = EVENT_TYPES,
    dates: Sequence[str] | None = None,
    hours: Sequence[str] | None = None,
    on_error: str = RAISE,
) -> DataFrame:
    """Archive and delete the raw files that some runs have stored, optionally of some days and hours only.

    Only the archive partitions of those runs are read; files of other runs, and files written
    anew since, stay.
    """

    def purge(event_type: str) -> None:
        table = f"{SILVER_MODELS[event_type].table}_archive"
        rows = read_table(spark, layout.table(table))
        if rows is None:
            raise LookupError(f"archive {table} is missing")
        files = run_manifest(rows.filter(F.col("run_id").isin(list(run_ids))))
        if dates:
            files = files.filter(F.col("event_date").isin(list(dates)))
        if hours:
            files = files.filter(F.col("event_hour").isin(list(hours)))
        archive_files(archived_location(files, layout.raw_archive_root(), event_type, min(run_ids)[:8]))
        purge_bronze(files)

    return run_steps(spark, {t: lambda t=t: purge(t) for t in event_types}, on_error)


def build_dims(
    spark: SparkSession,
    layout: Layout,
    dates: tuple[str, str] = ("2025-01-01", "2025-12-31"),
    extended: bool = False,
    unknown_member: bool = False,
    on_error: str = RAISE,
) -> DataFrame:
    """The six gold dimensions; each build replaces the previous one."""

    def save(df: DataFrame, table: str) -> None:
        if is_versioned(spark, layout.table(table)):
            raise ValueError(f"{table} is kept in buckets; merge changes into it instead")
        write_table(
            df, layout.table(table), OVERWRITE, (), layout.table_format, layout.path(table)
        )

    def from_seed(name: str) -> None:
        seed = read_table(spark, layout.table(f"seed_{name}"))
        if seed is None:
            raise LookupError(f"seed table for {name} is missing")
        save(build_dim(seed, name), DIM_MODELS[name].table)

    steps = {DIM_MODELS[n].table: lambda n=n: from_seed(n) for n in DIM_MODELS}
    steps["dim_date"] = lambda: save(
        build_dim_date(spark, *dates, extended, unknown_member), "dim_date"
    )
    steps["dim_time"] = lambda: save(build_dim_time(spark, extended), "dim_time")
    return run_steps(spark, steps, on_error)


def store_bucketed_dim(
    layout: Layout, table: str, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Store a dimension in buckets by key, so that merges write only those they touch.

    Storing it again replaces all rows; readers see the old or the new ones.
    """
    path = layout.path(rows_table(table))
    replace_versioned(rows, layout.table(table), keys, buckets, path, layout.table_format)


def merge_dim(
    spark: SparkSession,
    layout: Layout,
    table: str,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    order_by: Sequence[str] = (),
) -> None:
    """Merge changes into a stored dimension as new versions (SCD type 2).

    Of a bucketed dimension only the buckets that the changes touch are read and written,
    and readers switch to the new rows in one step; a plain table is rewritten whole.
    """
    name = layout.table(table)
    stored = read_table(spark, name)
    if stored is None:
        raise LookupError(f"dimension {table} is missing")

    def merge(rows: DataFrame, new: DataFrame) -> DataFrame:
        return scd2_merge(rows, new, keys, tracked, order_by=order_by)

    if is_versioned(spark, name):
        merge_versioned(changes, name, keys, merge, layout.path(rows_table(table)), layout.table_format)
    else:
        replace_table(merge(stored, changes), name, layout.table_format)


def update_measures(
    spark: SparkSession,
    layout: Layout,
    fact: str,
    table: str,
    group_by: Sequence[str],
    sums: Sequence[str] = (),
    averages: Sequence[str] = (),
    days: Sequence | None = None,
) -> None:
    """Bring stored sums and counts of a fact up to date with the days that have changed.

    ``table`` holds ``partial_measures`` by event day and ``group_by``, a partition a day.
    Only the fact's partitions of ``days`` are read and only those of ``table`` replaced, so
    a day that is done again counts once; ``merged_measures`` of the table then equals the
    measures of the whole fact. Without ``days`` all of the fact is done.
    """
    rows = read_table(spark, layout.table(fact))
    if rows is None:
        raise LookupError(f"fact {fact} is missing")
    if days is not None:
        rows = rows.filter(F.col(EVENT_DAY).isin(list(days)))
    keys = list(dict.fromkeys([*group_by, EVENT_DAY]))
    write_table(
        partial_measures(rows, keys, sums, averages), layout.table(table), OVERWRITE, [EVENT_DAY],
        layout.table_format, layout.path(table),
    )


def build_facts(
    spark: SparkSession,
    layout: Layout,
    names: Sequence[str] | None = None,
    on_error: str = RAISE,
    time_mode: str = MINUTE_OF_DAY,
    key_name: str = KEY_NAME,
    jdbc: Mapping[str, str] | None = None,
    run_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Publish some or all facts, idempotently, to gold tables or a JDBC warehouse.

    ``run_ids`` limits the work to the silver partitions of those runs, as an hourly job
    should; without it all of silver is read and only what is missing is added.
    """
    chosen = list(FACT_MODELS) if names is None else [n.lower() for n in names]
    unknown = [n for n in chosen if n not in FACT_MODELS]
    if unknown:
        raise ValueError(f"unknown facts {unknown}; there are {sorted(FACT_MODELS)}")

    def load(name: str) -> None:
        model = FACT_MODELS[name]
        silver = _silver_rows(spark, layout, model.source, run_ids)
        fact = build_fact(silver, name, time_mode, key_name)
        if jdbc is not None:
            publish_jdbc(fact, model.table, jdbc, key_name, "date_sk")
            return
        if EVENT_DAY in layout.fact_partitions:
            fact = with_event_day(fact)
        report = publish_new_rows(
            fact, layout.table(model.table), key_name, layout.fact_partitions,
            layout.table_format, layout.path(model.table),
        )
        log.info("%s: %s", model.table, report)
        if report.conflicting:
            log.warning("%s: %d conflicting rows set apart", model.table, report.conflicting)

    return run_steps(spark, {FACT_MODELS[n].table: lambda n=n: load(n) for n in chosen}, on_error)


PUBLISH_LOG = "publish_log"
BEGUN, DONE = "begun", "done"


def _publish_state(spark: SparkSession, layout: Layout, target: str, run_id: str) -> str | None:
    """How far a run's copy to a target got; reads the partition of this run only."""
    log_table = read_table(spark, layout.table(PUBLISH_LOG))
    if log_table is None:
        return None
    states = log_table.filter((F.col("run_id") == run_id) & (F.col("target") == target)).select("state").collect()
    found = {row["state"] for row in states}
    return DONE if DONE in found else BEGUN if found else None


def _log_publish(spark: SparkSession, layout: Layout, target: str, run_id: str, state: str) -> None:
    rows = spark.createDataFrame([(state, run_id, target)], "state string, run_id string, target string")
    write_table(
        rows, layout.table(PUBLISH_LOG), partition_by=["run_id", "target"],
        path=layout.path(PUBLISH_LOG), gather=False,
    )


def publish_silver(
    spark: SparkSession,
    layout: Layout,
    jdbc: Mapping[str, str],
    targets: Mapping[str, str] = SILVER_TARGETS,
    on_error: str = RAISE,
    append: Callable[[DataFrame, str, Mapping[str, str]], None] = append_jdbc,
    run_ids: Sequence[str] | None = None,
    published: Callable[[SparkSession, str, Mapping[str, str], str], DataFrame] = published_jdbc,
) -> DataFrame:
    """Copy the accepted rows of the silver tables, or of some runs, to the warehouse, each run once.

    A log by run and target says which copies have begun and which are done. A run that is
    done is left out. One that has begun and broke off may be there in part, as a warehouse
    takes an append in pieces: its rows are fetched back and only those that are missing are
    appended, copies counted one by one.
    """

    def copy(source: str, target: str) -> None:
        silver = _silver_rows(spark, layout, source, run_ids)
        for row in silver.select("run_id").distinct().orderBy("run_id").collect():
            copy_run(silver.filter(F.col("run_id") == row["run_id"]), target, row["run_id"])

    def copy_run(silver: DataFrame, target: str, run_id: str) -> None:
        state = _publish_state(spark, layout, target, run_id)
        if state == DONE:
            return
        rows = publishable(silver)
        if state == BEGUN:
            there = published(spark, target, jdbc, run_id)
            rows = rows.exceptAll(there.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields]))
        else:
            _log_publish(spark, layout, target, run_id, BEGUN)
        append(rows, target, jdbc)
        _log_publish(spark, layout, target, run_id, DONE)

    return run_steps(
        spark, {t: lambda s=s, t=t: copy(s, t) for s, t in targets.items()}, on_error
    )
