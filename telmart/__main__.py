"""Command line of the jobs, for spark-submit or ``python -m telmart``.

    silver  --bronze ROOT --run-id ID [event types]
    seeds   agent=FILE user=FILE ...
    masters user=FILE device=FILE
    dims    [--from DAY --to DAY]
    facts   [calls payment ...] [--runs ID ...]
    publish [--runs ID ...]
    merge   TABLE CHANGES --keys COLUMN ... --tracked COLUMN ... [--order COLUMN ...]
    purge   [event types] --runs ID ... [--dates DAY ...] [--hours HH ...]
    counts  TABLE ...
    profile TABLE ...
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from telmart.operators.aggregates import load_counts
from telmart.operators.quality import profile_tables
from telmart.plans import jobs
from telmart.schemas import EVENT_TYPES
from telmart.session import get_spark
from telmart.sinks.jdbc import jdbc_options_from_env
from telmart.sources.tables import read_table


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="telmart")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("names", nargs="*")
    parser.add_argument("--bronze", default="", help="root of the raw event folders")
    parser.add_argument("--database", default="")
    parser.add_argument("--table-root", default=None)
    parser.add_argument("--format", default="parquet", dest="table_format")
    parser.add_argument("--run-id", default=datetime.now(timezone.utc).strftime("%Y%m%d%H"))
    parser.add_argument("--runs", nargs="*", default=None, help="only the silver rows of these runs")
    parser.add_argument("--dates", nargs="*", default=None)
    parser.add_argument("--hours", nargs="*", default=None)
    parser.add_argument("--json-lines", action="store_true", help="raw files hold JSON lines")
    parser.add_argument("--purge", action="store_true", help="delete raw files once stored")
    parser.add_argument("--gather", action="store_true", help="few files per day (backfills)")
    parser.add_argument("--from", default="2025-01-01", dest="first_day")
    parser.add_argument("--to", default="2025-12-31", dest="last_day")
    parser.add_argument("--keys", nargs="*", default=[], help="key columns of a merged dimension")
    parser.add_argument("--tracked", nargs="*", default=[], help="columns whose changes are versions")
    parser.add_argument("--order", nargs="*", default=[], help="order of changes of one key and day")
    parser.add_argument("--jdbc", action="store_true", help="write facts to the warehouse")
    return parser.parse_args(argv)


def _silver(spark, layout, a):
    return jobs.run_silver(
        spark, layout, a.run_id, a.names or EVENT_TYPES, dates=a.dates, hours=a.hours,
        multi_line=not a.json_lines, purge=a.purge, gather=a.gather,
    )


def _paths(a) -> dict[str, str]:
    return dict(n.split("=", 1) for n in a.names)


def _facts(spark, layout, a):
    options = jdbc_options_from_env() if a.jdbc else None
    return jobs.build_facts(spark, layout, a.names or None, jdbc=options, run_ids=a.runs)


def _merge(spark, layout, a):
    if len(a.names) != 2 or not a.keys or not a.tracked:
        raise ValueError("merge needs a table, a folder of changes, --keys and --tracked")
    table, changes = a.names[0], spark.read.parquet(a.names[1])

    def merge() -> None:
        jobs.merge_dim(spark, layout, table, changes, a.keys, a.tracked, a.order)

    return jobs.run_steps(spark, {table: merge}, jobs.RAISE)


def _purge(spark, layout, a):
    if not a.runs:
        raise ValueError("purge needs --runs")
    return jobs.purge_runs(spark, layout, a.runs, a.names or EVENT_TYPES, a.dates, a.hours, jobs.CONTINUE)


def _known(spark, layout, a):
    found = {n: read_table(spark, layout.table(n)) for n in a.names}
    return {n: df for n, df in found.items() if df is not None}


JOBS = {
    "silver": _silver,
    "seeds": lambda spark, layout, a: jobs.load_seed_dims(spark, layout, _paths(a), multi_line=not a.json_lines),
    "masters": lambda spark, layout, a: jobs.load_masters(spark, layout, _paths(a), multi_line=not a.json_lines),
    "dims": lambda spark, layout, a: jobs.build_dims(spark, layout, (a.first_day, a.last_day)),
    "facts": _facts,
    "publish": lambda spark, layout, a: jobs.publish_silver(spark, layout, jdbc_options_from_env(), run_ids=a.runs),
    "merge": _merge,
    "purge": _purge,
    "counts": lambda spark, layout, a: load_counts(_known(spark, layout, a)),
    "profile": lambda spark, layout, a: profile_tables(_known(spark, layout, a)),
}


def run(spark, arguments: argparse.Namespace):
    """Run one job and return its status, counts or profile frame."""
    layout = jobs.Layout(
        arguments.bronze, arguments.database, arguments.table_root, arguments.table_format
    )
    return JOBS[arguments.job](spark, layout, arguments)


def main(argv: list[str] | None = None) -> int:
    arguments = _arguments(sys.argv[1:] if argv is None else argv)
    outcome = run(get_spark(), arguments)
    outcome.show(max(1, outcome.count()), truncate=False)
    failed = "status" in outcome.columns and not outcome.filter("status <> 'ok'").isEmpty()
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
