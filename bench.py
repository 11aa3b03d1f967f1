"""Benchmark of the headline operations; prints one JSON line.

Raw call, payment and support events are first derived from the test tables and landed
as files, as they would arrive; only the library's work on them is timed. Every figure
is the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import bindings as b  # noqa: E402
from checks.queries import DATES  # noqa: E402
from telmart.operators import joins  # noqa: E402
from telmart.operators.aggregates import daily_measures, drill_across  # noqa: E402
from telmart.operators.quality import orphan_keys, rejection_report  # noqa: E402
from telmart.operators.scd import scd2_merge  # noqa: E402
from telmart.plans.dims import build_dim, build_dim_date, build_dim_time  # noqa: E402
from telmart.plans.facts import build_fact  # noqa: E402
from telmart.plans.silver import to_silver  # noqa: E402
from telmart.session import get_spark  # noqa: E402
from telmart.sinks.tables import publish_new_rows  # noqa: E402
from telmart.sources.bronze import read_bronze  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
SOURCES = {"calls": "call", "payment": "payment", "support": "support"}


def consume(df) -> None:
    """Compute every row and column without storing them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    work = tempfile.mkdtemp(prefix="bench-")
    spark = get_spark(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.warehouse.dir": f"{work}/warehouse",
        },
        "ERROR",
    )
    logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL)

    # Landing: one file per task, as a distributed producer leaves them.
    for event_type in SOURCES.values():
        raw = b.RAW_EVENTS[event_type](spark, SF_DIR).repartition(2 * int(CPUS))
        raw.write.json(f"{work}/landing/{event_type}/2025-03-01/07")

    def bronze(event_type):
        return read_bronze(spark, f"{work}/landing/{event_type}", event_type, multi_line=False)

    for name, event_type in SOURCES.items():
        to_silver(bronze(event_type), event_type).write.parquet(f"{work}/silver/{name}")
        silver = spark.read.parquet(f"{work}/silver/{name}")
        build_fact(silver, name).write.parquet(f"{work}/fact/{name}")
    dims = {
        "user": b.seed_users, "device": b.seed_devices, "cell_site": b.seed_cell_sites,
        "agent": b.seed_agents,
    }
    for name, seed in dims.items():
        build_dim(seed(spark, SF_DIR), name).write.parquet(f"{work}/dim/{name}")

    def silver_of(name):
        return spark.read.parquet(f"{work}/silver/{name}")

    def fact_of(name):
        return spark.read.parquet(f"{work}/fact/{name}")

    def dim_of(name):
        return spark.read.parquet(f"{work}/dim/{name}")

    def star():
        dated = joins.with_date(
            fact_of("calls"), build_dim_date(spark, *DATES, unknown_member=True),
            ["date", "year"], fixed_size=True,
        )
        timed = joins.with_time(dated, build_dim_time(spark), ["am_pm"])
        consume(
            daily_measures(
                timed, ["date_date", "date_year", "time_am_pm"],
                sums=["amount", "call_duration_seconds"],
            )
        )

    def role_playing(**options):
        calls = fact_of("calls")
        wide = joins.with_users(calls, dim_of("user"), ["plan_type", "city"], **options)
        wide = joins.with_cell_sites(wide, dim_of("cell_site"), ["city"], keys_from=calls, **options)
        consume(
            daily_measures(
                wide, ["from_user_plan_type", "to_user_plan_type", "to_cell_city"], sums=["amount"]
            )
        )

    def drill():
        parts = {
            "calls": daily_measures(fact_of("calls"), ["date_sk"], sums=["amount"]),
            "payment": daily_measures(fact_of("payment"), ["date_sk"], sums=["amount"]),
        }
        consume(drill_across(parts, ["date_sk"], ["n_rows", "sum_amount"]))

    published = iter(range(10_000))

    def publish_twice():
        name = f"published_{next(published)}"
        publish_new_rows(fact_of("calls"), name, "transaction_sk")
        publish_new_rows(fact_of("calls"), name, "transaction_sk")

    def scd2():
        dim = b.table(spark, SF_DIR, "customer").selectExpr(
            "c_custkey as user_id", "c_mktsegment as plan_type", "'1998-01-01' as effective_from",
            "'9999-12-31' as effective_to", "true as is_current",
        )
        changes = b.table(spark, SF_DIR, "orders").selectExpr(
            "o_custkey as user_id", "o_orderpriority as plan_type",
            "substr(cast(o_orderdate as string), 1, 10) as effective_from",
        )
        consume(scd2_merge(dim, changes, ["user_id"], ["plan_type"]))

    operations = {
        "bronze_to_silver_calls": lambda: consume(to_silver(bronze("call"), "call")),
        "bronze_to_silver_payment": lambda: consume(to_silver(bronze("payment"), "payment")),
        "rejection_report": lambda: consume(rejection_report(silver_of("calls"), "event_type")),
        "fact_calls": lambda: consume(build_fact(silver_of("calls"), "calls")),
        "fact_payment": lambda: consume(build_fact(silver_of("payment"), "payment")),
        "fact_support": lambda: consume(build_fact(silver_of("support"), "support")),
        "star_daily": star,
        "role_playing_joins": role_playing,
        "role_playing_joins_large_dim": lambda: role_playing(max_bytes=0),
        "ri_orphans": lambda: consume(
            orphan_keys(fact_of("support"), "agent_id", dim_of("agent"), "agent_id")
        ),
        "drill_across": drill,
        "idempotent_publish_twice": publish_twice,
        "scd2_merge": scd2,
    }
    seconds = {}
    for name, operation in operations.items():
        operation()
        taken = []
        for _ in range(RUNS):
            started = time.perf_counter()
            operation()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    total = round(sum(seconds.values()), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds, headline operations",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
