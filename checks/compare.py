"""Run registered queries and compare them with their SQL counterparts in DuckDB.

    python -m checks.compare [--sf /root/testdata/sf0.01] [query ...]
"""

from __future__ import annotations

import argparse
import logging
import math
import time
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    return columns, Counter(tuple(_plain(v) for v in row) for row in rows)


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"create view {name} as select * from '{path}'")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], rows


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from telmart.session import get_spark

    parser = argparse.ArgumentParser()
    parser.add_argument("queries", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    arguments = parser.parse_args()
    spark = get_spark(
        "compare", "local[8]",
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
 "spark.driver.memory": "8g",
         "spark.sql.shuffle.partitions": "8"},
        "ERROR",
    )
    logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL)
    failures = 0
    for name in arguments.queries or QUERIES:
        started = time.time()
        try:
            columns, found = spark_rows(QUERIES[name](spark, arguments.sf))
        except Exception as error:
            failures += 1
            print(f"{name}: ERROR {str(error)[:600]}", flush=True)
            continue
        took = f"{sum(found.values())} rows, {time.time() - started:.1f} s"
        if name not in ORACLES:
            print(f"{name}: no sql ({took})", flush=True)
            continue
        try:
            expected_columns, expected = duckdb_rows(ORACLES[name], arguments.sf)
        except Exception as error:
            failures += 1
            print(f"{name}: SQL ERROR {str(error)[:600]}", flush=True)
            continue
        if columns != expected_columns:
            failures += 1
            print(f"{name}: COLUMNS {columns} expected {expected_columns}", flush=True)
        elif found != expected:
            failures += 1
            print(f"{name}: DIFFERS ({took}, expected {sum(expected.values())} rows)", flush=True)
            for label, rows in (("only spark", found - expected), ("only sql", expected - found)):
                for row in list(rows)[:3]:
                    print(f"   {label}: {row}")
        else:
            print(f"{name}: ok ({took})", flush=True)
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main())
