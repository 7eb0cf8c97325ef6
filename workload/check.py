"""Compare registered queries with their SQL twins: python -m workload.check [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import math
import sys
import time
from collections import Counter

import duckdb

from tabmill.session import build_session


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def compare(spark, sf_dir: str, name: str, run, sql: str | None) -> str:
    df = run(spark, sf_dir)
    columns = sorted(df.columns)
    rows = Counter(tuple(canonical(r[c]) for c in columns) for r in df.collect())
    total = sum(rows.values())
    if sql is None:
        return f"rows {total}" if total else "EMPTY"
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1][:-8]} AS SELECT * FROM '{path}'")
    con.execute(sql)
    names = [c[0] for c in con.description]
    if sorted(names) != columns:
        return f"COLUMNS differ: {sorted(set(names) ^ set(columns))}"
    at = [names.index(c) for c in columns]
    expected = Counter(tuple(canonical(r[i]) for i in at) for r in con.fetchall())
    if rows != expected:
        only_spark, only_sql = rows - expected, expected - rows
        return (
            f"DIFFERS: {total} rows against {sum(expected.values())}; columns {columns}\n"
            f"  spark only {list(only_spark)[:2]}\n  sql only   {list(only_sql)[:2]}"
        )
    return f"equal {total}"


def main() -> int:
    from workload.catalog import QUERIES, SQL

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        began = time.time()
        try:
            outcome = compare(spark, sf_dir, name, QUERIES[name], SQL.get(name))
        except Exception as error:  # noqa: BLE001 - reported, the others go on
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        good = outcome.startswith(("equal", "rows"))
        bad += not good
        print(f"{'ok  ' if good else 'BAD '} {name:34s} {time.time() - began:6.2f}s {outcome}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
