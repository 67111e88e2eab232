"""Compare every registered query with its SQL statement on the same tables.

``python -m workload.check [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from harvestline.session import get_spark
from workload import ORACLES, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if hasattr(v, "is_integer") or isinstance(v, int):
        return v
    return v if isinstance(v, str) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=lambda t: tuple((v is None, str(type(v).__name__ == "str"), str(v)) for v in t))


def compare(df, con, sql) -> str:
    names, got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    res = con.execute(sql)
    expected_names, expected = rows_of([d[0] for d in res.description], res.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    bad = [(a, b) for a, b in zip(got, expected) if a != b]
    return "" if not bad else f"{len(bad)} of {len(got)} rows differ, first {names}: {bad[0][0]} != {bad[0][1]}"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = get_spark("check", f"local[{os.environ.get('BENCH_CPUS', '8')}]", 8, spark__ui__enabled="false",
                      spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            if name in ORACLES:
                problem = compare(fn(spark, sf), con, ORACLES[name])
                state = "ok  " if not problem else "DIFF"
            else:
                problem, state = f"{len(fn(spark, sf).collect())} rows", "rows"
        except Exception as error:  # one broken query must not hide the others
            problem, state = f"{type(error).__name__}: {str(error)[:600]}", "FAIL"
        failed += state in ("DIFF", "FAIL")
        print(f"{state} {time.time() - began:6.2f}s {name} {problem}", flush=True)
    print(f"{len(QUERIES)} queries, {len(ORACLES)} with SQL, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
