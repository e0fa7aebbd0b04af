"""Compare registered queries with their SQL run by DuckDB on the same files.

    python tests/compare.py [--sf DIR] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(f"{v:.10g}"))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return repr(v)


def kind(v):
    if isinstance(v, bool):
        return "bool"
    return {"datetime": "time", "Timestamp": "time"}.get(type(v).__name__, type(v).__name__)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = Counter(tuple(cell(r[i]) for i in order) for r in rows)
    kinds = [{kind(r[i]) for r in rows if r[i] is not None} for i in order]
    return sorted(names), out, kinds


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def check(spark, con, folder, run, sql):
    """(number of rows, problem or None)"""
    df = run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    gn, g, gk = rows_of(df.columns, got)
    wn, w, wk = rows_of(names, want)
    if gn != wn:
        return len(got), f"columns {gn} != {wn}"
    if g != w:
        return len(got), f"rows {len(got)} vs {len(want)}; only here {list((g - w))[:3]}; only SQL {list((w - g))[:3]}"
    if gk != wk:
        return len(got), f"types {[(n, a, b) for n, a, b in zip(gn, gk, wk) if a != b]}"
    return len(got), None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as e

    folder = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        folder, argv = argv[1], argv[2:]
    spark, con, sql, bad = session(), duck(folder), e.oracle_sql(), []
    for name, run in e.queries().items():
        if argv and not name.startswith(tuple(argv)):
            continue
        start = time.time()
        try:
            n, problem = check(spark, con, folder, run, sql.get(name))
        except Exception as err:  # report and go on
            n, problem = -1, f"{type(err).__name__}: {str(err)[:600]}"
        mark = "ok " if problem is None and name in sql else "   " if problem is None else "BAD"
        print(f"{mark} {name:36s} {n:7d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad or "none")


if __name__ == "__main__":
    main(sys.argv[1:])
