"""Run registered queries next to their SQL and compare rows, names and values.

    python -m tests.oracle [sf_dir] [name-or-prefix ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if value != value else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    """None if equal, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    got_names, got_rows = df.columns, df.collect()
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    for name, kind in df.dtypes:
        if kind.startswith(("decimal", "map", "binary")):
            return f"column {name} has type {kind}, which does not hash like the SQL result"
    got, want = table(got_names, got_rows), table(want_names, want_rows)
    if got != want:
        a, b = list((got - want).elements()), list((want - got).elements())
        return (f"{sorted(got_names)}: rows {len(got_rows)} vs {len(want_rows)}, "
                f"{len(a)} / {len(b)} differ: {sorted(a, key=str)[:2]} vs {sorted(b, key=str)[:2]}")
    if not got_rows:
        return "no rows"
    return None


def session():
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master("local[8]").appName("tallgrass-check")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as entry
    sf_dir = argv[0] if argv and "/" in argv[0] else "/root/testdata/sf0.01"
    wanted = [a for a in argv if "/" not in a]
    spark, con = session(), duck(sf_dir)
    bad = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, fn, oracles[name], sf_dir)
            else:
                problem = None if fn(spark, sf_dir).count() else "no rows"
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:900]}"
        took = time.time() - t
        if problem:
            bad += 1
            print(f"FAIL {name} {took:.1f}s {problem[:1500]}", flush=True)
        elif took > 4 or wanted:
            print(f"ok   {name} {took:.1f}s{'' if name in oracles else ' rows-only'}", flush=True)
    print("failures:", bad, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
