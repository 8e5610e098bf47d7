"""Side-by-side check of a registered query and its SQL in DuckDB.

Run as a script to check some or all queries: ``python tests/oracle.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(repr(_norm(r[i])) for i in order) for r in rows])


def compare(con, df, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(names)} / {sorted(df.columns)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"rows differ: spark {len(got)}, sql {len(expected)}"
    if not got:
        return "both sides are empty"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ; first: {sorted(df.columns)}\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    wide = [n for n, t in types.items() if "HUGEINT" in t or "DECIMAL" in t]
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp": "TIMESTAMP"}
    off = [(n, k, types[n]) for n, k in df.dtypes if kinds.get(k, k) != types[n]]
    if wide or off:
        return f"types: {off or wide}"
    return None


def main() -> int:
    from gaugeworks.plans import load_all
    from gaugeworks.session import build_session

    args = sys.argv[1:]
    directory = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    failures = 0
    for name, e in load_all().items():
        if args and not any(a in name for a in args):
            continue
        t0 = time.time()
        try:
            df = e.run(spark, directory)
            problem = compare(con, df, e.sql) if e.sql else (None if df.count() else "no rows")
        except Exception as ex:  # noqa: BLE001
            problem = f"{type(ex).__name__}: {str(ex)[:1500]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t0:.2f}s", flush=True)
        if problem:
            print("     " + problem, flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
