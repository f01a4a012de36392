"""Runs every named query on Spark and its SQL on DuckDB and compares names, rows and values.

    python tools/compare.py [--sf /root/testdata/sf0.01] [--only prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from orderlens.plans import all_queries  # noqa: E402
from orderlens.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _key(value):
    return (value is None, str(type(value)) if value is None else "", value if value is not None else 0)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def table_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=lambda r: tuple(_key(v) for v in r))


def same(a, b) -> bool:
    if type(a) is not type(b):
        return False
    return a == b


def difference(spark_rows, spark_columns, duck_rows, duck_columns) -> str | None:
    """None when equal; types must agree too, floats must agree exactly after the queries' own rounding."""
    names, left = table_of(spark_rows, spark_columns)
    other, right = table_of(duck_rows, duck_columns)
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        for name, x, y in zip(names, a, b):
            if not same(x, y):
                return f"{name}: {x!r} != {y!r} in {a} / {b}"
    return None


def check(spark, con, query, folder) -> tuple[str, str]:
    frame = query.build(spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    if query.sql is None:
        return "rows only", f"{len(rows)} rows"
    cursor = con.execute(query.sql)
    diff = difference(rows, frame.columns, cursor.fetchall(), [d[0] for d in cursor.description])
    return ("ok", f"{len(rows)} rows") if diff is None else ("DIFFERENT", diff)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", nargs="*", default=[])
    parser.add_argument("--cores", default="8")
    args = parser.parse_args()
    spark = build_session("compare", f"local[{args.cores}]", 8, {"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    bad = 0
    for name, query in all_queries().items():
        if args.only and not any(name.startswith(p) for p in args.only):
            continue
        start = time.time()
        try:
            status, note = check(spark, con, query, args.sf)
        except Exception as failure:
            status, note = "ERROR", str(failure)[:700]
        bad += status in ("DIFFERENT", "ERROR")
        print(f"{status:10} {name:45} {time.time() - start:6.2f}s  {note[:600]}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
