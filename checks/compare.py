"""Runs a query on Spark and its SQL on DuckDB and compares the rows, regardless of order.

    python -m checks.compare [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(v):
    """One text form per value for both engines."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    if isinstance(v, float):
        return repr(float(f"{v:.9g}") + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def open_tables(folder: str):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def multiset(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark_names, spark_rows, sql_names, sql_rows_) -> str | None:
    if sorted(spark_names) != sorted(sql_names):
        return f"columns differ: {sorted(spark_names)} / {sorted(sql_names)}"
    a, b = multiset(spark_names, spark_rows), multiset(sql_names, sql_rows_)
    if a == b:
        return None
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return (
        f"rows {sum(a.values())} / {sum(b.values())}, unmatched {sum((a - b).values())} / "
        f"{sum((b - a).values())}\n   columns {sorted(spark_names)}\n   spark {only_a}\n   sql   {only_b}"
    )


def main(args: list[str]) -> int:
    from checks import catalogue  # noqa: F401
    from checks.registry import QUERIES, SQL
    from cohortloom.session import build_session

    sf = "0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        args = args[:i] + args[i + 2 :]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(folder)
    wanted = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows = df.collect()
            took = time.time() - start
            if name in SQL:
                names, expected = sql_rows(con, SQL[name])
                problem = differences(df.columns, rows, names, expected)
            else:
                problem = None if rows else "no rows"
        except Exception as e:
            took, problem, rows = time.time() - start, f"{type(e).__name__}: {str(e)[:1200]}", []
        bad += problem is not None
        label = "ok " if problem is None else "BAD"
        print(f"{label} {name} rows={len(rows)} {took:.2f}s{'' if name in SQL else ' (rows only)'}", flush=True)
        if problem:
            print("   " + problem, flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
