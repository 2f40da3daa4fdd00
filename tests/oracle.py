"""Compare registered queries with their SQL on the same parquet files.

As a script: ``python -m tests.oracle [sf] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, Decimal)):
        return "float"
    return type(value).__name__


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kinds_of(columns: list[str], rows) -> dict[str, set[str]]:
    out = {c: set() for c in columns}
    for r in rows:
        for c, v in zip(columns, r):
            if v is not None:
                out[c].add(kind(v))
    return out


def differences(spark, con, sf_dir: str, run, sql: str) -> str | None:
    df = run(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if a != b:
        left, right = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"rows {len(ours)} vs {len(theirs)}; only ours {str(left)[:600]}; only SQL {str(right)[:600]}"
    ka, kb = kinds_of(df.columns, ours), kinds_of(names, theirs)
    if ka != kb:
        return f"types {ka} != {kb}"
    return None if ours else "no rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import build_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = differences(spark, con, sf_dir, queries[name], oracles[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        took = time.time() - start
        mark = "ok " if problem is None else "BAD"
        if name not in oracles:
            mark += " (rows only)"
        bad += problem is not None
        print(f"{mark} {name} {took:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
