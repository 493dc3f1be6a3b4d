"""Run registered queries and their SQL side by side.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    return [columns[i] for i in order], body


def compare(spark_df, con, sql):
    """None when equal, else what differs."""
    got_columns, got = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_columns, want = table_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:3] if len(got) < 300_000 else []
        lack = [r for r in want if r not in set(got)][:3] if len(got) < 300_000 else []
        return f"{len(got)} rows, SQL has {len(want)}; only here {extra}; only SQL {lack}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]} != {bad[0 + 0][1]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as e
    from conftest import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark, con = session(), connect(sf)
    for name in names:
        start = time.time()
        if name in e.oracle_sql():
            problem = compare(e.queries()[name](spark, sf), con, e.oracle_sql()[name])
        else:
            problem = f"rows only: {e.queries()[name](spark, sf).count()}"
        print(f"{name:24s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
