"""Compares registered queries with their SQL twins, value by value.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _lines(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_names, got = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    want_names, want = [c[0] for c in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _lines(got_names, got), _lines(want_names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(i) for i in x] != [type(i) for i in y]]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main(folder: str, names: list[str]) -> int:
    from vacancia.plans.catalog import CATALOG
    from vacancia.session import local_session

    spark = local_session()
    con = connect(folder)
    failed = 0
    for name, q in CATALOG.items():
        if names and name not in names and q.run.__module__.rsplit(".", 1)[-1] not in names:
            continue
        t = time.time()
        try:
            df = q.run(spark, folder)
            if q.oracle is None:
                verdict = f"rows only: {df.count()}"
            else:
                found = compare(df, con, q.oracle)
                failed += found is not None
                verdict = "ok" if found is None else "DIFFERS " + found
        except Exception as e:
            failed += 1
            verdict = f"FAILED {type(e).__name__}: {str(e)[:900]}"
        print(f"{name:38s} {time.time() - t:6.1f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.01", args[1:]) else 0)
