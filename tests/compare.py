"""Runs registered queries next to their SQL in DuckDB and compares the rows, order-insensitively."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    if hasattr(v, "as_tuple"):
        return float(v)
    return str(v)


def _sortable(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=_sortable)


def mismatch(spark_df, con, sql) -> str | None:
    """None when equal, otherwise a short description of the first difference."""
    got_names, got = rows_of(spark_df.columns, [tuple(x) for x in spark_df.collect()])
    rel = con.execute(sql)
    want_names, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{got_names}\n  spark  {a}\n  duckdb {b}"
    return None


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark = make_session()
    con = connect(folder)
    oracles, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problem = mismatch(df, con, oracles[name])
            else:
                n = df.count()
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001 - report every failing query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
