"""Compare a Spark result with the same query in DuckDB, value by value."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from bodega.queries.base import TABLES


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, float)):
        return (type(v).__name__, repr(v))
    return (type(v).__name__, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str, seen: list | None = None) -> str | None:
    """None when equal, else what differs; the row count is added to `seen`."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if seen is not None:
        seen.append(len(got))
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"rows {len(got)} vs {len(want)}\n  spark  {only_got[:2]}\n  oracle {only_want[:2]}\n  columns {got_cols}"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from bodega.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles, bad = oracle_connection(folder), entry.queries(), entry.oracle_sql(), 0
    for name in [n for n in queries if not names or any(n.startswith(x) for x in names)]:
        start, seen = time.time(), []
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = differences(df, con, oracles[name], seen)
            else:
                problem = None if df.count() >= 0 else "none"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s rows={seen} {'' if name in oracles else '(rows only)'} {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
