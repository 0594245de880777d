"""Run registered queries against their oracle SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql):
    """None if equal, else a message."""
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return None if got else "both sides are empty"
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows vs {len(want)}; spark only {only_got}; sql only {only_want}"


def main() -> int:
    from corpusloom.plans import ORACLES, QUERIES
    from corpusloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    for name in names:
        start = time.time()
        try:
            message = compare(con, QUERIES[name](spark, sf_dir), ORACLES.get(name))
        except Exception as exc:  # noqa: BLE001
            message = f"{type(exc).__name__}: {str(exc)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{'ok  ' if message is None else 'FAIL'} {name} {time.time() - start:.1f}s {message or ''}", flush=True)
        if message:
            bad.append(name)
    print(f"{len(names) - len(bad)}/{len(names)} ok", bad)
    spark.stop()
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())
