"""Run every registered query against its SQL twin.

python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb

from civicmart.session import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return value


def rows_of(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def check(spark, con, folder: str, name: str, q) -> str:
    start = time.time()
    df = q.run(spark, folder)
    got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if q.sql is None:
        return f"rows {name} {len(got)} {took:.1f}s"
    start = time.time()
    result = con.execute(q.sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    sql_took = time.time() - start
    if sorted(names) != sorted(df.columns):
        return f"FAIL {name} columns {names} {df.columns}"
    if got != want:
        in_sql, in_spark = set(want), set(got)
        only_spark = [r for r in got if r not in in_sql][:3]
        only_sql = [r for r in want if r not in in_spark][:3]
        return f"FAIL {name} rows {len(got)} vs {len(want)}\n  spark {only_spark}\n  sql   {only_sql}"
    return f"ok   {name} {len(got)} rows {took:.1f}s (sql {sql_took:.1f}s)"


def main(args: list[str]) -> int:
    from checks.registry import QUERIES

    folder = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:] or list(QUERIES)
    spark = get_session(
        master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in wanted:
        try:
            line = check(spark, con, folder, name, QUERIES[name])
        except Exception as e:  # a broken query must not hide the others
            line = f"FAIL {name} {type(e).__name__} {str(e)[:600]}"
        failed += line.startswith("FAIL")
        print(line, flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
