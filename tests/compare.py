"""Compare registered queries with their SQL. Run as `python tests/compare.py [sf_dir] [names...]`."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.isoformat()
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(repr([_plain(r[i]) for i in order]) for r in rows))


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pricebeam.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare")
    con, sql, failures = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            columns, rows = spark_rows(query(spark, sf_dir))
            spent = time.time() - start
            if name not in sql:
                print(f"  --  {name}: {len(rows)} rows, no SQL ({spent:.2f} s)")
                continue
            expected_columns, expected = duck_rows(con, sql[name])
            ok = columns == expected_columns and rows == expected
            print(f"{'  ok' if ok else 'FAIL'}  {name}: {len(rows)} rows ({spent:.2f} s)")
            if not ok:
                failures += 1
                print("      columns", columns, expected_columns, "rows", len(rows), len(expected))
                print("      only Spark", sorted(set(rows) - set(expected))[:3])
                print("      only SQL  ", sorted(set(expected) - set(rows))[:3])
        except Exception as error:  # noqa: BLE001 - report and go on
            failures += 1
            print(f"FAIL  {name}: {type(error).__name__}: {str(error)[:1500]}")
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main()))
