"""Run the registered queries and their SQL on the same tables and compare the rows.

As a script: ``python tests/compare.py /root/testdata/sf0.01 [query ...]``.
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """None if both sides have equal columns and rows, else what differs."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    want = _multiset(names, expected.fetchall())
    got = _multiset(frame.columns, [tuple(row) for row in frame.collect()])
    if got == want:
        return None
    extra, missing = (list(rows.items())[:3] for rows in (got - want, want - got))
    return f"{got.total()} rows instead of {want.total()}; extra {extra}, missing {missing}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    from sluice.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, failures = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            result = difference(query(spark, folder), connection, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:  # report and go on with the other queries
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failures += result is not None
        print(f"{name:30} {time.time() - start:6.2f}s  {'ok' if result is None else result}", flush=True)
    print(f"{failures} differ")


if __name__ == "__main__":
    main()
