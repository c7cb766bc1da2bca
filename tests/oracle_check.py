"""Compare registered queries with their SQL oracle, value by value.

Run as ``python tests/oracle_check.py [sf] [name-part ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, name, query, sql, sf_dir):
    """None when equal, otherwise a short description of the difference."""
    frame = query(spark, sf_dir)
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(set(frame.columns) ^ set(names))}"
    wrong = {c: (t, types[c]) for c, t in frame.dtypes if TYPES.get(t, t) != types[c]}
    if wrong:
        return f"types {wrong}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    if len(expected) != len(actual):
        return f"{len(actual)} rows, expected {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    if not expected:
        return "no rows at all" if name not in {"rec_forecast_growth"} else None
    return None


if __name__ == "__main__":
    from faultline.queries import ORACLES, QUERIES
    from faultline.session import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"{DATA}/sf{scale}"
    session = build_session(
        "oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                       "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(folder)
    bad = 0
    for key, function in QUERIES.items():
        if wanted and not any(part in key for part in wanted):
            continue
        start = time.time()
        try:
            if key in ORACLES:
                problem = compare(session, duck, key, function, ORACLES[key], folder)
            else:
                problem = None if function(session, folder).collect() else "no rows at all"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "O" if key in ORACLES else "R"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {key} {problem or ''}", flush=True)
    print("failed:", bad)
