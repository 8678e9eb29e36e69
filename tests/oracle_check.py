"""Run every registered job next to its SQL: python tests/oracle_check.py [folder] [name ...]"""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from passageloom.session import local_session  # noqa: E402


def connect(folder):
    connection = duckdb.connect()
    for name in os.listdir(folder):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, folder, name):
    """None when the job and its SQL agree, else what differs."""
    frame = entry.queries()[name](spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.sql(entry.oracle_sql()[name])
    expected = rows_of(result.columns, result.fetchall())
    if sorted(frame.columns) != sorted(result.columns):
        return f"columns {frame.columns} and {result.columns}"
    if got != expected:
        first = next(((a, b) for a, b in zip(got, expected) if a != b), None)
        return f"{len(got)} and {len(expected)} rows, first difference {str(first)[:400]}"
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = local_session(8), connect(folder)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next job
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {'ok' if problem is None else 'DIFFERS ' + problem} ({time.time() - start:.1f}s)", flush=True)
