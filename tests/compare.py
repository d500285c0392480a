"""Compares a registered query with its SQL counterpart. Also runnable: compare.py SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def expected(connection, sql):
    result = connection.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def actual(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


if __name__ == "__main__":
    import __spark_entry__ as entry
    from quayside.session import build_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles, bad = duck(sf), entry.queries(), entry.oracle_sql(), []
    for name in names or queries:
        started = time.time()
        try:
            got = actual(queries[name](spark, sf))
            spent = time.time() - started
            want = expected(con, oracles[name])
            same = got == want
        except Exception as error:
            print(name, "ERROR", str(error)[:1500], flush=True)
            bad.append(name)
            continue
        print(f"{name:22s} {'ok' if same else 'DIFFERS':8s} {len(got[1]):7d} {len(want[1]):7d} spark {spent:5.1f}s sql {time.time() - started - spent:5.1f}s", flush=True)
        if not same:
            bad.append(name)
            print("  columns", got[0], want[0])
            g, w = set(map(repr, got[1])), set(map(repr, want[1]))
            print("  only spark", sorted(g - w)[:3], "\n  only sql", sorted(w - g)[:3])
    print("bad:", bad)
    spark.stop()
