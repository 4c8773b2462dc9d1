"""Run a registered query and its SQL on the same tables and compare the values, order ignored."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time(0) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None where both sides agree, otherwise what differs."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(wrong)} of {len(mine[1])} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, *wanted: str) -> None:
    from cohortweave.catalog import ORACLES, QUERIES
    from cohortweave.session import local_session

    spark = local_session("8")
    con = connect(sf_dir)
    bad = 0
    for name in wanted or QUERIES:
        began = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
                rows = con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0]
            else:
                problem, rows = None, QUERIES[name](spark, sf_dir).count()
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", "?"
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok ':3} {name:32} rows={rows} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(*sys.argv[1:])
