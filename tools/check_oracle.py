"""Run registered queries against their SQL in DuckDB: ``check_oracle.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snaptide.session import local_session  # noqa: E402
from snaptide.workload import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    mine = sorted_rows(df.columns, df.collect())
    if name not in ORACLES:
        return True, f"{len(mine[1])} rows, no SQL"
    relation = connection.sql(ORACLES[name])
    theirs = sorted_rows(relation.columns, relation.fetchall())
    if mine == theirs:
        return True, f"{len(mine[1])} rows"
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} / {theirs[0]}"
    only_mine = [r for r in mine[1] if r not in set(theirs[1])][:3]
    only_theirs = [r for r in theirs[1] if r not in set(mine[1])][:3]
    return False, f"{len(mine[1])} / {len(theirs[1])} rows; {only_mine} / {only_theirs}"


if __name__ == "__main__":
    sf_dir = sys.argv[1]
    spark = local_session(8)
    connection = duck(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        started = time.time()
        try:
            good, note = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:28s} {time.time() - started:6.2f} s  {note}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    sys.exit(bool(failed))
