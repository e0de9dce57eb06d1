"""Run every registered query and its SQL on one folder and compare the rows.

    python tests/check_oracle.py /root/testdata/sf0.01 [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def compare(spark, connection, folder, name, build, sql):
    result = build(spark, folder)
    columns = sorted(result.columns)
    got = sorted(tuple(plain(v) for v in row) for row in result.select(columns).collect())
    relation = connection.sql(sql)
    if sorted(relation.columns) != columns:
        return f"columns differ: {sorted(set(relation.columns) ^ set(columns))}", len(got)
    listed = ", ".join(f'"{c}"' for c in columns)
    rows = connection.sql(f"SELECT {listed} FROM ({sql})").fetchall()
    wanted = sorted(tuple(plain(v) for v in row) for row in rows)
    if len(got) != len(wanted):
        return f"{len(got)} rows, SQL has {len(wanted)}", len(got)
    off = [(g, w) for g, w in zip(got, wanted) if g != w]
    if off:
        g, w = off[0]
        detail = [(c, a, b) for c, a, b in zip(columns, g, w) if a != b]
        return f"{len(off)} rows differ, first: {detail[:4]}", len(got)
    return None, len(got)


if __name__ == "__main__":
    from nodecast.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    answers = entry.oracle_sql()
    failed = []
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in answers:
                problem, rows = compare(spark, connection, folder, name, build, answers[name])
            else:
                problem, rows = None, build(spark, folder).count()
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        state = problem or ("ok" if name in answers else "ran")
        print(f"{name:32} {rows:7} rows {time.time() - started:6.1f} s  {state}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    sys.exit(bool(failed))
