"""Runs registered queries and their SQL side by side. Usage: python -m tests.oracle [sf] [name...]"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ROOT = os.environ.get("TESTDATA", "/root/testdata")


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted([tuple(_cell(r[i]) for i in order) for r in rows], key=repr)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder, run, sql) -> str:
    df = run(spark, folder)
    got = normalised(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = normalised(cols, cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != duck_types[name]:
            return f"type of {name}: {kind} != {duck_types[name]}"
    if got[1] != want[1]:
        pairs = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
        return f"rows {len(got[1])} / {len(want[1])}, first differences {pairs}"
    return ""


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = argv[0] if argv else "sf0.01"
    folder = f"{ROOT}/{sf}"
    spark, con = make_session(), duck(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, folder, queries[name], sqls[name])
            else:
                n = len(queries[name](spark, folder).collect())
                problem = "" if n else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(argv[1:] or queries)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
