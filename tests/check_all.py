"""Run registered queries next to their SQL and compare: python tests/check_all.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry
from profitgrid.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')").fetchall()
    return con


def normal(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else repr(value)


def ordered(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(normal(row[i]) for i in places) for row in rows]
    return [columns[i] for i in places], sorted(keyed, key=lambda r: tuple(str(v) for v in r))


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = entry.queries()[name](spark, folder)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    result = con.execute(entry.oracle_sql()[name])
    want = ordered([d[0] for d in result.description], result.fetchall())
    note = f"{len(got[1])} rows, {seconds:.1f} s"
    if got[0] != want[0]:
        return False, f"{note}: columns {got[0]} != {want[0]}"
    described = con.execute("DESCRIBE " + entry.oracle_sql()[name]).fetchall()
    types = {(c, TYPES.get(t, t)) for c, t in df.dtypes} ^ {(row[0], row[1]) for row in described}
    if types:
        return False, f"{note}: types differ in {sorted(types)}"
    if len(got[1]) != len(want[1]):
        return False, f"{note}: {len(want[1])} rows wanted"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if wrong:
        cells = [(c, a, b) for c, a, b in zip(got[0], *wrong[0]) if a != b]
        return False, f"{note}: {len(wrong)} rows differ, first in {cells[:4]}"
    return True, note


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
