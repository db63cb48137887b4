"""Compare registered queries with their SQL in DuckDB: ``check.py folder [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierflow.catalog import ORACLES, QUERIES  # noqa: E402
from tierflow.catalog.views import BASE_TABLES  # noqa: E402
from tierflow.session import build_session  # noqa: E402


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, bool):
        return str(value)
    return "NULL" if value is None else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name):
    """(matches, rows, seconds, note)"""
    began = time.time()
    df = QUERIES[name](spark, folder)
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    seconds = time.time() - began
    if name not in ORACLES:
        return None, len(got), seconds, "no SQL"
    result = con.execute(ORACLES[name])
    want_names, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_names) != sorted(want_names):
        return False, len(got), seconds, f"columns {sorted(got_names)} != {sorted(want_names)}"
    a, b = table(got_names, got), table(want_names, want)
    if a == b:
        types = {n: str(t) for n, t in df.dtypes}
        return True, len(got), seconds, " ".join(sorted(set(types.values())))
    bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return False, len(got), seconds, f"rows {len(a)} vs {len(b)}; first difference {bad}"


def main():
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    failed = []
    for name in wanted or QUERIES:
        try:
            ok, rows, seconds, note = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            ok, rows, seconds, note = False, -1, 0.0, f"{type(error).__name__}: {str(error)[:600]}"
        if ok is False:
            failed.append(name)
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {name:28s} {rows:8d} {seconds:6.2f}s {note if not ok else ''}",
              flush=True)
    print(f"{len(wanted or QUERIES) - len(failed)} of {len(wanted or QUERIES)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
