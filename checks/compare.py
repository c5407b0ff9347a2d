"""Run registered queries next to their SQL and report which results are equal.

Usage: python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from checks.oracle import ORACLE_SQL
from parcelwise.plans.queries import QUERIES
from parcelwise.session import local_session

# No query may need one of these, in the plan that ran.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _key(row) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    got = QUERIES[name](spark, folder)
    names, rows = rows_of(got.columns, got.collect())
    took = time.time() - started
    plan = got._jdf.queryExecution().executedPlan().toString()
    bad = [word for word in FORBIDDEN if word in plan]
    if bad:
        return False, f"the plan that ran has {bad}"
    if name not in ORACLE_SQL:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    cursor = con.execute(ORACLE_SQL[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != want_names:
        return False, f"columns {names} vs {want_names}"
    spark_kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    bad = [f"{c}: {k} vs {kinds[c]}" for c, k in got.dtypes if spark_kinds.get(k, k) != kinds[c]]
    if bad:
        return False, f"types {bad}"
    if rows != want:
        diff = [(a, b) for a, b in zip(rows, want) if a != b][:2]
        return False, f"{len(rows)} vs {len(want)} rows; columns {names}; first differences {diff}"
    return True, f"{len(rows)} rows, {took:.1f}s"


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(folder)
    failed = []
    for name in argv[1:] or QUERIES:
        try:
            good, text = compare(spark, con, folder, name)
        except Exception as error:  # one broken query must not hide the others
            good, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if good else "FAIL", name, text, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
