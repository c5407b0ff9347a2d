"""The registered corpus queries against their SQL, whole tables, and the shape of their plans."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import connect, rows_of
from parcelwise.llm.queries import QUERIES
from parcelwise.llm.sql import ORACLE_SQL

ROOT = Path(__file__).resolve().parents[2]


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, small, name):
    got = QUERIES[name](spark, small)
    cursor = connect(small).execute(ORACLE_SQL[name])
    names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(got.columns, got.collect()) == (names, want)


def test_nothing_else_imports_the_corpus_jobs():
    for path in [*ROOT.glob("parcelwise/**/*.py"), *ROOT.glob("checks/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "parcelwise.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
