"""Registered queries against their SQL, and the plans that ran."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.oracle import ORACLE_SQL
from parcelwise.plans.queries import QUERIES

# Covered by tests/test_models.py, and slow; `python -m checks.compare` runs everything.
SLOW = {"model_compare", "run_metrics", "score_batch", "stream_score"}
NO_SQL = {"profile_columns_approx", "describe_numeric_approx", "request_metrics_approx"} | SLOW

@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE_SQL) == NO_SQL
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_the_order_columns(spark):
    from parcelwise.sources.tables import ORDER_COLUMNS

    assert entry.entry(spark).columns == list(ORDER_COLUMNS)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE_SQL])
def test_query_equals_sql(spark, con, small, name):
    """Equal rows, and in the plan that ran no Python, no Cartesian product and no nested-loop join."""
    good, text = compare(spark, con, small, name)
    assert good, text


def test_scans_are_pruned(spark, small):
    plan = QUERIES["items_agg"](spark, small)._jdf.queryExecution().executedPlan().toString()
    schemas = [p.split(">")[0] for p in plan.split("ReadSchema: struct<")[1:]]
    assert not any("l_discount" in s or "l_tax" in s or "o_totalprice" in s for s in schemas)
