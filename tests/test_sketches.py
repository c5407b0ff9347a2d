"""Sketches merged over periods against exact counts and ranks."""

import random

from pyspark.sql import functions as F

from parcelwise.operators import sketches

COLUMNS = {"x": True, "name": False, "gone": True}


def rows(spark, n):
    draw = random.Random(4)
    values = [(i % 40, "a" if i % 3 else "b", draw.choice([float("nan"), draw.lognormvariate(2, 2), 5.0]), f"n{draw.randrange(30000)}", None) for i in range(n)]
    return spark.createDataFrame(values, "day int, kind string, x double, name string, gone double").repartition(5)


def test_merged_sketches_hold_their_bounds(spark):
    df = rows(spark, 60000)
    daily = sketches.sketched(df, COLUMNS, ["day", "kind"])
    assert daily.count() == 40 * 2 * 3
    found = sketches.estimates(sketches.merged(daily, ["kind"]), [0.01, 0.5, 0.99])
    got = {(r["kind"], r["column"]): r for r in sketches.checked(df, found, COLUMNS, [0.01, 0.5, 0.99], ["kind"]).collect()}
    assert len(got) == 6 and got["a", "x"]["n"] == 40000
    for (_, column), r in got.items():
        assert r["distinct_within"]
        assert r["quantiles_within"] is (True if column == "x" else None)
    assert got["a", "gone"]["n_distinct"] == 0


def test_a_wrong_estimate_is_told(spark):
    df = rows(spark, 5000)
    found = sketches.estimates(sketches.sketched(df, COLUMNS, ["kind"]), [0.5])
    wrong = found.withColumns({"n_distinct": F.col("n_distinct") * 2, "quantiles": F.transform("quantiles", lambda q: q * 3)})
    got = [r for r in sketches.checked(df, wrong, COLUMNS, [0.5], ["kind"]).collect() if r["column"] == "x"]
    assert [(r["distinct_within"], r["quantiles_within"]) for r in got] == [(False, False)] * 2


def test_only_sketches_are_shuffled_and_none_of_an_empty_table(spark):
    df = rows(spark, 100)
    plan = sketches.sketched(df, COLUMNS, ["kind"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(kind") == 1 and "partial_hll_sketch_agg" in plan
    assert sketches.merged(sketches.sketched(df.limit(0), COLUMNS, ["kind"]), ["kind"]).collect() == []
