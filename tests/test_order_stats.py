"""Exact percentiles, ranks and running counts against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import locate, medians, percentiles, running_counts, value_counts


def samples(seed):
    rng = random.Random(seed)
    return {
        "hot": [rng.gauss(100, 1e-3) for _ in range(3000)],  # all in one coarse bucket
        "ties": [5.0] * 500 + [7.0] * 2,
        "signs": [rng.uniform(-1e6, 1e6) for _ in range(801)] + [0.0] * 10,
        "tails": [10.0 ** rng.uniform(-200, 200) for _ in range(400)],
        "one": [3.25],
        "two": [-1.0, 2.0],
    }


@pytest.fixture(scope="module")
def table(spark):
    rows = [(g, v) for g, vs in samples(1).items() for v in vs] + [("hot", None), ("empty", None), (None, 4.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(4)


def test_percentiles_equal_linear_interpolation(table):
    probs = {"lo": 0.0, "q": 0.25, "mid": 0.5, "high": 0.99, "hi": 1.0}
    got = {r["g"]: r for r in percentiles(table, "v", probs, by=["g"]).collect()}
    assert set(got) == {*samples(1), None}
    for name, values in samples(1).items():
        for column, p in probs.items():
            assert got[name][column] == pytest.approx(np.percentile(values, p * 100), rel=1e-12), (name, column)
    assert got[None]["mid"] == 4.0


def test_percentiles_without_groups_and_with_weights(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 6)], "v double, w bigint")
    assert percentiles(df, "v", {"m": 0.5}, weight="w").first()["m"] == np.median([1] * 3 + [2] + [10] * 6)
    assert percentiles(df.where("false"), "v", {"m": 0.5}).first()["m"] is None


def test_medians_of_several_columns(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (None, 30.0), (7, None)], "a bigint, b double")
    row = medians(df, {"a": "ma", "b": "mb"}).first()
    assert (row["ma"], row["mb"]) == (2.0, 20.0)


def test_locate_gives_value_and_place_among_equals(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 5, 5, 9]], "v bigint")
    row = locate(value_counts(df, "v"), ["0", "3", "_total - 1", "_total"]).first()
    assert (row["_v0"], row["_skip0"]) == (1, 0)
    assert (row["_v1"], row["_skip1"]) == (5, 2)
    assert row["_v2"] == 9
    assert row["_v3"] is None  # past the end


def test_running_counts(spark):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.9 else "b", round(rng.gauss(0, 50), 1)) for _ in range(3000)]
    counted = value_counts(spark.createDataFrame(rows, "g string, v double"), "v", ["g"])
    got = running_counts(counted, ["_c"], by=["g"]).collect()
    for r in got:
        assert r["_c_upto"] == sum(1 for g, v in rows if g == r["g"] and v <= r["_v"])
    assert sum(r["_c"] for r in got) == len(rows)


def test_no_window_over_a_whole_group(table):
    """Windows run over bucket sizes (_n) or over the values of one fine bucket (_f)."""
    plan = percentiles(table, F.col("v"), {"m": 0.5}, by=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    for line in (x for x in plan.splitlines() if "Window [" in x):
        assert "sum(_n#" in line or "_f#" in line
