import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import explore


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "a", 2.0), (2, "b", None), (2, "b", None), (3, None, 5.0), (4, "a", 9.0), (4, "a", 9.0), (4, "a", 9.0)]
    return spark.createDataFrame(rows, "k bigint, t string, x double")


def test_table_profile(table):
    row = explore.profile_table(table, "t").first()
    assert row.asDict() == {"table_name": "t", "n_rows": 7, "n_columns": 3, "missing_cells": 3, "duplicate_rows": 3}


def test_column_profile(table):
    keyed = table.withColumns({"one": F.lit("c"), "id": F.monotonically_increasing_id()})
    rows = {r["column"]: r for r in explore.profile_columns(keyed).collect()}
    assert (rows["x"]["n_nulls"], rows["x"]["n_distinct"], rows["x"]["type"]) == (2, 3, "double")
    assert (rows["id"]["flag"], rows["one"]["flag"], rows["t"]["flag"]) == ("key", "constant", "")
    approx = {r["column"]: r["n_distinct_approx"] for r in explore.profile_columns_approx(table).collect()}
    assert approx == {"k": 4, "t": 2, "x": 3}


def test_describe_like_pandas(spark):
    values = [float(v * v % 97) for v in range(200)]
    df = spark.createDataFrame([(v, None if i % 9 == 0 else v / 3) for i, v in enumerate(values)], "a double, b double")
    expected = df.toPandas().describe()
    for r in explore.describe_numeric(df, ["a", "b"]).collect():
        want = expected[r["column"]]
        got = [r[c] for c in ("n", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(want.tolist())


def test_describe_text(table):
    (row,) = explore.describe_text(table, ["t"]).collect()
    assert (row["n"], row["n_distinct"], row["top"], row["freq"]) == (6, 2, "a", 4)


def test_duplicates_flag_all_members(table):
    assert explore.duplicate_rows(table).count() == 5
    assert {r["copies"] for r in explore.duplicate_groups(table).collect()} == {2, 3}


def test_fingerprint_ignores_order(table):
    a = explore.fingerprint(table, "t").first()
    assert a == explore.fingerprint(table.orderBy(F.desc("k")).repartition(3), "t").first()
    assert a != explore.fingerprint(table.withColumn("x", F.col("x") + 1), "t").first()


def test_equal_and_log_histograms_like_numpy(spark):
    values = [float(v) for v in np.random.default_rng(2).lognormal(3, 1, 2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    kept = [v for v in values if v <= np.percentile(values, 99)]
    got = [r["n"] for r in explore.trimmed_histogram(df, "x").orderBy("bin").collect()]
    assert got == np.histogram(kept, bins=50)[0].tolist()
    edges = np.logspace(np.log10(min(values)), np.log10(max(values)), 50)
    got = [r["n"] for r in explore.log_histogram(df, "x").orderBy("bin").collect()]
    assert len(got) == 49 and sum(got) == 2000
    # a value at the very edge may fall on either side of a rounded edge
    assert np.abs(np.array(got) - np.histogram(values, bins=edges)[0]).sum() <= 2


def test_integer_histogram(spark):
    values = [0, 1, 1, 4, -3] + [2] * 500 + [90]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got = [(r["bin"], r["n"]) for r in explore.integer_histogram(df, "x").orderBy("bin").collect()]
    kept = [v for v in values if v <= np.percentile(values, 99)]
    edges = np.arange(0, max(kept) + 2) - 0.5
    assert [n for _, n in got] == np.histogram(kept, bins=edges)[0].tolist()


def test_shares_list_every_label(spark):
    df = spark.createDataFrame([(5.0,), (4.0,)], "review_score double")
    got = {r["label"]: (r["n"], r["share"]) for r in explore.satisfaction_shares(df).collect()}
    assert got == {"satisfied": (2, 1.0), "unsatisfied": (0, 0.0)}


def test_label_report(spark):
    counts = spark.createDataFrame([("u", "u", 3), ("u", "s", 1), ("s", "u", 2), ("s", "s", 4)], "actual string, predicted string, n bigint")
    rows = {r["label"]: r for r in explore.label_report(counts).collect()}
    assert (rows["u"]["precision"], rows["u"]["recall"], rows["u"]["support"]) == (0.6, 0.75, 4)
    assert rows["u"]["f1"] == pytest.approx(2 * 0.6 * 0.75 / 1.35)


def test_monthly_counts_like_pandas(spark):
    days = pd.date_range("2018-01-15", periods=250, freq="D")
    rows = [(i, d.to_pydatetime(), 5.0 if i % 4 else 1.0, "boleto" if i % 2 else "voucher") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "order_id bigint, order_purchase_timestamp timestamp, review_score double, main_payment_type string")
    got = {r["month"]: r for r in explore.monthly_orders(df, min_orders=20).collect()}
    assert min(got).month == 2 and sum(r["n"] for r in got.values()) < 250
    pivot = {r["month"]: r for r in explore.monthly_payment_types(df, ["boleto", "voucher", "credit_card"], 20).collect()}
    assert all(r["boleto"] + r["voucher"] == r["n"] and r["credit_card"] == 0 for r in pivot.values())
