"""The model registry: versions, the pointer, races; run records; several models over one scan."""

import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from parcelwise.operators import evaluate, models, runs
from parcelwise.operators.features import TARGET
from parcelwise.operators.registry import PromotionConflict, Registry, judge

ROW = dict(
    customer_state="SP", seller_state="RJ", customer_lat=-23.0, customer_lng=-46.0, seller_lat=-22.0, seller_lng=-43.0,
    n_sellers=1, n_items=1, total_price=10.0, total_freight=1.0, total_weight_g=100.0, estimated_delivery_days=20,
)


def constant(value):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {value}D AS prediction FROM __THIS__")])


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(90).withColumns({c: F.lit(v) for c, v in ROW.items()})
    base = base.withColumn("order_purchase_timestamp", F.timestamp_micros(F.lit(1514764800000000) + F.col("id") * 3600000000))
    split = F.when(F.col("id") < 40, "train").when(F.col("id") < 60, "val").otherwise("test").alias("split")
    return base.select("*", split, (F.col("id") % 10).alias(TARGET), F.col("id").alias("order_id")).drop("id")


def test_versions_and_the_pointer(spark, rows, tmp_path):
    held = Registry(spark, str(tmp_path / "r"))
    assert (held.versions(), held.promoted()) == ([], None)
    with pytest.raises(ValueError):
        held.load()
    one, two = held.register(constant(4.0), {"who": "a"}), held.register(constant(5.0), {})
    assert (one, two, held.versions(), held.card(1)) == (1, 2, [1, 2], {"version": 1, "who": "a"})
    held.promote(one, None)
    # Another job, which still believes that nothing has been promoted.
    with pytest.raises(PromotionConflict):
        Registry(spark, str(tmp_path / "r")).promote(two, None)
    held.promote(two, one)
    assert Registry(spark, str(tmp_path / "r")).promoted() == 2
    assert models.predicted({"p": held.load()}, rows).agg(F.max("p")).first()[0] == 5.0
    with pytest.raises(ValueError):
        held.promote(9, two)


def test_two_jobs_cannot_write_the_same_entry_and_a_dead_one_counts_as_none(spark, tmp_path):
    held = Registry(spark, str(tmp_path / "r"))
    held.register(constant(1.0), {})
    assert held._create("promotions/00000001.json", {"version": 1}) and not held._create("promotions/00000001.json", {"version": 7})
    (tmp_path / "r" / "promotions" / "00000002.json").write_text("")  # its writer died
    assert held.promoted() == 1
    held.promote(1, 1)
    assert json.loads((tmp_path / "r" / "promotions" / "00000003.json").read_text()) == {"instead_of": 1, "version": 1}
    # A number taken by a job that never ended is not given again, and is no version.
    (tmp_path / "r" / "numbers" / "00000002.json").write_text("{}")
    assert held.register(constant(2.0), {}) == 3 and held.versions() == [1, 3]


def test_the_gate_moves_the_pointer(spark, rows, tmp_path):
    held = Registry(spark, str(tmp_path / "r"))
    test, baseline = rows.where("split = 'test'"), constant(9.0)
    outcome = []
    for value, p95 in ((9.5, None), (6.0, None), (6.1, None), (4.5, 300.0), (4.5, 20.0)):
        row = judge(held, held.register(constant(value), {}), test, baseline, p95).first()
        outcome.append((row["version"], row["champion"], row["promoted"], held.promoted()))
    assert outcome == [(1, None, False, None), (2, None, True, 2), (3, 2, False, 2), (4, 2, False, 2), (5, 2, True, 5)]
    assert row["n"] == 30 and row["new_mae"] == 2.5 and row["champion_mae"] == pytest.approx(2.7)


def test_several_models_are_scored_in_one_scan(spark, rows, tmp_path):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    fitted = models.fit_candidates(stored.where("split = 'train'"), ["median", "linear_regression"])
    all_ = models.predict_all({**fitted, "again": fitted["linear_regression"]}, stored)
    assert all_._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r["model"], r["split"]): (r["n"], r["mae"]) for r in evaluate.model_errors(all_).collect()}
    assert len(got) == 6 and got["again", "test"] == got["linear_regression", "test"] and got["median", "val"][0] == 20


def test_a_run_is_on_record_once(spark, rows, tmp_path):
    path = str(tmp_path / "runs")
    fitted = models.fit_candidates(rows.where("split = 'train'"), ["median", "linear_regression"])
    made = runs.record(fitted, rows.select("order_id", "split", TARGET), models.predict_all(fitted, rows))
    for run in ("b", "a", "b"):
        runs.keep_record(made, path, run)
    found = runs.records(spark, path)
    assert found.groupBy("run_id").count().select("count").distinct().count() == 1
    one = found.where("run_id = 'a'")
    get = lambda **by: [r for r in one.collect() if all(r[k] == v for k, v in by.items())]
    assert {r["split"]: r["number"] for r in get(kind="rows")} == {"train": 40, "val": 20, "test": 30}
    assert get(kind="table", name="n")[0]["number"] == 90 and get(kind="table", name="checksum")[0]["text"].isdigit()
    assert get(kind="param", model="linear_regression", name="solver")[0]["text"] == "normal"
    assert get(kind="param", model="linear_regression", name="maxIter")[0]["number"] == 100
    assert len(get(kind="metric")) == 2 * 2 * 3
    assert tuple(runs.best_run(found, "median").first()) == ("a", 2.5)
