"""Candidates on a planted target: ordering, unknown states, saving and loading."""

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import evaluate, models
from parcelwise.operators.features import TARGET


@pytest.fixture(scope="module")
def rows(spark):
    """Delivery days depend on the distance in steps and on the month: not linear, but learnable."""
    base = spark.range(1500).select(
        F.col("id").alias("order_id"),
        F.element_at(F.array(F.lit("SP"), F.lit("RJ"), F.lit("AM")), (F.col("id") % 3 + 1).cast("int")).alias("customer_state"),
        F.lit("SP").alias("seller_state"),
        (-30.0 + (F.col("id") * 7 % 300) / 10).alias("customer_lat"),
        F.lit(-46.0).alias("customer_lng"), F.lit(-23.0).alias("seller_lat"), F.lit(-46.0).alias("seller_lng"),
        F.lit(1).cast("bigint").alias("n_sellers"), (F.col("id") % 4 + 1).alias("n_items"),
        F.lit(10.0).alias("total_price"), F.lit(1.0).alias("total_freight"), F.lit(100.0).alias("total_weight_g"),
        F.lit(20).cast("bigint").alias("estimated_delivery_days"),
        F.timestamp_micros(F.lit(1514764800000000) + F.col("id") * 3600000000 * 5).alias("order_purchase_timestamp"),
        F.when(F.col("id") % 10 < 6, "train").when(F.col("id") % 10 < 8, "val").otherwise("test").alias("split"),
    )
    far = F.abs(F.col("customer_lat") + 23)
    days = F.when(far > 5, 20).when(far > 2, 6).otherwise(3) + F.col("n_items")
    return base.withColumn(TARGET, days.cast("bigint")).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return models.fit_candidates(rows.where("split = 'train'"), ["median", "linear_regression", "boosted_default"])


def test_ordering_of_the_candidates(rows, fitted):
    errors = evaluate.model_errors(models.predict_all(fitted, rows))
    got = {r["model"]: r for r in evaluate.compare_models(errors).collect()}
    assert got["boosted_default"]["val_mae"] < got["linear_regression"]["val_mae"] < got["median"]["val_mae"]
    assert [m for m, r in got.items() if r["is_best"]] == ["boosted_default"]
    long = evaluate.metric_rows(errors, "run")
    assert long.count() == 12 and set(long.columns) == {"run_id", "model", "split", "metric", "value"}


def test_saved_model_scores_the_same(rows, fitted, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(fitted["boosted_default"], path)
    again = models.load_model(path)
    a = models.score(fitted["boosted_default"], rows, "1").orderBy("order_id").collect()
    assert a == models.score(again, rows, "1").orderBy("order_id").collect()
    assert a[0]["model_version"] == "1" and min(r["prediction"] for r in a) >= 0


def test_unknown_state_is_all_zeros(rows, fitted):
    from pyspark.ml.functions import vector_to_array

    from parcelwise.operators.features import add_features

    encoder = models.encode(add_features(rows))
    df = encoder.transform(add_features(rows.limit(1).withColumn("customer_state", F.lit("XX"))))
    hot = df.select(vector_to_array("customer_state_hot").alias("v")).first()["v"]
    assert hot == [0.0, 0.0, 0.0]
    assert models.score(fitted["linear_regression"], rows.limit(1).withColumn("customer_state", F.lit("XX")), "1").count() == 1


def test_predictions_are_never_negative(rows, fitted):
    extreme = rows.withColumn("n_items", F.lit(-10_000).cast("bigint"))
    assert models.score(fitted["linear_regression"], extreme, "1").agg(F.min("prediction")).first()[0] == 0.0


def test_median_model_predicts_the_exact_median(rows, fitted):
    expected = rows.where("split = 'train'").agg(F.median(TARGET)).first()[0]
    assert {r["prediction"] for r in models.score(fitted["median"], rows, "1").collect()} == {expected}


def test_a_bad_table_stops_training(spark, small, monkeypatch):
    """One bad row in the order table ends the job before a model is fitted."""
    from parcelwise.operators.contract import ContractError
    from parcelwise.plans import queries

    good = queries.stored_order_table(spark, small)
    bad = good.withColumn("n_items", F.when(F.col("order_id") == good.first()["order_id"], 0).otherwise(F.col("n_items")))
    monkeypatch.setattr(queries, "stored_order_table", lambda *_: bad)
    with pytest.raises(ContractError, match="n_items: range"):
        queries.QUERIES["model_compare"](spark, small)


def test_the_comparison_fits_every_candidate(spark, small, rows, monkeypatch):
    """All four are fitted and scored, at few rounds here; the set numbers of rounds are those of the candidates."""
    from parcelwise.plans import queries

    set_to = {n: (s.getMaxIter(), s.getStepSize(), s.getMaxDepth()) for n in ("boosted_default", "boosted_bigger") for s in [models.CANDIDATES[n](rows)]}
    assert set_to == {"boosted_default": (100, 0.1, 5), "boosted_bigger": (300, 0.05, 6)}
    few = {"boosted_default": models.boosted_stage(2, 0.1, 2), "boosted_bigger": models.boosted_stage(6, 0.1, 6)}
    monkeypatch.setattr(models, "CANDIDATES", {**models.CANDIDATES, **few})
    monkeypatch.setattr(queries, "_model_rows", lambda *_: rows)
    got = {r["model"]: r for r in queries.QUERIES["model_compare"](spark, small).collect()}
    assert set(got) == {"median", "linear_regression", "boosted_default", "boosted_bigger"}
    assert all(r[f"{part}_{c}"] is not None for r in got.values() for part in ("val", "test") for c in ("mae", "rmse"))
    assert [m for m, r in got.items() if r["is_best"]] == ["boosted_bigger"]


def test_an_empty_training_table_is_an_error(spark):
    empty = spark.createDataFrame([], "delivery_days double")
    with pytest.raises(ValueError, match="no row with a target"):
        models.median_stage(empty)
