"""Errors of predictions, baselines, choice of the best candidate and the promotion gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import percentiles
from parcelwise.functions.scalar import floor_at_zero
from parcelwise.operators.features import TARGET
from parcelwise.session import cut_lineage

# Fixed values.
MIN_IMPROVEMENT = 0.05
GATE_MAX_P95_MS = 200
VAL, TEST = "val", "test"


def mae(target: Column | str = TARGET, prediction: Column | str = "prediction") -> Column:
    target = F.col(target) if isinstance(target, str) else target
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.avg(F.abs(prediction - target))


def rmse(target: Column | str = TARGET, prediction: Column | str = "prediction") -> Column:
    target = F.col(target) if isinstance(target, str) else target
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.sqrt(F.avg(F.pow(prediction - target, F.lit(2.0))))


def estimate_mae(split: DataFrame) -> DataFrame:
    """Error of the shop's own estimate, per split."""
    return split.groupBy("split").agg(F.count("*").alias("n"), mae(prediction="estimated_delivery_days").alias("mae"))


def train_median(split: DataFrame) -> Column:
    """Exact median target of the training rows, as a scalar subquery over a written one-row table."""
    found = percentiles(split.where(F.col("split") == "train"), TARGET, {"median": 0.5})
    return cut_lineage(found, "train-median").scalar()


def median_mae(split: DataFrame) -> DataFrame:
    """Error of always guessing the training median, on validation and test rows."""
    held_out = split.where(F.col("split").isin(VAL, TEST)).withColumn("prediction", train_median(split))
    return held_out.groupBy("split").agg(
        F.count("*").alias("n"), F.max("prediction").alias("median_days"), mae().alias("mae"), rmse().alias("rmse")
    )


def model_errors(predictions: DataFrame) -> DataFrame:
    """MAE and RMSE per model and split from a long table of predictions."""
    return predictions.groupBy("model", "split").agg(F.count("*").alias("n"), mae().alias("mae"), rmse().alias("rmse"))


def compare_models(errors: DataFrame) -> DataFrame:
    """One row per model; the lowest validation error is best. Test errors never choose."""
    at = lambda split, c: F.max(F.when(F.col("split") == split, F.col(c))).alias(f"{split}_{c}")
    wide = errors.groupBy("model").agg(at(VAL, "mae"), at(VAL, "rmse"), at(TEST, "mae"), at(TEST, "rmse"))
    best = wide.agg(F.min_by("model", F.struct("val_mae", "model"))).scalar()
    return wide.withColumn("is_best", F.col("model") == best)


def metric_rows(errors: DataFrame, run_id: str) -> DataFrame:
    """Errors as a long table of run metrics, ready to be appended."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mae", "rmse")]
    return errors.select(F.lit(run_id).alias("run_id"), "model", "split", F.inline(F.array(*cells)))


def promotion_gate(maes: DataFrame) -> DataFrame:
    """Judge a challenger on the test rows all models were scored on.

    Input: one row with ``new_mae``, ``baseline_mae``, ``champion_mae`` (null when there is no
    champion yet) and, if it is judged, ``p95_ms``. The challenger has to beat the baseline, stay below
    the latency limit, and be at least 5 % better than the champion.
    """
    new, base, old = F.col("new_mae"), F.col("baseline_mae"), F.col("champion_mae")
    checked = maes.withColumns({
        "beats_baseline": F.coalesce(new < base, F.lit(False)),
        "improves_enough": old.isNull() | F.coalesce(new <= old * (1 - MIN_IMPROVEMENT), F.lit(False)),
    })
    fails = [
        F.when(~F.col("beats_baseline"), F.format_string("error %.3f is not below the baseline's %.3f", new, base)),
        F.when(
            ~F.col("improves_enough"),
            F.format_string(f"error %.3f is not {MIN_IMPROVEMENT * 100:g} in 100 below the current model's %.3f", new, old),
        ),
    ]
    passed = F.col("beats_baseline") & F.col("improves_enough")
    if "p95_ms" in maes.columns:
        slow = F.col("p95_ms") >= GATE_MAX_P95_MS
        fails.insert(1, F.when(slow, F.format_string(f"answers take %.1f ms, allowed less than {GATE_MAX_P95_MS}", F.col("p95_ms"))))
        passed = passed & F.coalesce(~slow, F.lit(False))
    return checked.withColumns({"promoted": passed, "reasons": F.concat_ws("; ", *fails)})


def late_share(predictions: DataFrame) -> DataFrame:
    """Share of orders that took longer than predicted."""
    late = (F.col(TARGET) > F.col("prediction")).cast("int")
    return predictions.groupBy("split").agg(F.count("*").alias("n"), F.avg(late).alias("late_share"))


def arrivals_by_state_day(predictions: DataFrame) -> DataFrame:
    """Parcels expected per customer state and day of arrival."""
    days = F.ceil(floor_at_zero("prediction")).cast("int")
    day = F.date_add(F.to_date("order_purchase_timestamp"), days)
    return predictions.groupBy("customer_state", day.alias("arrival_day")).agg(F.count("*").alias("n_orders"))
