"""Metrics of a prediction service from its request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import match, percentiles, smallest
from parcelwise.functions.scalar import request_class

# Fixed values.
LATENCY_WINDOW = 1000
SLO_P95_MS = 200
SLO_ERROR_RATE = 0.01
LATENCY_PROBS = {"p50": 0.5, "p95": 0.95}


def last_requests(log: DataFrame, n: int = LATENCY_WINDOW) -> DataFrame:
    """The latest n requests; of the same moment the higher event id is later."""
    return smallest(log, n, -F.unix_micros("ts"), [F.desc("event_id")])


def counters() -> list[Column]:
    """Request counters by class, as aggregates."""
    kind = request_class("status")
    count = lambda name: F.coalesce(F.sum((kind == name).cast("bigint")), F.lit(0))
    return [
        F.count("*").alias("requests_total"),
        count("error").alias("errors_total"),
        count("rejected").alias("rejected_total"),
    ]


def error_rate() -> Column:
    return F.col("errors_total") / F.greatest(F.col("requests_total"), F.lit(1))


def request_metrics(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters, error rate, throughput and exact P50/P95 over the whole log, per group if asked."""
    by = list(by)
    span = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(1e6)
    totals = log.groupBy(*by).agg(*counters(), span.alias("elapsed_s")).withColumns({
        "error_rate": error_rate(),
        "throughput": F.col("requests_total") / F.nullif(F.col("elapsed_s"), F.lit(0.0)),
    })
    latency = percentiles(log, "latency_ms", LATENCY_PROBS, by)
    if by:
        return match(totals, latency, by, "left")
    both = latency.select(F.struct(*LATENCY_PROBS)).scalar()
    return totals.withColumns({p: F.coalesce(both.getField(p), F.lit(0.0)) for p in LATENCY_PROBS})


def request_metrics_approx(log: DataFrame, by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Approximate twin in one pass, with a bounded sketch for the percentiles."""
    sketch = F.percentile_approx("latency_ms", [0.5, 0.95], accuracy)
    return log.groupBy(*by).agg(*counters(), sketch.alias("p50_p95_approx")).withColumn("error_rate", error_rate())


def service_status(log: DataFrame, n: int = LATENCY_WINDOW) -> DataFrame:
    """What a status page shows: counters over the whole log, P50/P95 of the latest n requests."""
    # At most n rows, so the built-in percentile is safe here.
    recent = last_requests(log, n).agg(
        F.struct(
            F.coalesce(F.percentile("latency_ms", 0.5), F.lit(0.0)).alias("p50"),
            F.coalesce(F.percentile("latency_ms", 0.95), F.lit(0.0)).alias("p95"),
            F.count("latency_ms").alias("n"),
            F.max_by("model_version", F.struct("ts", "event_id")).alias("version"),
        )
    ).scalar()
    return log.agg(*counters()).withColumns({
        "p50": recent.getField("p50"),
        "p95": recent.getField("p95"),
        "latency_count": recent.getField("n"),
        "model_version": recent.getField("version"),
    })


def slo_broken() -> Column:
    return (F.col("p95") > SLO_P95_MS) | (F.col("error_rate") >= SLO_ERROR_RATE)


def slo_check(status: DataFrame) -> DataFrame:
    """Judge rows with ``p95`` and the counters against the service levels."""
    return status.withColumn("error_rate", error_rate()).withColumn("broken", F.coalesce(slo_broken(), F.lit(False)))
