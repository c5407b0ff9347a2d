"""The request path as streams: validate, score, measure, alert, and join with later deliveries.

Every job reads what is there and stops (``availableNow``); drop the trigger to keep it running. Each
one owns a checkpoint folder, so a restart goes on where it stopped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parcelwise.operators.alerts import rejection_alerts, slo_alerts
from parcelwise.operators.contract import check, route
from parcelwise.operators.evaluate import mae
from parcelwise.operators.models import score
from parcelwise.operators.service import counters, error_rate, slo_check

# Deliveries may be reported this long after the purchase; later ones are counted, not joined.
LABEL_BOUND_DAYS = 60
LATENESS = "1 hour"
# Bounds a batch when a backlog is read; files come in the order of their modification.
FILES_PER_BATCH = 1000
WINDOW = "1 day"
DAYS = "day DATE, n LONG, mae DOUBLE"
RUNS = "mae_limit DOUBLE, day DATE, n_days LONG, run LONG, longest LONG"


def read_parquet_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table, a file or a folder of files, as a stream; new files in the folder are new input."""
    path = f"{folder}/{name}.parquet"
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    files = table.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}.parquet"):
        # A stream reads folders; the name picks this file.
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def read_json_stream(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Order records as JSON lines, all fields as text."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).json(path)


def late_rows(query: StreamingQuery) -> int:
    """How many rows of a finished run came after the watermark and were left out."""
    batches = [json.loads(p.json) for p in query.recentProgress]
    return sum(op.get("numRowsDroppedByWatermark", 0) for b in batches for op in b.get("stateOperators", []))


def _start(df: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).format("parquet").start(path)


def quarantine(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Check records and write ``accepted``, ``quarantine`` and ``alerts`` under ``out``.

    Each batch overwrites its own folder, so a batch that is run again leaves no second copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = batch.persist()  # three writes, one check
        try:
            accepted, rejected = route(checked)
            for name, part in (
                ("accepted", accepted),
                ("quarantine", rejected),
                ("alerts", rejection_alerts(checked)),
            ):
                part.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        finally:
            checked.unpersist()

    writer = check(records, payload=True).writeStream.foreachBatch(write).trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()


def scored(records: DataFrame, model: PipelineModel, version: str, out: str, checkpoint: str) -> StreamingQuery:
    """Score the accepted records with a fixed model; a new model means a restart."""
    accepted, _ = route(check(records))
    return _start(score(model, accepted, version), checkpoint, out)


def windowed_metrics(log: DataFrame, lateness: str = LATENESS, window: str = WINDOW) -> DataFrame:
    """Counters and P50/P95 per tumbling window; replayed events count once.

    The percentiles come from a bounded sketch: exact ones would keep every latency in the state.
    """
    once = log.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])
    sketch = F.percentile_approx("latency_ms", [0.5, 0.95], 10_000)
    grouped = once.groupBy(F.window("ts", window)).agg(
        *counters(), sketch.alias("_p"), F.max("model_version").alias("model_version")
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        "requests_total",
        "errors_total",
        "rejected_total",
        error_rate().alias("error_rate"),
        F.col("_p")[0].alias("p50"),
        F.col("_p")[1].alias("p95"),
        "model_version",
    )


def request_metrics(log: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return _start(windowed_metrics(log), checkpoint, out)


def alerts(log: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """An alert row for every closed window that breaks a service level."""
    judged = slo_check(windowed_metrics(log))

    def write(batch: DataFrame, batch_id: int) -> None:
        slo_alerts(batch, "window_start").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = judged.writeStream.outputMode("append").foreachBatch(write).trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()


def daily_errors(log: DataFrame, out: str, checkpoint: str, min_orders: int, lateness: str = LATENESS) -> StreamingQuery:
    """The error of every closed day with enough orders, from predictions whose outcome is known (``DAYS``)."""
    ts = "order_purchase_timestamp"
    days = log.withWatermark(ts, lateness).groupBy(F.window(ts, WINDOW)).agg(F.count("*").alias("n"), mae().alias("mae"))
    judged = days.where(F.col("n") >= min_orders)
    return _start(judged.select(F.to_date("window.start").alias("day"), "n", "mae"), checkpoint, out)


def _follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Judge the days that have come for a limit, in their order; a run ends with a day below, a gap, or a timeout."""
    (limit,) = key
    last, n_days, run, longest = state.get if state.exists else (date.min, 0, 0, 0)
    out = []
    if state.hasTimedOut:
        # A day has passed without one to judge, so the next one starts anew.
        run = 0
        out.append((limit, last, n_days, run, longest))
    else:
        # One row per day: a batch is never large.
        days = sorted(pair for batch in batches for pair in zip(batch["day"], batch["mae"]))
        for day, error in days:
            run = 0 if not error > limit else run + 1 if day - last == timedelta(days=1) else 1
            last, n_days, longest = day, n_days + 1, max(longest, run)
            out.append((limit, day, n_days, run, longest))
    state.update((last, n_days, run, longest))
    if not state.hasTimedOut and last > date.min:
        end = pd.Timestamp(last, tz="UTC") + pd.Timedelta(days=2)
        state.setTimeoutTimestamp(max(int(end.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["mae_limit", "day", "n_days", "run", "longest"])


def streaks(days: DataFrame, limits: Sequence[float], out: str, checkpoint: str) -> StreamingQuery:
    """Follow runs of consecutive days above each limit: after every judged day the run so far and the longest one (``RUNS``).

    ``days`` is a stream of ``DAYS`` in which later batches hold later days. The state of a limit is one row: its last day,
    how many were judged, the run and the longest run.
    """
    at = days.withColumn("closed", F.col("day").cast("timestamp")).withWatermark("closed", "0 seconds")
    each = at.select(F.explode(F.array(*[F.lit(float(x)) for x in limits])).alias("mae_limit"), "day", "mae", "closed")
    found = each.groupBy("mae_limit").applyInPandasWithState(
        _follow, RUNS, "last DATE, n_days LONG, run LONG, longest LONG", "append", GroupStateTimeout.EventTimeTimeout
    )
    return _start(found, checkpoint, out)


def labelled(predictions: DataFrame, deliveries: DataFrame, out: str, checkpoint: str, how: str = "inner") -> StreamingQuery:
    """Predictions joined with the deliveries reported within the bound.

    ``how="left_outer"`` also releases a prediction without one, once the bound has passed and its label can only be late.

    Both sides carry a watermark and the join a time bound, so the state of a prediction is dropped once
    its label can no longer arrive. The daily error is then a batch aggregate over the written rows.
    """
    left = predictions.withWatermark("order_purchase_timestamp", "1 day")
    right = deliveries.withColumnRenamed("order_id", "delivered_id").withWatermark("delivered_at", "1 day")
    bound = F.expr(
        "order_id = delivered_id AND delivered_at >= order_purchase_timestamp"
        f" AND delivered_at <= order_purchase_timestamp + INTERVAL {LABEL_BOUND_DAYS} DAYS"
    )
    return _start(left.join(right, bound, how).drop("delivered_id"), checkpoint, out)


def unjoined_labels(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """One row: how many labels were reported, and how many came too late (or for no prediction)."""
    late = labels.join(joined.select("order_id").distinct(), "order_id", "left_anti")
    return labels.agg(F.count("*").alias("n_labels"), late.agg(F.count("*")).scalar().alias("n_unjoined"))
