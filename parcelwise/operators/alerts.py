"""Alerts as rows of a table: a title and a detail of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalar import squeeze
from parcelwise.operators.contract import is_valid, reasons
from parcelwise.operators.drift import NO_DRIFT, PSI_LIMIT
from parcelwise.operators.service import SLO_ERROR_RATE, SLO_P95_MS
from parcelwise.sources import kept

# Fixed values.
DETAIL_CHARS = 1000
REASON_CHARS = 700
PAYLOAD_CHARS = 280
REJECTED_TITLE = "Request turned away"
SLO_TITLE = "Service outside its limits"
ALERT = "title STRING, detail STRING"


def alert(title: Column, detail: Column) -> list[Column]:
    return [title.alias("title"), F.substring(detail, 1, DETAIL_CHARS).alias("detail")]


def drift_alerts(judged: DataFrame, name: str | Column) -> DataFrame:
    """An alert for every verdict row that is not clean; input as made by ``drift.monitor`` or ``profile.monitored``."""
    name = F.lit(name) if isinstance(name, str) else name
    advice = F.when(F.col("retrain"), "train a new model").otherwise("keep watching")
    detail = F.concat_ws(
        "; ",
        F.concat(F.lit(f"inputs, drifted above {PSI_LIMIT}: "), F.col("psi_text")),
        F.format_string("error %.2f days against %.2f in the test", *[F.round(c, 2) for c in ("mae", "test_mae")]),
        F.format_string("allowed %.2f (%.2f more)", F.round("mae_limit", 2), "margin"),
        F.format_string("days above that in a row: %d", "streak"),
        advice,
    )
    title = F.concat(name, F.lit(": "), F.lower("verdict"))
    return judged.where(F.col("code") != NO_DRIFT).select(*alert(title, detail))


def slo_detail() -> Column:
    return F.concat_ws(
        "; ",
        F.format_string(f"95 of 100 answers within %.1f ms, allowed {SLO_P95_MS}", F.round("p95", 1)),
        F.format_string(f"failed %.2f in 100, allowed less than {SLO_ERROR_RATE * 100:g}", F.round(F.col("error_rate") * 100, 2)),
        F.format_string("%d requests, %d of them turned away", "requests_total", "rejected_total"),
        F.concat(F.lit("model "), F.col("model_version")),
    )


def slo_alerts(judged: DataFrame, *keep: str) -> DataFrame:
    return judged.where("broken").select(*keep, *alert(F.lit(SLO_TITLE), slo_detail()))


def rejection_alerts(checked: DataFrame, *keep: str) -> DataFrame:
    """An alert per rejected row: its reasons and the start of its payload.

    The reasons are cut first, so a long list cannot push the payload out of the text. Input as made by
    ``contract.check(..., payload=True)``.
    """
    detail = F.concat(
        F.substring(squeeze(reasons()), 1, REASON_CHARS), F.lit(" | sent: "), F.substring("payload", 1, PAYLOAD_CHARS)
    )
    return checked.where(~is_valid()).select(*keep, *alert(F.lit(REJECTED_TITLE), detail))


def append_alerts(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("append").parquet(path)


def keep_alerts(alerts: DataFrame, path: str, run_id: str) -> None:
    """The alerts of a run; a run again replaces its own."""
    kept.keep(alerts, path, run_id)
