"""Request metrics, service levels and alerts."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import alerts, contract, service
from tests.test_contract import GOOD, records

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, event_id bigint, status int, latency_ms double, model_version string"


def log(spark, n=1500):
    rows = [
        (T0 + timedelta(seconds=i), i, 500 if i % 100 == 0 else 422 if i % 10 == 1 else 200, float(i % 251), "2" if i > 900 else "1")
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_request_metrics(spark):
    rows, df = log(spark)
    r = service.request_metrics(df).first()
    assert (r["requests_total"], r["errors_total"], r["rejected_total"]) == (1500, 15, 150)
    assert r["error_rate"] == 0.01 and r["throughput"] == pytest.approx(1500 / 1499)
    latencies = [x[3] for x in rows]
    assert (r["p50"], r["p95"]) == pytest.approx((np.percentile(latencies, 50), np.percentile(latencies, 95)))
    by = {r["model_version"]: r for r in service.request_metrics(df, ["model_version"]).collect()}
    assert by["2"]["p95"] == pytest.approx(np.percentile([x[3] for x in rows if x[4] == "2"], 95))
    none = service.request_metrics(df.where("false")).first()
    assert (none["requests_total"], none["error_rate"], none["p95"]) == (0, 0.0, 0.0)


def test_status_uses_the_latest_thousand(spark):
    rows, df = log(spark)
    r = service.service_status(df).first()
    latest = [x[3] for x in rows[-1000:]]
    assert r["latency_count"] == 1000 and r["requests_total"] == 1500 and r["model_version"] == "2"
    assert (r["p50"], r["p95"]) == pytest.approx((np.percentile(latest, 50), np.percentile(latest, 95)))


@pytest.mark.parametrize("p95, errors, broken", [(200.0, 0, False), (200.1, 0, True), (10.0, 1, True), (10.0, 0, False)])
def test_service_levels(spark, p95, errors, broken):
    row = spark.createDataFrame([(p95, 100, errors, 3, "7")], "p95 double, requests_total bigint, errors_total bigint, rejected_total bigint, model_version string")
    judged = service.slo_check(row)
    assert judged.first()["broken"] is broken
    if broken:
        found = alerts.slo_alerts(judged).first()
        assert found["title"] == alerts.SLO_TITLE
        assert found["detail"] == (
            f"95 of 100 answers within {p95:.1f} ms, allowed 200; failed {errors:.2f} in 100, allowed less than 1; "
            "100 requests, 3 of them turned away; model 7"
        )


def test_rejection_alert_is_cut(spark):
    rows = [{**GOOD, "customer_state": "X" * 5000}, GOOD, {**GOOD, "n_items": "abc"}]
    checked = contract.check(records(spark, rows), payload=True)
    long, short = alerts.rejection_alerts(checked).orderBy(F.length("detail").desc()).collect()
    assert len(long["detail"]) == 700 + len(" | sent: ") + 280
    assert short["title"] == alerts.REJECTED_TITLE
    assert short["detail"].startswith('n_items: coercion (abc) | sent: {"customer_state":"SP"')


def test_drift_alert_states_the_margin_it_was_judged_by(spark):
    judged = spark.createDataFrame(
        [("total_weight_g PSI=0.008, distance_km PSI=6.937", 6.971, 3.889, 0.5, 3.389, 0, 2, "Data Drift", True),
         ("-", 3.0, 5.389, 2.0, 3.389, 0, 0, "no drift", False)],
        "psi_text string, mae double, mae_limit double, margin double, test_mae double, streak bigint, code int,"
        " verdict string, retrain boolean",
    )
    (row,) = alerts.drift_alerts(judged, "north").collect()
    assert row["title"] == "north: data drift"
    assert row["detail"] == (
        "inputs, drifted above 0.2: total_weight_g PSI=0.008, distance_km PSI=6.937; "
        "error 6.97 days against 3.39 in the test; allowed 3.89 (0.50 more); days above that in a row: 0; train a new model"
    )


def test_alerts_are_appended(spark, tmp_path):
    rows = spark.createDataFrame([("t", "d")], "title string, detail string")
    for _ in range(2):
        alerts.append_alerts(rows, str(tmp_path / "alerts"))
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 2
