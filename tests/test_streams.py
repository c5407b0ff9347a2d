"""Streams: the same results as batches, no second copy on replay, restart from the checkpoint."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import alerts, contract, service
from parcelwise.operators.contract import CONTRACT_COLUMNS
from parcelwise.streaming import jobs
from tests.test_contract import BAD_RECORDS, GOOD
from tests.test_service import SCHEMA

T0 = datetime(2024, 1, 1)


def write_lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_quarantine_routes_and_goes_on_after_a_restart(spark, tmp_path):
    rows = [GOOD, *[record for _, record, _, _ in BAD_RECORDS]]
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write_lines(source, "a.json", rows)
    run = lambda: jobs.quarantine(
        jobs.read_json_stream(spark, str(source), CONTRACT_COLUMNS), out, state
    ).awaitTermination()
    run()
    assert spark.read.parquet(f"{out}/accepted").count() == 1
    assert spark.read.parquet(f"{out}/quarantine").count() == 6
    assert spark.read.parquet(f"{out}/alerts").count() == 6
    run()  # nothing new
    assert spark.read.parquet(f"{out}/accepted").count() == 1
    write_lines(source, "b.json", [GOOD])
    run()
    assert spark.read.parquet(f"{out}/accepted").count() == 2
    assert spark.read.parquet(f"{out}/quarantine").count() == 6


def events(spark, tmp_path, copies):
    rows = [
        (T0 + timedelta(minutes=20 * i), i, 500 if i % 7 == 0 else 200, float(i % 90), "1") for i in range(400)
    ]
    df = spark.createDataFrame(rows * copies, SCHEMA)
    path = tmp_path / "events"
    df.write.parquet(str(path / "events.parquet"))
    return rows, spark.readStream.schema(df.schema).parquet(str(path / "events.parquet"))


@pytest.mark.parametrize("copies", [1, 3])
def test_windows_equal_the_batch_for_closed_days(spark, tmp_path, copies):
    """Replayed events count once. Only days that are closed at the end of the input come out."""
    rows, stream = events(spark, tmp_path, copies)
    jobs.request_metrics(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {r["window_start"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("day", F.date_trunc("day", "ts"))
    closed = rows[-1][0] - timedelta(hours=1)
    expected = {
        r["day"]: r for r in service.request_metrics(batch, ["day"]).collect() if r["day"] + timedelta(days=1) <= closed
    }
    assert set(got) == set(expected) and len(got) == 5
    for day, r in expected.items():
        assert [got[day][c] for c in ("requests_total", "errors_total", "rejected_total", "error_rate")] == [
            r[c] for c in ("requests_total", "errors_total", "rejected_total", "error_rate")
        ]
        assert got[day]["p95"] == pytest.approx(r["p95"], abs=2)


def test_alerts_for_broken_windows(spark, tmp_path):
    _, stream = events(spark, tmp_path, 1)
    jobs.alerts(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 5 and {r["title"] for r in got} == {alerts.SLO_TITLE}


def test_late_labels_are_counted_not_joined(spark, tmp_path):
    made = spark.createDataFrame([(i, T0 + timedelta(days=i), 5.0) for i in range(5)], "order_id bigint, order_purchase_timestamp timestamp, prediction double")
    arrive = [3, 60, 61, 10, None]
    told = [(i, T0 + timedelta(days=i + d), d) for i, d in enumerate(arrive) if d is not None]
    labels = spark.createDataFrame(told, "order_id bigint, delivered_at timestamp, delivery_days bigint")
    made.write.parquet(str(tmp_path / "made"))
    labels.write.parquet(str(tmp_path / "labels"))
    stream = lambda df, name: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    out = str(tmp_path / "out")
    jobs.labelled(stream(made, "made"), stream(labels, "labels"), out, str(tmp_path / "state")).awaitTermination()
    joined = spark.read.parquet(out)
    assert {r["order_id"] for r in joined.collect()} == {0, 1, 3}
    assert jobs.unjoined_labels(labels, joined).first().asDict() == {"n_labels": 4, "n_unjoined": 1}


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    from parcelwise.operators import models

    rows = spark.range(40).select(
        F.col("id").alias("order_id"),
        *[F.lit(v).alias(c) for c, v in GOOD.items() if c not in ("n_items", "order_purchase_timestamp", "total_price")],
        (F.col("id") % 5 + 1).alias("n_items"), (F.col("id") * 3.0 + 1).alias("total_price"),
        F.lit(T0).alias("order_purchase_timestamp"), (F.col("id") % 9).alias("delivery_days"),
    )
    model = models.fit_candidates(rows, ["linear_regression"])["linear_regression"]
    path = str(tmp_path / "in")
    rows.drop("delivery_days").write.json(path)
    stream = jobs.read_json_stream(spark, path, ["order_id", *CONTRACT_COLUMNS])
    jobs.scored(stream, model, "3", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {int(r["order_id"]): r["prediction"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["order_id"]: r["prediction"] for r in models.score(model, contract.check(rows), "3").collect()}
    assert got == pytest.approx(want)


def test_a_file_and_a_folder_of_files_stream_alike(spark, tmp_path):
    rows = [(T0 + timedelta(minutes=20 * i), i, 200, float(i % 90), "1") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(4).write.parquet(str(tmp_path / "many" / "events.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "one-part"))
    (tmp_path / "one").mkdir()
    (part,) = (tmp_path / "one-part").glob("part-*.parquet")
    part.rename(tmp_path / "one" / "events.parquet")
    found = []
    for name in ("many", "one"):
        out = str(tmp_path / f"{name}-out")
        stream = jobs.read_parquet_stream(spark, str(tmp_path / name), "events")
        query = jobs.request_metrics(stream, out, f"{out}-state")
        query.awaitTermination()
        assert jobs.late_rows(query) == 0
        found.append(sorted(map(tuple, spark.read.parquet(out).collect())))
    assert found[0] == found[1] and len(found[0]) == 4


def test_streaks_follow_gaps_resets_and_restarts(spark, tmp_path):
    from datetime import date

    from parcelwise.operators import drift

    errors = {1: 9, 2: 9, 3: 9, 5: 9, 6: 9, 7: 1, 8: 9, 9: 9, 10: 9, 11: 9, 13: 9}
    days = [(date(2024, 1, d), 40, float(e)) for d, e in errors.items()]
    source, out = tmp_path / "days", str(tmp_path / "runs")
    run = lambda: jobs.streaks(spark.readStream.schema(jobs.DAYS).parquet(str(source)), [5.0, 100.0], out, f"{out}-state").awaitTermination()
    # Three deliveries of days, each a run of its own that goes on from the state.
    for part in (days[:2], days[2:7], days[7:]):
        spark.createDataFrame(part, jobs.DAYS).repartition(3).write.mode("append").parquet(str(source))
        run()
    run()  # nothing new
    got = [r for r in spark.read.schema(jobs.RUNS).parquet(out).collect() if r["mae_limit"] == 5.0 and r["run"] > 0]
    assert sorted((r["day"].day, r["run"]) for r in got) == [(1, 1), (2, 2), (3, 3), (5, 1), (6, 2), (8, 1), (9, 2), (10, 3), (11, 4), (13, 1)]
    daily = spark.createDataFrame(days, jobs.DAYS)
    for limit in (5.0, 100.0):
        (row,) = [r for r in spark.read.schema(jobs.RUNS).parquet(out).groupBy("mae_limit").agg(F.max("longest").alias("s"), F.max("n_days").alias("n")).collect() if r["mae_limit"] == limit]
        want = drift.longest_streak(daily, limit).first()
        assert (row["s"], row["n"]) == (want["streak"], want["n_days"])


def test_a_run_ends_when_its_day_passes_without_one(spark, tmp_path):
    """Limits share the watermark, not their days: a late day of one limit times the other out."""
    from datetime import date

    source, out = tmp_path / "days", str(tmp_path / "runs")
    put = lambda *d: spark.createDataFrame([(date(2024, 1, x), 40, 9.0) for x in d], jobs.DAYS).coalesce(1).write.mode("append").parquet(str(source))
    run = lambda: jobs.streaks(spark.readStream.schema(jobs.DAYS).parquet(str(source)), [5.0], out, f"{out}-state").awaitTermination()
    put(1, 2)
    run()
    put(20)
    run()
    rows = sorted((r["n_days"], r["run"], r["longest"]) for r in spark.read.schema(jobs.RUNS).parquet(out).collect())
    assert rows[:2] == [(1, 1, 1), (2, 2, 2)] and rows[-1] == (3, 1, 2)


def test_unlabelled_predictions_are_released_when_the_bound_has_passed(spark, tmp_path):
    schema = "order_id bigint, order_purchase_timestamp timestamp, prediction double"
    made = spark.createDataFrame([(i, T0 + timedelta(days=i), 5.0) for i in (0, 1, 2, 100, 101)], schema)
    told = [(0, T0 + timedelta(days=4), 4), (1, T0 + timedelta(days=70), 69), (100, T0 + timedelta(days=140), 40)]
    labels = spark.createDataFrame(told, "order_id bigint, delivered_at timestamp, delivery_days bigint")
    made.write.parquet(str(tmp_path / "made"))
    labels.write.parquet(str(tmp_path / "labels"))
    stream = lambda df, name: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    out = str(tmp_path / "out")
    jobs.labelled(stream(made, "made"), stream(labels, "labels"), out, str(tmp_path / "state"), "left_outer").awaitTermination()
    got = {r["order_id"]: r["delivery_days"] for r in spark.read.parquet(out).collect()}
    # 1 was labelled too late, 2 never; 101 may still get its label.
    assert got == {0: 4, 1: None, 2: None, 100: 40}
