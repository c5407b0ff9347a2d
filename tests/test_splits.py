import hashlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import explore, splits


def place(key, seed="42"):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:15], 16)


def orders(spark, n, step):
    t0 = datetime(2018, 1, 1)
    rows = [(f"o{i}", t0 + timedelta(hours=step(i))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "order_id string, order_purchase_timestamp timestamp")


@pytest.mark.parametrize("n", [1, 2, 20, 333])
@pytest.mark.parametrize("name, step", [("spread", lambda i: i * 7 % 100), ("hot", lambda i: 0 if i % 3 else i)])
def test_time_split_is_exact(spark, n, name, step):
    rows, df = orders(spark, n, step)
    ordered = [o for o, _ in sorted(rows, key=lambda r: (r[1], place(r[0])))]
    i, j = int(n * 0.70), int(n * 0.85)
    expected = {o: "train" if k < i else "val" if k < j else "test" for k, o in enumerate(ordered)}
    got = {r["order_id"]: r["split"] for r in splits.time_split(df.repartition(3)).collect()}
    assert got == expected


def test_published_cuts():
    n = 95_824 - 503
    i, j = int(n * 0.70), int(n * 0.85)
    assert (i, j - i, n - j) == (66_724, 14_298, 14_299)


def test_time_split_does_not_move_rows(spark):
    _, df = orders(spark, 50, lambda i: i)
    plan = splits.time_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_time_filters_reach_the_scan(spark, tmp_path):
    _, df = orders(spark, 50, lambda i: i)
    df.write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # print all pushed filters
    parts = splits.time_parts(spark.read.parquet(str(tmp_path / "t")))
    for name in ("train", "val", "test"):
        part = parts[name]
        plan = part._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert ("LessThan" in pushed) == (name != "test")
        assert ("GreaterThan" in pushed) == (name != "train")


def test_parts_equal_labels(spark):
    _, df = orders(spark, 100, lambda i: 0 if i % 3 else i)
    labels = {r["order_id"]: r["split"] for r in splits.time_split(df).collect()}
    for name, part in splits.time_parts(df).items():
        assert {r["order_id"] for r in part.collect()} == {o for o, s in labels.items() if s == name}


def test_group_split_keeps_groups_together(spark):
    df = spark.createDataFrame([(i, i % 37) for i in range(500)], "order_id bigint, person bigint")
    split = splits.group_split(df, "person")
    assert splits.split_overlap(split, "person").first()["n_shared"] == 0
    test = {r["person"] for r in split.where("split = 'test'").collect()}
    assert test == set(sorted(range(37), key=place)[:8])  # 20 % of 37, rounded up


def test_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "order_id")
    first = explore.sample_rows(df.repartition(7), 50, "order_id").collect()
    again = explore.sample_rows(df.coalesce(1), 50, "order_id").collect()
    assert first == again and len(first) == 50
    assert {r["order_id"] for r in first} == set(sorted(range(1000), key=place)[:50])


def test_sale_week_includes_both_days(spark):
    rows = [("a", "2017-11-19 23:59:59"), ("b", "2017-11-20 00:00:00"), ("c", "2017-11-27 23:59:59"), ("d", "2017-11-28 00:00:00")]
    df = spark.createDataFrame(rows, "id string, t string").withColumn("order_purchase_timestamp", F.to_timestamp("t"))
    assert [r["id"] for r in splits.sale_week_orders(df).orderBy("id").collect()] == ["b", "c"]


def test_rows_that_cannot_be_placed_stay(spark):
    rows = [("a", datetime(2018, 1, 1), 1), ("b", None, None), ("c", datetime(2018, 1, 2), 2)]
    df = spark.createDataFrame(rows, "order_id string, order_purchase_timestamp timestamp, person bigint")
    by_time = {r["order_id"]: r["split"] for r in splits.time_split(df).collect()}
    assert by_time["b"] == splits.UNPLACED and len(by_time) == 3
    assert [r["order_id"] for r in splits.time_parts(df)[splits.UNPLACED].collect()] == ["b"]
    by_person = {r["order_id"]: r["split"] for r in splits.group_split(df, "person").collect()}
    assert by_person["b"] == splits.UNPLACED and len(by_person) == 3


def test_only_about_n_rows_reach_the_limit(spark):
    """The bound found from bucket counts filters the rows in the tasks that read them."""
    df = spark.range(0, 100_000, 1, 50).withColumnRenamed("id", "order_id")
    sample = explore.sample_rows(df, 50, "order_id")
    rows = sample.collect()
    assert {r["order_id"] for r in rows} == set(sorted(range(100_000), key=place)[:50])
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
