"""A third of all rows under one key: the big side of the join is split, the result stays whole."""

from pyspark.sql import functions as F

from parcelwise.functions.order_stats import percentiles
from parcelwise.operators import lookups, orders


def with_settings(spark, settings):
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    return old


SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_zip_is_split(spark):
    old = with_settings(spark, SETTINGS)
    try:
        people = spark.range(0, 200_000, 1, 8).select(
            F.col("id").alias("customer_id"), F.sha2(F.col("id").cast("string"), 256).alias("customer_city"),
            F.when(F.col("id") % 3 == 0, "01000").otherwise(F.lpad((F.col("id") % 5000).cast("string"), 5, "0")).alias("customer_zip_code_prefix"),
        )
        zips = spark.range(5000).select(
            F.lpad(F.col("id").cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
            F.col("id").cast("double").alias("geolocation_lat"), F.lit(1.0).alias("geolocation_lng"),
        )
        joined = lookups.located(people, zips, "customer")
        assert joined.select("customer_id", "customer_lat", "customer_city").distinct().count() == 200_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert sum(r["customer_lat"] == 1000.0 for r in rows) >= 66_667
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        with_settings(spark, old)


def test_hot_order_of_items_is_split(spark):
    old = with_settings(spark, SETTINGS)
    try:
        items = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 9000).cast("bigint").alias("order_id"),
            F.col("id").alias("order_item_id"), F.col("id").alias("product_id"), (F.col("id") % 1000).alias("seller_id"),
            F.timestamp_seconds(F.col("id")).alias("shipping_limit_date"),
            F.lit(1.0).alias("price"), F.lit(1.0).alias("freight_value"),
        )
        heads = spark.range(9000).select(
            F.col("id").alias("order_id"), F.timestamp_seconds(F.lit(0)).alias("order_purchase_timestamp")
        )
        per_order = orders.items_per_order(items, heads)
        rows = {r["order_id"]: r for r in per_order.collect()}
        assert sum(r["n_items"] for r in rows.values()) == 300_000
        assert rows[7]["n_items"] >= 100_000 and rows[7]["n_sellers"] == 1000
        assert "skew=true" in per_order._jdf.queryExecution().executedPlan().toString()
    finally:
        with_settings(spark, old)


def test_percentiles_of_a_hot_group(spark):
    """A third of all rows in one group: only rows in buckets that hold a rank are counted by value."""
    df = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("zip"),
        F.pmod(F.col("id") * 7919, F.lit(100_003)).cast("double").alias("x"),
    )
    got = {r["zip"]: (r["m"], r["p"]) for r in percentiles(df, "x", {"m": 0.5, "p": 0.95}, ["zip"]).collect()}
    rows = df.groupBy("zip").agg(F.percentile("x", 0.5).alias("m"), F.percentile("x", 0.95).alias("p")).collect()
    want = {r["zip"]: (r["m"], r["p"]) for r in rows}
    assert len(got) == len(want) == 1001
    assert all(abs(got[k][i] - want[k][i]) < 1e-9 for k in want for i in (0, 1))
