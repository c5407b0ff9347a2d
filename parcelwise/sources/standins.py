"""The raw tables, derived from star-schema test tables.

The original CSV files are not available, so each raw table is a projection of a test table that keeps
the shape and plants the irregularities the jobs have to handle: carrier dates before the purchase,
ship limits far away, zero instalments, unpadded zip prefixes, stray points, missing weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators.contract import STATE_CODES
from parcelwise.session import configure

ZIPS = 1000  # zip prefixes with points; keys run a little further, so some have none
ZIP_KEYS = 1010


def _scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _state(number: str) -> Column:
    return F.expr(f"substring('{''.join(STATE_CODES)}', CAST({number} AS INT) * 2 + 1, 2)")


def purchase_time() -> Column:
    hours = F.make_interval(hours=F.pmod("o_orderkey", F.lit(24)).cast("int"))
    return F.col("o_orderdate").cast("timestamp") + hours


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return as_orders(_scan(spark, folder, "orders"))


def as_orders(scanned: DataFrame) -> DataFrame:
    """Raw orders from a scan or a stream of the test table."""
    key = F.col("o_orderkey")
    purchase = purchase_time()
    days = lambda n: F.make_interval(days=n.cast("int"))
    month = F.month("o_orderdate")
    # Slower late in the day and late in the year, so that there is something to learn.
    travel = F.lit(3) + F.floor(F.pmod(key, F.lit(24)) / 4) + month + F.pmod(key * 13, F.lit(5))
    travel = travel + F.when(month >= 11, F.lit(8)).otherwise(F.lit(0))
    delivered = purchase + days(travel) + F.make_interval(hours=F.pmod(key, F.lit(7)).cast("int"))
    return scanned.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
        .alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        (purchase + F.make_interval(hours=F.lit(1))).alias("order_approved_at"),
        (purchase + days(F.pmod(key * 7, F.lit(10)) - 1)).alias("order_delivered_carrier_date"),
        F.when(F.pmod(key, F.lit(83)) != 0, delivered).alias("order_delivered_customer_date"),
        (F.col("o_orderdate").cast("timestamp") + days(F.pmod(key, F.lit(30)) + 10)).alias(
            "order_estimated_delivery_date"
        ),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return _scan(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 0.5).alias("freight_value"),
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return _scan(spark, folder, "events").select(
        (F.floor(F.col("event_id") / 2) * 3).cast("bigint").alias("order_id"),
        (F.pmod("event_id", F.lit(2)) + 1).alias("payment_sequential"),
        F.when(kind == "click", "credit_card")
        .when(kind == "view", "boleto")
        .when(kind == "signup", "voucher")
        .when(kind == "purchase", "debit_card")
        .otherwise("not_defined")
        .alias("payment_type"),
        F.pmod("event_id", F.lit(4)).alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _scan(spark, folder, "lineitem")
        .select(
            F.col("l_suppkey").alias("review_id"),
            F.col("l_orderkey").alias("order_id"),
            (F.pmod(F.col("l_quantity").cast("bigint"), F.lit(5)) + 1).alias("review_score"),
            F.col("l_shipdate").cast("timestamp").alias("review_creation_date"),
            F.col("l_shipdate").cast("timestamp").alias("review_answer_timestamp"),
        )
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return _scan(spark, folder, "customer").select(
        key.alias("customer_id"),
        F.floor(key / 3).cast("bigint").alias("customer_unique_id"),
        F.pmod(key, F.lit(ZIP_KEYS)).cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), F.pmod(key, F.lit(50)).cast("string")).alias("customer_city"),
        _state("c_nationkey").alias("customer_state"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return _scan(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("seller_id"),
        F.pmod(F.col("s_suppkey") * 53, F.lit(ZIP_KEYS)).cast("string").alias("seller_zip_code_prefix"),
        _state("s_nationkey").alias("seller_state"),
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    zip_no = F.pmod("l_partkey", F.lit(ZIPS))
    key = F.col("l_orderkey")
    # Whole thousandths of a degree, so that one division gives the coordinate.
    lat = F.pmod(zip_no * 37, F.lit(380)) * 100 - 33_000 + F.col("l_quantity").cast("bigint") - 25
    lng = F.pmod(zip_no * 53, F.lit(380)) * 100 - 73_000 + (F.col("l_linenumber") - 4) * 10
    lat = lat + F.when(key % 251 == 0, 60_000).when(key % 97 == 0, 5_000).otherwise(0)
    known = F.pmod(key, F.lit(499)) != 0
    city = F.concat(F.lit("city_"), F.pmod("l_suppkey", F.lit(3)).cast("string"))
    return _scan(spark, folder, "lineitem").select(
        zip_no.cast("string").alias("geolocation_zip_code_prefix"),
        F.when(known, lat / F.lit(1000.0)).alias("geolocation_lat"),
        F.when(known, lng / F.lit(1000.0)).alias("geolocation_lng"),
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("\t"), city, F.lit(" "))).otherwise(city).alias(
            "geolocation_city"
        ),
        _state(f"pmod(pmod(l_partkey, {ZIPS}), 27)").alias(
            "geolocation_state"
        ),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    size = F.col("p_size").cast("double")
    listed = F.pmod(key, F.lit(40)) != 0
    weighed = F.pmod(key, F.lit(50)) != 0
    return _scan(spark, folder, "part").select(
        key.alias("product_id"),
        F.when(listed, F.col("p_type")).alias("product_category_name"),
        F.when(listed, F.length("p_name").cast("bigint")).alias("product_name_lenght"),
        F.when(listed, (F.col("p_size") * 10).cast("bigint")).alias("product_description_lenght"),
        F.when(listed, F.pmod(key, F.lit(6))).alias("product_photos_qty"),
        F.when(weighed, size * 100.0).alias("product_weight_g"),
        F.when(weighed, size + 10.0).alias("product_length_cm"),
        F.when(weighed, size * 0.5 + 2.0).alias("product_height_cm"),
        F.when(weighed, size + 5.0).alias("product_width_cm"),
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """Requests to a prediction service: the log that the request metrics are computed from."""
    return as_request_log(_scan(spark, folder, "events"))


def as_request_log(scanned: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return scanned.select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.when(kind == "error", 500).when(kind == "signup", 422).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_id") % 3 == 0, "1").otherwise("2").alias("model_version"),
    )


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions whose outcome is known by now: purchase time, real days, predicted days."""
    return as_predictions(_scan(spark, folder, "events"))


def as_predictions(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        F.col("event_id").alias("order_id"),
        F.col("ts").cast("timestamp").alias("order_purchase_timestamp"),
        F.col("value").alias("delivery_days"),
        (F.pmod("user_id", F.lit(21)) + 30).cast("double").alias("prediction"),
    )


def uneven_prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """The same without the orders of two days, and with a day of good predictions: gaps and a reset."""
    return as_uneven(prediction_log(spark, folder))


def as_uneven(log: DataFrame) -> DataFrame:
    day = F.dayofmonth("order_purchase_timestamp")
    good = F.when(day == 14, F.col("delivery_days") + 1).otherwise(F.col("prediction"))
    return log.where(~day.isin(9, 20)).withColumn("prediction", good)


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "geolocation": geolocation,
    "products": products,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in RAW.items()}


def request_records(order_table: DataFrame) -> DataFrame:
    """Orders as requests arrive: every contract field as text, with faults planted by order id."""
    key = F.col("order_id")
    every = lambda n: F.pmod(key, F.lit(n)) == 0
    number = lambda c, kind: F.col(c).cast(kind).cast("string")
    blank = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    when = F.when(F.pmod(key, F.lit(2)) == 0, blank).otherwise(F.translate(blank, " ", "T"))
    null = F.lit(None).cast("string")
    return order_table.select(
        key,
        F.when(every(19), "XX").otherwise(F.col("customer_state")).alias("customer_state"),
        F.when(every(41), null).otherwise(F.col("seller_state")).alias("seller_state"),
        F.when(every(23), "40.0").otherwise(number("customer_lat", "decimal(9,4)")).alias("customer_lat"),
        number("customer_lng", "decimal(9,4)").alias("customer_lng"),
        number("seller_lat", "decimal(9,4)").alias("seller_lat"),
        number("seller_lng", "decimal(9,4)").alias("seller_lng"),
        F.when(every(43), "21").otherwise(F.col("n_sellers").cast("string")).alias("n_sellers"),
        F.when(every(29), "abc").otherwise(F.col("n_items").cast("string")).alias("n_items"),
        F.when(every(37), null).otherwise(number("total_price", "decimal(18,2)")).alias("total_price"),
        F.when(every(47), "-1").otherwise(number("total_freight", "decimal(18,2)")).alias("total_freight"),
        F.when(every(17), "-500.0").otherwise(number("total_weight_g", "decimal(18,2)")).alias("total_weight_g"),
        F.when(every(53), "12.5").otherwise(F.col("estimated_delivery_days").cast("string")).alias(
            "estimated_delivery_days"
        ),
        F.when(every(31), "not-a-date").otherwise(when).alias("order_purchase_timestamp"),
    )
