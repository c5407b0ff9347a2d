"""Order cleaning: items, payments and reviews per order, joined to one row per delivered order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalar import elapsed_days, flag, freight_ratio, holds, null_out

# Fixed values.
DELIVERED = "delivered"
VOUCHER = "voucher"
MAX_SHIP_LIMIT_DAYS = 60


def fix_carrier_dates(orders: DataFrame) -> DataFrame:
    """Null out carrier dates that lie before the purchase or after the delivery."""
    carrier = F.col("order_delivered_carrier_date")
    before_purchase = holds(carrier < F.col("order_purchase_timestamp"))
    after_delivery = holds(F.col("order_delivered_customer_date") < carrier)
    return null_out(orders, "order_delivered_carrier_date", before_purchase | after_delivery)


def items_per_order(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Counts, totals and the latest believable ship limit of every order that has items."""
    purchases = orders.select("order_id", "order_purchase_timestamp")
    rows = items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "shipping_limit_date"
    ).join(purchases, "order_id", "left")
    too_late = elapsed_days("order_purchase_timestamp", "shipping_limit_date") > MAX_SHIP_LIMIT_DAYS
    return (
        null_out(rows, "shipping_limit_date", too_late)
        .groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("n_items"),
            F.count_distinct("product_id").alias("n_products"),
            F.count_distinct("seller_id").alias("n_sellers"),
            F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_price"),
            F.coalesce(F.sum("freight_value"), F.lit(0.0)).alias("total_freight"),
            F.max("shipping_limit_date").alias("shipping_limit_date"),
        )
        .withColumn("freight_ratio", freight_ratio("total_freight", "total_price"))
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Totals per order and the type of the largest payment.

    Equal largest payments: the lowest sequence number wins, then the alphabetically first type.
    """
    installments = F.when(F.col("payment_installments") == 0, F.lit(1)).otherwise(F.col("payment_installments"))
    # The smallest struct is the largest known payment; missing amounts come last.
    place = F.struct(
        F.col("payment_value").isNull(), -F.col("payment_value"), F.col("payment_sequential"), F.col("payment_type")
    )
    return payments.groupBy("order_id").agg(
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_payment"),
        F.count("payment_sequential").alias("n_payments"),
        F.max(installments).alias("max_installments"),
        F.max(flag(F.col("payment_type") == VOUCHER)).alias("used_voucher"),
        F.min_by("payment_type", place).alias("main_payment_type"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score"), F.count("review_id").alias("n_reviews")
    )


def clean_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, customers: DataFrame
) -> DataFrame:
    """One row per delivered order that has a review, with the delivery time and how late it was.

    Everything keyed by order is joined first, on one partitioning; the customer lookup comes last.
    """
    fixed = fix_carrier_dates(orders)
    people = customers.select("customer_id", "customer_unique_id")
    return (
        reviews_per_order(reviews)
        .join(fixed, "order_id", "left")
        .where((F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNotNull())
        .join(items_per_order(items, orders), "order_id", "left")
        .join(payments_per_order(payments), "order_id", "left")
        .join(people, "customer_id", "left")
        .withColumns({
            "delivery_days": elapsed_days("order_purchase_timestamp", "order_delivered_customer_date"),
            "late_days": elapsed_days("order_estimated_delivery_date", "order_delivered_customer_date"),
        })
        .withColumn("is_late", flag(F.col("late_days") > 0))
    )


def delivered_orders(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """The rows of :func:`clean_orders` with only the columns the order table needs.

    Which orders are kept depends on the order itself and on whether it has a review, so neither items
    nor payments have to be read for this.
    """
    return (
        orders.where((F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNotNull())
        # distinct() uses the shuffle the join needs anyway, and an order with very many reviews becomes one row.
        .join(reviews.select("order_id").distinct(), "order_id", "left_semi")
        .select(
            "order_id",
            "customer_id",
            "order_purchase_timestamp",
            "order_estimated_delivery_date",
            "order_delivered_customer_date",
            elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias("delivery_days"),
        )
    )
