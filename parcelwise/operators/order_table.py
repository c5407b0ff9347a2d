"""Item rows and the order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalar import elapsed_days, flag, haversine_km
from parcelwise.operators.geo import zip_coordinates
from parcelwise.operators.lookups import clean_customers, clean_sellers, located, product_weights
from parcelwise.operators.orders import delivered_orders
from parcelwise.session import cut_lineage
from parcelwise.sources.tables import ORDER_COLUMNS

ORDER_FACTS = [
    "order_id",
    "customer_id",
    "order_purchase_timestamp",
    "order_estimated_delivery_date",
    "order_delivered_customer_date",
    "delivery_days",
]
CUSTOMER_FACTS = ["customer_state", "customer_city", "customer_lat", "customer_lng"]
SELLER_FACTS = ["seller_state", "seller_lat", "seller_lng"]


def item_rows(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    zips: DataFrame,
) -> DataFrame:
    """One row per item of a kept order, with customer, seller, their points and the weight."""
    buyers = located(clean_customers(customers), zips, "customer").select(
        "customer_id", "customer_zip_code_prefix", *CUSTOMER_FACTS
    )
    shops = located(clean_sellers(sellers), zips, "seller").select("seller_id", *SELLER_FACTS)
    return (
        items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
        .join(orders.select(*ORDER_FACTS), "order_id", "inner")
        .join(buyers, "customer_id", "left")
        .join(product_weights(products), "product_id", "left")
        .join(shops, "seller_id", "left")
    )


def parcels_from_items(rows: DataFrame) -> DataFrame:
    """Item rows to one row per (order, seller).

    Everything but the totals is the same for all items of an order from one seller, so these columns
    can be grouping keys, and the aggregate keeps numbers only.
    """
    return rows.groupBy(*ORDER_FACTS, *CUSTOMER_FACTS, "seller_id", *SELLER_FACTS).agg(
        F.count("order_item_id").alias("n_items"),
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.sum("product_weight_g").alias("weight"),
    )


def orders_from_parcels(parcels: DataFrame) -> DataFrame:
    """The order table: the farthest seller stands for the order, totals are over all sellers.

    Sellers at the same distance: the highest seller id stands for the order. Unknown distances lose
    against known ones. ``parcels`` has one row per order and seller, so counting rows counts sellers.
    """
    measured = parcels.withColumn(
        "distance_km", haversine_km("customer_lat", "customer_lng", "seller_lat", "seller_lng")
    )
    shop = F.struct(*SELLER_FACTS, "distance_km")
    same_for_order = [c for c in ORDER_FACTS if c != "order_id"] + CUSTOMER_FACTS
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    grouped = measured.groupBy("order_id").agg(
        F.max_by(shop, F.struct("distance_km", "seller_id")).alias("shop"),
        *[F.max(c).alias(c) for c in same_for_order],
        F.count("seller_id").alias("n_sellers"),
        F.sum("n_items").alias("n_items"),
        total("price").alias("total_price"),
        total("freight").alias("total_freight"),
        total("weight").alias("total_weight_g"),
    )
    return (
        grouped.select("*", "shop.*")
        .withColumns({
            "same_state": flag(F.col("customer_state") == F.col("seller_state")),
            "estimated_delivery_days": elapsed_days("order_purchase_timestamp", "order_estimated_delivery_date"),
        })
        .select(*ORDER_COLUMNS)
    )


def order_table_from_items(rows: DataFrame) -> DataFrame:
    return orders_from_parcels(parcels_from_items(rows))


def order_table(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    zips: DataFrame,
) -> DataFrame:
    """The order table straight from the tables, the same rows as through :func:`item_rows`.

    Items of other orders leave first, on the order id alone. The rest is summed per (order, seller) before it meets orders
    and customers, so the wide joins carry one row per parcel and an order with very many items is small by then.
    """
    buyers = located(clean_customers(customers), zips, "customer").select("customer_id", *CUSTOMER_FACTS)
    shops = located(clean_sellers(sellers), zips, "seller").select("seller_id", *SELLER_FACTS)
    sums = (
        items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
        .join(orders.select("order_id"), "order_id", "left_semi")
        .join(product_weights(products), "product_id", "left")
        .groupBy("order_id", "seller_id")
        .agg(
            F.count("order_item_id").alias("n_items"),
            F.sum("price").alias("price"),
            F.sum("freight_value").alias("freight"),
            F.sum("product_weight_g").alias("weight"),
        )
        .join(shops, "seller_id", "left")
    )
    known = orders.select(*ORDER_FACTS).join(buyers, "customer_id", "left")
    return orders_from_parcels(sums.join(known, "order_id", "inner"))


def prepare(raw: dict[str, DataFrame]) -> DataFrame:
    """Raw tables to the order table."""
    return order_table(
        raw["order_items"],
        # Joined twice, so written once.
        cut_lineage(delivered_orders(raw["orders"], raw["order_reviews"]), "kept-orders"),
        raw["customers"],
        raw["sellers"],
        raw["products"],
        zip_coordinates(raw["geolocation"]),
    )
