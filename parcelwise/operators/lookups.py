"""Customer, seller and product lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import match, medians
from parcelwise.functions.scalar import pad_zip
from parcelwise.operators.geo import LAT, LNG, ZIP
from parcelwise.session import cut_lineage

MEASURES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
COUNTS = ["product_name_length", "product_description_length", "product_photos_qty"]


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumn("customer_zip_code_prefix", pad_zip("customer_zip_code_prefix"))


def clean_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.withColumn("seller_zip_code_prefix", pad_zip("seller_zip_code_prefix"))


def fill_with_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace missing values by the exact median of the column, as a scalar subquery."""
    found = cut_lineage(medians(df, {c: c for c in columns}), "fill-medians")
    one_row = found.select(F.struct(*columns)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), one_row.getField(c)) for c in columns})


def clean_products(products: DataFrame) -> DataFrame:
    """Fix the misspelt names, fill missing texts and counts, fill missing measures with the median."""
    renamed = products.withColumnsRenamed({
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    })
    filled = renamed.fillna({"product_category_name": "unknown", **{c: 0 for c in COUNTS}})
    return fill_with_median(filled, MEASURES)


def product_weights(products: DataFrame) -> DataFrame:
    return fill_with_median(products.select("product_id", "product_weight_g"), ["product_weight_g"])


def located(lookup: DataFrame, zips: DataFrame, role: str) -> DataFrame:
    """Attach the coordinates of a lookup's zip prefix as ``{role}_lat`` and ``{role}_lng``."""
    key = f"{role}_zip_code_prefix"
    points = zips.select(F.col(ZIP).alias(key), F.col(LAT).alias(f"{role}_lat"), F.col(LNG).alias(f"{role}_lng"))
    return lookup.join(points, key, "left")


def customers_with_orders(customers: DataFrame, orders: DataFrame, zips: DataFrame) -> DataFrame:
    """Customers with their orders and the point of their zip; customers without either are kept.

    ``zips`` has one row per zip (see ``zip_points``): joining the raw points would multiply rows.
    Columns that clash get the suffix ``_order``.
    """
    base = clean_customers(customers)
    clashes = {c: f"{c}_order" for c in orders.columns if c in base.columns and c != "customer_id"}
    with_orders = base.join(orders.withColumnsRenamed(clashes), "customer_id", "left")
    located_zip = zips.withColumn("customer_zip_code_prefix", F.col(ZIP))
    return match(with_orders, located_zip, ["customer_zip_code_prefix"], "left")
