"""Model features; training, batch scoring and stream scoring share this one function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalar import flag, haversine_km, weekday

TARGET = "delivery_days"
CATEGORIES = ["customer_state", "seller_state"]
NUMBERS = [
    "customer_lat",
    "customer_lng",
    "seller_lat",
    "seller_lng",
    "n_sellers",
    "n_items",
    "total_price",
    "total_freight",
    "total_weight_g",
    "estimated_delivery_days",
    "distance_km",
    "same_state",
    "purchase_dow",
    "purchase_month",
    "purchase_hour",
]


def time_features(df: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Day of the week (Monday = 0), month and hour of the purchase."""
    moment = F.col(ts).cast("timestamp")
    return df.withColumns(
        {"purchase_dow": weekday(moment), "purchase_month": F.month(moment), "purchase_hour": F.hour(moment)}
    )


def add_features(df: DataFrame) -> DataFrame:
    """Distance, same-state flag and time parts from the contract columns; the timestamp itself is dropped."""
    return (
        time_features(df)
        .withColumns({
            "distance_km": haversine_km("customer_lat", "customer_lng", "seller_lat", "seller_lng"),
            "same_state": flag(F.col("customer_state") == F.col("seller_state")),
        })
        .drop("order_purchase_timestamp")
    )


def split_target(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features and target as two tables."""
    return df.drop(TARGET), df.select(TARGET)
