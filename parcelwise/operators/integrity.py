"""Checks on tables and joins, and the gaps between tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalar import flag


def count_repeated_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: how many key values occur more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().agg(F.coalesce(F.sum((F.col("count") > 1).cast("bigint")), F.lit(0)).alias("n"))


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.coalesce(F.sum(flag(condition).cast("bigint")), F.lit(0)).alias("n"))


def count_nulls(df: DataFrame) -> DataFrame:
    """One row: missing cells over all columns."""
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])
    return df.agg(F.coalesce(F.sum(missing), F.lit(0)).alias("n"))


def count_wrong_length(df: DataFrame, column: str, length: int) -> DataFrame:
    return count_where(df, F.length(column) != length)


def base_row_change(base: DataFrame, joined: DataFrame) -> DataFrame:
    """One row: rows the join added to (or took from) its base."""
    before = base.agg(F.count("*").alias("before"))
    return joined.agg((F.count("*") - before.scalar()).alias("n"))


def lost_keys(base: DataFrame, joined: DataFrame, key: str) -> DataFrame:
    """One row: base keys that do not appear in the joined table."""
    return base.join(joined.select(key).distinct(), key, "left_anti").agg(F.count_distinct(key).alias("n"))


def unmatched(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """One row: base rows without a partner (a missing key has none)."""
    return base.join(other.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("n"))


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """Named one-row counts as one table; a check passes when nothing was found."""
    rows = [df.select(F.lit(name).alias("check"), F.col("n").cast("bigint").alias("n")) for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows).withColumn("passes", F.col("n") == 0)


def data_gaps(item_rows: DataFrame) -> DataFrame:
    """Orders in total, without a customer point, without a seller point, with several sellers."""
    per_order = item_rows.groupBy("order_id").agg(
        F.max(flag(F.col("customer_lat").isNull())).alias("no_customer"),
        F.max(flag(F.col("seller_lat").isNull())).alias("no_seller"),
        F.count_distinct("seller_id").alias("n_sellers"),
    )
    return per_order.agg(
        F.count("*").alias("n_orders"),
        F.sum("no_customer").alias("missing_customer_point"),
        F.sum("no_seller").alias("missing_seller_point"),
        F.sum(flag(F.col("n_sellers") > 1)).alias("several_sellers"),
    )
