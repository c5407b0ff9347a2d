"""Scans of the raw tables and of order records, and the table sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.scalar import number_or_null, parse_timestamp

# Columns and types of the raw tables. Zip prefixes are text from the scan on.
RAW_TABLES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "bigint",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp",
        "price": "double",
        "freight_value": "double",
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "bigint",
        "payment_type": "string",
        "payment_installments": "bigint",
        "payment_value": "double",
    },
    "order_reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "bigint",
        "review_creation_date": "timestamp",
        "review_answer_timestamp": "timestamp",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_state": "string",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "string",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "bigint",
        "product_description_lenght": "bigint",
        "product_photos_qty": "bigint",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

# The order table: one row per delivered order.
ORDER_COLUMNS: dict[str, str] = {
    "order_id": "string",
    "customer_id": "string",
    "customer_state": "string",
    "customer_city": "string",
    "customer_lat": "double",
    "customer_lng": "double",
    "seller_state": "string",
    "seller_lat": "double",
    "seller_lng": "double",
    "distance_km": "double",
    "n_sellers": "bigint",
    "n_items": "bigint",
    "total_price": "double",
    "total_freight": "double",
    "total_weight_g": "double",
    "order_purchase_timestamp": "timestamp",
    "order_estimated_delivery_date": "timestamp",
    "order_delivered_customer_date": "timestamp",
    "delivery_days": "bigint",
    "same_state": "int",
    "estimated_delivery_days": "bigint",
}


# What a scan keeps beside the typed columns: texts that are not of their column's type, and lines of another shape.
RESCUED, BAD_LINE = "_rescued", "_bad_line"


def read_text_csv(spark: SparkSession, path: str, multiline: bool = False, keep_lines: bool = False) -> DataFrame:
    """A CSV file with a header, every column as text; a leading byte-order mark is dropped.

    ``keep_lines`` adds ``_bad_line``: a line with too few or too many cells, whose missing cells are null.
    """
    options = {"header": True, "multiLine": multiline, "escape": '"'}
    df = spark.read.csv(path, inferSchema=False, **options)
    names = [c.lstrip("﻿") for c in df.columns]
    if not keep_lines:
        return df.toDF(*names)
    schema = ", ".join(f"`{c}` STRING" for c in (*df.columns, BAD_LINE))
    return spark.read.schema(schema).csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, **options).toDF(*names, BAD_LINE)


def typed(df: DataFrame, columns: Mapping[str, str], rescue: bool = False) -> DataFrame:
    """The named columns in their declared types; NaN and unreadable text become null.

    ``rescue`` adds ``_rescued``, a map from column to the text that could not be read (null where there is none), so that such a
    null can be told from an empty cell. Blanks and NaN count as empty.
    """
    out, cells = [], []
    for name, kind in columns.items():
        raw, text = F.col(name).try_cast(kind), F.col(name).cast("string")
        cells.append(F.struct(F.lit(name), F.when(raw.isNull() & (F.trim(text) != ""), text)))
        value = {"double": number_or_null, "timestamp": parse_timestamp}.get(kind, lambda _: raw)(name)
        out.append(value.alias(name))
    if not rescue:
        return df.select(*out)
    lost = F.filter(F.array(*cells), lambda x: x["col2"].isNotNull())
    found = F.when(F.size(lost) > 0, F.map_from_entries(lost)).alias(RESCUED)
    line = [F.col(BAD_LINE)] if BAD_LINE in df.columns else [F.lit(None).cast("string").alias(BAD_LINE)]
    return df.select(*out, found, *line)


def rescued_cells(df: DataFrame) -> DataFrame:
    """Per column how many cells a rescuing scan could not read, and the first of their texts; lines of another shape
    stand under ``_bad_line``."""
    cells = F.coalesce(RESCUED, F.create_map().cast("map<string,string>"))
    line = F.when(F.col(BAD_LINE).isNotNull(), F.create_map(F.lit(BAD_LINE), F.col(BAD_LINE)))
    both = F.map_concat(cells, F.coalesce(line, F.create_map().cast("map<string,string>")))
    return df.select(F.explode(both).alias("column", "text")).groupBy("column").agg(
        F.count("*").alias("n"), F.min("text").alias("first")
    )


def read_raw(
    spark: SparkSession,
    folder: str,
    name: str,
    pattern: str = "{name}.csv",
    columns: Sequence[str] | None = None,
    rescue: bool = False,
) -> DataFrame:
    """Scan one raw CSV table by its short name. ``columns`` prunes the scan; ``rescue`` keeps what could not be read."""
    declared = RAW_TABLES[name]
    wanted = {c: declared[c] for c in (columns or declared)}
    # Review texts hold line breaks inside quotes.
    text = read_text_csv(spark, f"{folder}/{pattern.format(name=name)}", name == "order_reviews", keep_lines=rescue)
    return typed(text, wanted, rescue)


def read_raw_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table kept as Parquet, which is what repeated runs should scan."""
    return typed(spark.read.parquet(f"{folder}/{name}"), RAW_TABLES[name])


def read_order_table(spark: SparkSession, path: str, as_text: bool = False) -> DataFrame:
    """The order table as CSV; ``as_text`` leaves the types to the data contract."""
    text = read_text_csv(spark, path)
    return text.select(*ORDER_COLUMNS) if as_text else typed(text, ORDER_COLUMNS)


def read_order_lines(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Order records as JSON lines, all fields as text, so that the contract does the coercion; files are split among tasks.

    A line that is no record stands in ``_bad_line``, its fields null.
    """
    schema = ", ".join(f"`{f}` string" for f in (*fields, BAD_LINE))
    return spark.read.schema(schema).json(path, columnNameOfCorruptRecord=BAD_LINE)


def read_order_json(spark: SparkSession, path: str, fields: Sequence[str], multiline: bool = True) -> DataFrame:
    """The same from files of one record each, which may span lines: one task per file. For many records use
    :func:`read_order_lines`."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    return spark.read.schema(schema).json(path, multiLine=multiline)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """Overwrite a result table; sorted only when asked, since a sort is one more shuffle.

    Compressed text is scanned by one task per file, so it is for tables that many tasks write.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make a set of tables known to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
