"""The registered queries: every operator, run over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions import scalar
from parcelwise.operators import (
    alerts,
    contract,
    drift,
    evaluate,
    explore,
    geo,
    integrity,
    lookups,
    models,
    order_table,
    orders,
    profile,
    runs,
    service,
    sketches,
    splits,
)
from parcelwise.operators.features import CATEGORIES, NUMBERS, TARGET, add_features, time_features
from parcelwise.operators.registry import Registry, judge
from parcelwise.plans.stored import stored_order_table, stored_reference, stored_split
from parcelwise.session import configure, cut_lineage, new_path
from parcelwise.sources import kept, standins
from parcelwise.sources.tables import read_raw, rescued_cells, write_table
from parcelwise.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The sale week of the stand-in tables, whose orders are from 1995 to 2001.
SALE_WEEK = ("1997-11-20", "1997-11-27")
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
DRIFT_COLUMNS = [*drift.DECIDING_COLUMNS, *drift.INFO_COLUMNS]
DESCRIBED = ["distance_km", "total_price", "total_freight", "total_weight_g", "delivery_days"]
DIGITS = 4


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        return present(fn(spark, folder))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def present(df: DataFrame) -> DataFrame:
    """Result columns in a form that other engines print the same way: whole numbers as BIGINT, doubles
    rounded, times and dates as text."""
    out: list[Column] = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.DoubleType):
            # Adding zero turns a rounded -0.0 into 0.0.
            value = F.round(value, DIGITS) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        out.append(value.alias(field.name))
    return df.select(*out)


def _raw(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [standins.RAW[n](spark, folder) for n in names]


def _located(spark: SparkSession, folder: str) -> DataFrame:
    """The order table without the orders that have no coordinates."""
    return contract.drop_unlocated(stored_order_table(spark, folder))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.time_split(_located(spark, folder))


def _parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return splits.time_parts(_located(spark, folder))


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    names = ("orders", "order_items", "order_payments", "order_reviews", "customers")
    return orders.clean_orders(*_raw(spark, folder, *names))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return standins.request_records(stored_order_table(spark, folder))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    raw = standins.raw_tables(spark, folder)
    return order_table.item_rows(
        raw["order_items"],
        orders.delivered_orders(raw["orders"], raw["order_reviews"]),
        raw["customers"],
        raw["sellers"],
        raw["products"],
        geo.zip_coordinates(raw["geolocation"]),
    )


# --- orders, geolocation, lookups -----------------------------------------------------------------


@query
def order_level(spark, folder):
    """Raw tables to the order table."""
    return order_table.prepare(standins.raw_tables(spark, folder))


@query
def order_level_csv(spark, folder):
    """The same from CSV files: the raw tables are written as text, scanned with their declared types, and prepared.

    The files are compressed, a file per task that scans the source: as plain text they are about ten times their Parquet.
    """
    path = new_path(spark, "raw-csv")
    names = ("orders", "order_items", "order_reviews", "customers", "sellers", "products", "geolocation")
    for name in names:
        raw = standins.RAW[name](spark, folder)
        # Ids are text of one width there, so that they keep their order.
        ids = [c for c in ("order_id", "customer_id", "product_id", "seller_id") if c in raw.columns]
        wide = raw.withColumns({c: F.lpad(F.col(c).cast("string"), 12, "0") for c in ids})
        write_table(wide, f"{path}/{name}.csv", "csv", compression="lz4")
    table = order_table.prepare({name: read_raw(spark, path, name) for name in names})
    return table.withColumns({c: F.col(c).cast("bigint") for c in ("order_id", "customer_id")})


@query
def rescued_items(spark, folder):
    """The items as CSV with planted cells of another type: how many the scan of each column kept, beside all rows."""
    (items,) = _raw(spark, folder, "order_items")
    key = F.col("order_id")
    text = items.withColumns({
        "price": F.when(key % 97 == 0, "n/a").when(key % 89 == 0, " ").otherwise(F.col("price").cast("string")),
        "shipping_limit_date": F.when(key % 83 == 0, F.concat(F.lit("day "), key.cast("string"))).otherwise(
            F.date_format("shipping_limit_date", "yyyy-MM-dd HH:mm:ss")
        ),
        "order_item_id": F.when(key % 79 == 0, F.lit("1.5")).otherwise(F.col("order_item_id").cast("string")),
    })
    path = new_path(spark, "rescued")
    write_table(text, f"{path}/order_items.csv", "csv")
    read = read_raw(spark, path, "order_items", rescue=True)
    rows = read.agg(
        F.lit("all rows").alias("column"), F.count("*").alias("n"), F.sum(F.col("price").isNull().cast("bigint")).cast("string").alias("first")
    )
    return rescued_cells(read).unionByName(rows)


@query
def item_level(spark, folder):
    return _items(spark, folder)


@query
def order_clean(spark, folder):
    return _cleaned(spark, folder)


@query
def items_agg(spark, folder):
    items, heads = _raw(spark, folder, "order_items", "orders")
    return orders.items_per_order(items, heads)


@query
def payments_agg(spark, folder):
    return orders.payments_per_order(*_raw(spark, folder, "order_payments"))


@query
def review_agg(spark, folder):
    return orders.reviews_per_order(*_raw(spark, folder, "order_reviews"))


@query
def zip_normalize(spark, folder):
    points = geo.normalize_zip(*_raw(spark, folder, "geolocation"))
    return points.groupBy(geo.ZIP, geo.CITY).agg(F.count("*").alias("n"))


@query
def geo_clean(spark, folder):
    return geo.clean_points(*_raw(spark, folder, "geolocation"))


@query
def geo_flags(spark, folder):
    return geo.flag_points(*_raw(spark, folder, "geolocation"))


@query
def geo_outliers(spark, folder):
    """The points that cleaning removes."""
    return geo.flag_points(*_raw(spark, folder, "geolocation")).where("is_coord_outlier")


@query
def geo_agg(spark, folder):
    return geo.zip_points(geo.clean_points(*_raw(spark, folder, "geolocation")))


@query
def product_clean(spark, folder):
    return lookups.clean_products(*_raw(spark, folder, "products"))


@query
def customer_order_geo(spark, folder):
    people, heads, reviews, points = _raw(spark, folder, "customers", "orders", "order_reviews", "geolocation")
    kept = orders.delivered_orders(heads, reviews)
    return lookups.customers_with_orders(people, kept, geo.zip_points(geo.clean_points(points)))


@query
def customer_order_clash(spark, folder):
    """The same with orders that carry a city and a state of their own, as sent with the order: they get the suffix."""
    people, heads, reviews, points = _raw(spark, folder, "customers", "orders", "order_reviews", "geolocation")
    sent = {"customer_city": F.concat(F.lit("sent "), F.col("order_id")), "customer_state": F.lit("XX")}
    kept_orders = orders.delivered_orders(heads, reviews).withColumns(sent)
    found = lookups.customers_with_orders(people, kept_orders, geo.zip_points(geo.clean_points(points)))
    return found.select("customer_id", "order_id", "customer_city", "customer_state", "customer_city_order", "customer_state_order")


@query
def rejection_texts(spark, folder):
    """Reasons of rejected requests whose bad cells hold runs of blanks: each run is one blank in the alert."""
    torn = F.when(F.col("n_items") == "abc", "a \t b\n\n  c ").otherwise(F.col("n_items"))
    checked = contract.check(_requests(spark, folder).withColumn("n_items", torn), payload=True)
    found = alerts.rejection_alerts(checked, "order_id").where(F.col("detail").contains("n_items: coercion"))
    reason = F.regexp_extract("detail", r"n_items: coercion \(([^)]*)\)", 1)
    return found.groupBy(reason.alias("value")).agg(F.count("*").alias("n"))


@query
def data_gaps(spark, folder):
    return integrity.data_gaps(_items(spark, folder))


@query
def integrity_checks(spark, folder):
    heads, people, shops, goods, points = _raw(spark, folder, "orders", "customers", "sellers", "products", "geolocation")
    tidy = geo.normalize_zip(points)
    zips = geo.zip_points(geo.clean_points(points))
    buyers = lookups.clean_customers(people)
    placed = lookups.located(buyers, zips, "customer")
    return integrity.report({
        "order_id_repeated": integrity.count_repeated_keys(heads, "order_id"),
        "customer_id_repeated": integrity.count_repeated_keys(people, "customer_id"),
        "zip_repeated": integrity.count_repeated_keys(zips, geo.ZIP),
        "customer_zip_length": integrity.count_wrong_length(buyers, "customer_zip_code_prefix", 5),
        "seller_zip_length": integrity.count_wrong_length(lookups.clean_sellers(shops), "seller_zip_code_prefix", 5),
        "point_zip_length": integrity.count_wrong_length(tidy, geo.ZIP, 5),
        "product_nulls": integrity.count_nulls(lookups.clean_products(goods)),
        "join_changed_rows": integrity.base_row_change(buyers, placed),
        "join_lost_customers": integrity.lost_keys(buyers, placed, "customer_id"),
        "customers_without_order": integrity.unmatched(people, heads, "customer_id"),
        "customers_without_point": integrity.count_where(placed, F.col("customer_lat").isNull()),
    })


# --- scalar functions -------------------------------------------------------------------------------


@query
def haversine(spark, folder):
    df = stored_order_table(spark, folder)
    km = scalar.haversine_km("customer_lat", "customer_lng", "seller_lat", "seller_lng")
    return df.select("order_id", km.alias("km"))


@query
def elapsed_days(spark, folder):
    (heads,) = _raw(spark, folder, "orders")
    days = lambda a, b: scalar.elapsed_days(f"order_{a}", f"order_{b}")
    return heads.select(
        "order_id",
        days("purchase_timestamp", "delivered_customer_date").alias("delivery_days"),
        days("purchase_timestamp", "delivered_carrier_date").alias("carrier_days"),
        days("estimated_delivery_date", "delivered_customer_date").alias("late_days"),
    )


@query
def time_parts(spark, folder):
    (heads,) = _raw(spark, folder, "orders")
    parts = time_features(heads.select("order_id", "order_purchase_timestamp"))
    return parts.withColumn("month_start", explore.month_of("order_purchase_timestamp"))


QUERIES["time_features"] = QUERIES.pop("time_parts")


# --- data contract ----------------------------------------------------------------------------------


@query
def validate_rules(spark, folder):
    return contract.violation_rows(contract.check(_requests(spark, folder)), "order_id")


@query
def validate_form_input(spark, folder):
    """State codes as typed into a form: blanks around them, small letters."""
    typed = _requests(spark, folder).withColumns({
        c: F.concat(F.lit(" "), F.lower(c), F.lit("\t")) for c in ("customer_state", "seller_state")
    })
    return contract.violation_counts(contract.check(typed, form_input=True))


@query
def validate_summary(spark, folder):
    return contract.violation_counts(contract.check(_requests(spark, folder)))


@query
def validate_verdict(spark, folder):
    """Whole-table verdict of the order table, of the segments, and of the faulty requests."""
    table = _located(spark, folder)
    parts = {
        "order_table": table,
        "north": splits.north_orders(table),
        "sale_week": splits.sale_week_orders(table, *SALE_WEEK),
        "requests": _requests(spark, folder),
    }
    verdicts = [contract.table_verdict(contract.check(df)).withColumn("part", F.lit(n)) for n, df in parts.items()]
    return reduce(DataFrame.unionByName, verdicts)


@query
def quarantine(spark, folder):
    checked = contract.check(_requests(spark, folder))
    accepted, rejected = contract.route(checked)
    return (
        accepted.select("order_id", F.lit(200).alias("status"), F.lit("").alias("reasons"))
        .unionByName(rejected.select("order_id", F.lit(422).alias("status"), contract.reasons().alias("reasons")))
    )


@query
def accepted_rows(spark, folder):
    """Accepted requests in their declared types, without any column outside the contract but the id."""
    accepted, _ = contract.route(contract.check(_requests(spark, folder)))
    return contract.contract_only(accepted, keep=("order_id",))


@query
def planted_faults(spark, folder):
    rows = explore.sample_rows(_located(spark, folder), 50, "order_id")
    number = "row_number() OVER (ORDER BY place, order_id) - 1 AS row_no"
    numbered = rows.withColumn("place", scalar.hash_key("order_id")).selectExpr("*", number)
    return contract.violation_rows(contract.check(contract.plant_faults(numbered, "row_no")), "row_no")


# --- profiling and exploration ----------------------------------------------------------------------


@query
def profile_tables(spark, folder):
    return explore.profile_tables(standins.raw_tables(spark, folder))


@query
def profile_columns(spark, folder):
    parts = [
        explore.profile_columns(df).withColumn("table_name", F.lit(name))
        for name, df in standins.raw_tables(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def profile_columns_approx(spark, folder):
    return explore.profile_columns_approx(*_raw(spark, folder, "customers"))


@query
def describe_numeric(spark, folder):
    return explore.describe_numeric(stored_order_table(spark, folder), DESCRIBED)


@query
def describe_tables(spark, folder):
    """All numeric columns of all raw tables."""
    return explore.describe_tables(standins.raw_tables(spark, folder))


@query
def describe_numeric_approx(spark, folder):
    return explore.describe_numeric_approx(stored_order_table(spark, folder), DESCRIBED)


@query
def describe_text(spark, folder):
    parts = []
    for name, df in standins.raw_tables(spark, folder).items():
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if columns:
            parts.append(explore.describe_text(df, columns).withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query
def value_counts(spark, folder):
    return explore.value_counts(_cleaned(spark, folder), "main_payment_type")


@query
def score_counts(spark, folder):
    return explore.rounded_score_counts(_cleaned(spark, folder))


@query
def status_counts(spark, folder):
    return explore.value_counts(_raw(spark, folder, "orders")[0], "order_status")


@query
def duplicate_rows(spark, folder):
    return explore.duplicate_rows(geo.normalize_zip(*_raw(spark, folder, "geolocation")))


@query
def repeat_customers(spark, folder):
    """The ten people with the most orders behind them, by distinct ids."""
    (heads,) = _raw(spark, folder, "orders")
    ids = heads.select(F.col("customer_id").alias("customer_unique_id"), F.col("order_id").alias("customer_id"))
    return explore.repeat_customers(ids)


@query
def dataset_fingerprint(spark, folder):
    """All columns of all tables, numbers in fixed notation and times in one format."""
    parts = []
    for name, df in standins.raw_tables(spark, folder).items():
        cells = []
        for f in df.schema.fields:
            value = F.col(f.name)
            if isinstance(f.dataType, T.DoubleType):
                value = F.format_string("%.4f", value)
            elif isinstance(f.dataType, T.TimestampType):
                value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
            cells.append(F.when(F.col(f.name).isNotNull(), value.cast("string")).alias(f.name))
        parts.append(explore.fingerprint(df.select(*cells), name))
    return reduce(DataFrame.unionByName, parts)


@query
def order_satisfaction(spark, folder):
    labelled = explore.label_orders(_cleaned(spark, folder))
    return labelled.select("order_id", "review_score", "label", "late_days", "is_late", "late_bin")


@query
def satisfaction_share(spark, folder):
    return explore.satisfaction_shares(_cleaned(spark, folder))


@query
def score_by_group(spark, folder):
    cleaned = _cleaned(spark, folder)
    late = explore.score_by_lateness(cleaned).withColumnRenamed("is_late", "name").withColumn("grouping", F.lit("is_late"))
    items = explore.score_by_items(cleaned).withColumnRenamed("n_items_group", "name")
    late = late.withColumn("name", F.col("name").cast("string"))
    return late.unionByName(items.withColumn("grouping", F.lit("n_items")))


@query
def score_by_late_bin(spark, folder):
    return explore.score_by_late_bin(_cleaned(spark, folder))


@query
def monthly_pivot(spark, folder):
    return explore.monthly_payment_types(_cleaned(spark, folder), PAYMENT_TYPES)


@query
def monthly_orders(spark, folder):
    return explore.monthly_orders(_cleaned(spark, folder))


@query
def monthly_pivot_thin(spark, folder):
    """The same with months of ten orders kept."""
    return explore.monthly_payment_types(_cleaned(spark, folder), PAYMENT_TYPES, min_orders=10)


@query
def monthly_orders_thin(spark, folder):
    """The same with months of fifty orders kept."""
    return explore.monthly_orders(_cleaned(spark, folder), min_orders=50)


@query
def histogram_trimmed(spark, folder):
    return explore.integer_histogram(stored_order_table(spark, folder), "delivery_days")


@query
def histogram_equal(spark, folder):
    ratio = _cleaned(spark, folder).select("freight_ratio")
    return explore.trimmed_histogram(ratio, "freight_ratio")


@query
def histogram_log(spark, folder):
    return explore.log_histogram(stored_order_table(spark, folder), "total_price")


@query
def segment_summary(spark, folder):
    table = _located(spark, folder)
    segment = F.when(splits.in_north(), "north").when(splits.in_days(*SALE_WEEK), "sale_week").otherwise("rest")
    return explore.segment_summary(table, segment)


@query
def satisfaction_confusion(spark, folder):
    """Confusion of the real label with the label of a score guessed from the lateness."""
    guess = scalar.clip_score(F.lit(4.5) - F.col("late_days") / F.lit(10.0))
    cleaned = _cleaned(spark, folder)
    return explore.confusion(cleaned, scalar.satisfaction("review_score"), scalar.satisfaction(guess))


@query
def satisfaction_recall(spark, folder):
    guess = scalar.clip_score(F.lit(4.5) - F.col("late_days") / F.lit(10.0))
    cleaned = _cleaned(spark, folder)
    counts = explore.confusion(cleaned, scalar.satisfaction("review_score"), scalar.satisfaction(guess))
    return explore.label_report(counts)


# --- splits and features ----------------------------------------------------------------------------


@query
def time_split(spark, folder):
    return _split(spark, folder).select("order_id", "order_purchase_timestamp", "split")


@query
def group_split(spark, folder):
    cleaned = _cleaned(spark, folder).select("order_id", "customer_unique_id")
    return splits.group_split(cleaned, "customer_unique_id")


@query
def group_split_overlap(spark, folder):
    cleaned = _cleaned(spark, folder).select("order_id", "customer_unique_id")
    return splits.split_overlap(splits.group_split(cleaned, "customer_unique_id"), "customer_unique_id")


@query
def seeded_sample(spark, folder):
    test = _parts(spark, folder)["test"]
    return explore.sample_rows(test, 500, "order_id").select("order_id", "distance_km", TARGET)


@query
def drift_segments(spark, folder):
    table = _located(spark, folder).select("order_id", "customer_state", "order_purchase_timestamp")
    north = splits.north_orders(table).withColumn("segment", F.lit("north"))
    return north.unionByName(splits.sale_week_orders(table, *SALE_WEEK).withColumn("segment", F.lit("sale_week")))


@query
def features(spark, folder):
    table = _located(spark, folder)
    return add_features(contract.contract_only(table, keep=("order_id",)))


@query
def one_hot_states(spark, folder):
    """Position of the hot slot per state column, 0 for a state that training did not see.

    North orders are left out of the training side, so their states are unknown to the encoder.
    """
    table = add_features(_located(spark, folder))
    encoder = models.encode(table.where(~splits.in_north()))
    hot = encoder.transform(table)
    slots = [F.array_position(vector_to_array(f"{c}_hot"), F.lit(1.0)).alias(f"{c}_slot") for c in CATEGORIES]
    widths = [F.size(vector_to_array(f"{c}_hot")).alias(f"{c}_width") for c in CATEGORIES]
    return hot.select("order_id", *slots, *widths)


# --- evaluation and models --------------------------------------------------------------------------


@query
def baseline_estimate_mae(spark, folder):
    return evaluate.estimate_mae(_split(spark, folder))


@query
def baseline_median_mae(spark, folder):
    return evaluate.median_mae(_split(spark, folder))


def _simple_predictions(spark, folder) -> DataFrame:
    """Three predictors that need no fit, as a long table like that of the fitted candidates."""
    split = _split(spark, folder)
    held_out = split.where("split IN ('val', 'test')").withColumn("m", evaluate.train_median(split))
    cells = F.array(
        F.struct(F.lit("median").alias("model"), F.col("m").alias("prediction")),
        F.struct(F.lit("estimate").alias("model"), F.col("estimated_delivery_days").cast("double").alias("prediction")),
        F.struct(F.lit("half_estimate").alias("model"), (F.col("estimated_delivery_days") / 2).alias("prediction")),
    )
    return held_out.select("order_id", "split", TARGET, F.inline(cells))


@query
def model_errors(spark, folder):
    return evaluate.model_errors(_simple_predictions(spark, folder))


@query
def model_choice(spark, folder):
    return evaluate.compare_models(evaluate.model_errors(_simple_predictions(spark, folder)))


@query
def promotion_gate(spark, folder):
    errors = evaluate.model_errors(_simple_predictions(spark, folder)).where("split = 'test'")
    pick = lambda m: F.max(F.when(F.col("model") == m, F.col("mae")))
    rows = [
        errors.agg(
            F.lit(f"{new} after {old}").alias("case"),
            pick(new).alias("new_mae"),
            pick("median").alias("baseline_mae"),
            pick(old).alias("champion_mae"),
        )
        for new, old in (("half_estimate", "none"), ("half_estimate", "estimate"), ("estimate", "median"), ("median", "median"))
    ]
    return evaluate.promotion_gate(reduce(DataFrame.unionByName, rows))


@query
def promotion_gate_latency(spark, folder):
    """A challenger that is good enough, at the latency of each model version in the log and at twice that."""
    errors = evaluate.model_errors(_simple_predictions(spark, folder)).where("split = 'test'")
    pick = lambda m: errors.agg(F.max(F.when(F.col("model") == m, F.col("mae")))).scalar()
    log = service.request_metrics(standins.request_log(spark, folder), ["model_version"])
    times = F.explode(F.array(F.lit(1), F.lit(2)))
    rows = log.select("model_version", "p95", times.alias("times")).select(
        F.format_string("version %s at %d x", "model_version", "times").alias("case"),
        (F.col("p95") * F.col("times")).alias("p95_ms"),
        pick("half_estimate").alias("new_mae"),
        pick("estimate").alias("baseline_mae"),
        F.lit(None).cast("double").alias("champion_mae"),
    )
    judged = evaluate.promotion_gate(rows)
    return judged.withColumn("reasons", F.regexp_replace("reasons", "[0-9.]+ ms", "ms"))


@query
def late_vs_predicted(spark, folder):
    split = _split(spark, folder)
    return evaluate.late_share(split.withColumn("prediction", evaluate.train_median(split)))


@query
def arrivals_by_state_day(spark, folder):
    guess = F.col("estimated_delivery_days") * 0.7
    return evaluate.arrivals_by_state_day(_located(spark, folder).withColumn("prediction", guess))


def _model_rows(spark, folder) -> DataFrame:
    """The split order table, once the whole of it holds the contract; a bad row stops the job."""
    checked = contract.require_valid(_split(spark, folder))
    return contract.contract_only(checked, keep=("order_id", "split", TARGET))


@query
def model_compare(spark, folder):
    """Fit all candidates on the training rows, score validation and test, mark the best."""
    rows = _model_rows(spark, folder)
    fitted = models.fit_candidates(rows.where("split = 'train'"))
    return evaluate.compare_models(evaluate.model_errors(models.predict_all(fitted, rows)))


def _fitted(spark, folder, *names: str) -> tuple[DataFrame, dict]:
    rows = _model_rows(spark, folder)
    return rows, models.fit_candidates(rows.where("split = 'train'"), list(names))


@query
def run_metrics(spark, folder):
    """The errors of a run appended to the metrics table, and the table read back."""
    rows, fitted = _fitted(spark, folder, "median", "linear_regression")
    path = new_path(spark, "run-metrics")
    evaluate.metric_rows(evaluate.model_errors(models.predict_all(fitted, rows)), "run-1").write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query
def run_records(spark, folder):
    """Two runs on record, the first one kept twice: rows per split, checksum, number of parameters, and the median's errors.

    Errors of the fitted model stand in as whether they are below the median's.
    """
    rows, fitted = _fitted(spark, folder, "median", "linear_regression")
    path = new_path(spark, "runs")
    made = cut_lineage(runs.record(fitted, rows.select("order_id", "split", TARGET), models.predict_all(fitted, rows)), "run-record")
    for run in ("run-1", "run-1", "run-2"):
        runs.keep_record(made, path, run)
    found = runs.records(spark, path)
    metrics = found.where("kind = 'metric'")
    at = lambda m: F.max(F.when(F.col("model") == m, F.col("number")))
    errors = metrics.groupBy("run_id", "split", "name").agg(
        F.lit("median").alias("model"), at("median").alias("number"), (at("linear_regression") < at("median")).cast("string").alias("text")
    )
    given = found.where("kind = 'param'").groupBy("run_id", "model").agg((F.count("*") > 0).cast("string").alias("text"))
    given = given.select("run_id", "model", F.lit("param").alias("kind"), F.lit("given").alias("name"), "text")
    rest = found.where("kind IN ('rows', 'table')")
    return rest.unionByName(errors.withColumn("kind", F.lit("metric"))).unionByName(given, allowMissingColumns=True)


@query
def promotion_gate_fitted(spark, folder):
    """Versions fitted on the same rows and put to the gate one after the other: which one it let through, and what the pointer names.

    The median does not beat itself; a better model is promoted; the same again is no better; a worse one is not; nor is a slow one.
    """
    rows, fitted = _fitted(spark, folder, "median", "linear_regression")
    held = Registry(spark, new_path(spark, "registry"))
    test = cut_lineage(rows.where("split = 'test'"), "gate-rows")
    cases = [("median", None), ("linear_regression", None), ("linear_regression", None), ("median", None), ("linear_regression", 250.0)]
    judged = []
    for step, (name, p95) in enumerate(cases, 1):
        version = held.register(fitted[name], {"model": name})
        row = judge(held, version, test, fitted["median"], p95)
        judged.append(row.select(F.lit(step).alias("step"), F.lit(name).alias("model"), "*", F.lit(held.promoted()).cast("int").alias("pointer")))
    return reduce(DataFrame.unionByName, judged).select(
        "step", "model", "version", "champion", "n", "baseline_mae", "promoted", "pointer",
        (F.col("new_mae") < F.col("baseline_mae")).alias("below_baseline"),
        F.when(F.col("reasons") == "", 0).otherwise(F.size(F.split("reasons", "; "))).alias("n_reasons"),
    )


@query
def drift_verdict_fitted(spark, folder):
    """The monitor with the promoted fitted model: it is loaded, scores the test and the four tables, and is judged.

    Fitted errors stand in as whether they are below the median's, over the limit, and what follows from it.
    """
    rows, fitted = _fitted(spark, folder, "median", "linear_regression")
    held = Registry(spark, new_path(spark, "registry"))
    version = held.register(fitted["linear_regression"], {"model": "linear_regression"})
    judge(held, version, rows.where("split = 'test'"), fitted["median"])
    reference, median = stored_reference(spark, folder)
    model = {"prediction": held.load()}
    keep = ("order_id", "split", TARGET, "distance_km")
    scored = lambda df: models.predicted(model, contract.contract_only(df, keep=keep))
    test = scored(stored_split(spark, folder).where("split = 'test'"))
    own = profile.with_error(reference, test, new_path(spark, "fitted-error"))
    found = profile.monitored(own, {n: scored(df) for n, df in _currents(spark, folder, median).items()})
    drifted = F.col("n_drifted") > 0
    return found.select(
        "name", F.lit(held.promoted()).alias("version"), "n_drifted", "psi_text", "n_days",
        (F.col("test_mae") < F.lit(reference.test_mae())).alias("test_below_median"),
        (F.col("code") == F.when(drifted, 2).when(F.col("mae") > F.col("test_mae") + 2, 3).otherwise(0)).alias("code_follows"),
        (F.col("retrain") == (drifted | (F.col("streak") >= 2))).alias("retrain_follows"),
    )


@query
def score_batch(spark, folder):
    """Fit, save and load a model, and score the accepted requests with it."""
    rows = _model_rows(spark, folder)
    fitted = models.fit_candidates(rows.where("split = 'train'"), ["linear_regression"])["linear_regression"]
    path = new_path(spark, "model")
    models.save_model(fitted, path)
    accepted, _ = contract.route(contract.check(_requests(spark, folder)))
    return models.score(models.load_model(path), accepted, version="1")


# --- drift and service ------------------------------------------------------------------------------


def _drift_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    split = stored_split(spark, folder)
    return split.where("split = 'train'"), splits.north_orders(split)


@query
def drift_psi(spark, folder):
    return drift.psi(*_drift_sides(spark, folder), DRIFT_COLUMNS)


@query
def drift_psi_deciles(spark, folder):
    return drift.psi(*_drift_sides(spark, folder), DRIFT_COLUMNS, bins="deciles")


@query
def drift_ks(spark, folder):
    return drift.ks(*_drift_sides(spark, folder), DRIFT_COLUMNS)


@query
def drift_report(spark, folder):
    return drift.drift_report(*_drift_sides(spark, folder))


@query
def drift_report_all_columns(spark, folder):
    """Any column decides, the target included."""
    return drift.drift_report(*_drift_sides(spark, folder), deciding=DRIFT_COLUMNS, info=[])


def _currents(spark, folder, median: float) -> dict[str, DataFrame]:
    """Four tables to check: a plain sample, other places, a sale week, and a season with slower delivery."""
    guessed = stored_split(spark, folder).withColumn("prediction", F.lit(median))
    return {
        "normal": explore.sample_rows(guessed.where("split = 'test'"), 500, "order_id"),
        "north": splits.north_orders(guessed),
        "sale_week": splits.sale_week_orders(guessed, *SALE_WEEK),
        "december": guessed.where(F.month("order_purchase_timestamp") == 12),
    }


def _monitored(spark, folder, **limits) -> DataFrame:
    """Verdicts on the four tables against the stored profile."""
    reference, median = stored_reference(spark, folder)
    return profile.monitored(reference, _currents(spark, folder, median), **limits)


@query
def concept_drift(spark, folder):
    parts = _parts(spark, folder)
    median = evaluate.train_median(parts["train"])
    current = splits.sale_week_orders(_located(spark, folder), *SALE_WEEK)
    return drift.concept_drift(parts["test"].withColumn("prediction", median), current.withColumn("prediction", median))


@query
def drift_verdict(spark, folder):
    return _monitored(spark, folder)


@query
def drift_verdict_small_days(spark, folder):
    """The same verdicts with days of two orders judged and half a day of margin, so that streaks show on little data."""
    return _monitored(spark, folder, min_orders=2, margin=0.5)


@query
def drift_alerts(spark, folder):
    return alerts.drift_alerts(_monitored(spark, folder), F.col("name"))


@query
def drift_reports_kept(spark, folder):
    """Reports on the four tables against the stored profile, kept by table and run: one run is kept twice, one copy stays."""
    reference, median = stored_reference(spark, folder)
    path = new_path(spark, "drift-reports")
    reports = cut_lineage(profile.drift_reports(reference, _currents(spark, folder, median)), "drift-reports-made")
    for rows, run in ((reports, "run-1"), (reports, "run-1"), (reports.where("name = 'north'"), "run-2")):
        kept.keep(rows, path, run, by=["name"])
    return kept.kept(spark, path, profile.REPORT)


@query
def drift_alerts_kept(spark, folder):
    """The alerts of two runs, the first one run again: each stands there once."""
    path = new_path(spark, "drift-alerts")
    found = cut_lineage(alerts.drift_alerts(_monitored(spark, folder), F.col("name")), "drift-alerts-made")
    for run in ("run-1", "run-1", "run-2"):
        alerts.keep_alerts(found, path, run)
    return kept.kept(spark, path, alerts.ALERT)


@query
def daily_mae(spark, folder):
    return drift.daily_mae(standins.prediction_log(spark, folder))


@query
def mae_streak(spark, folder):
    daily = drift.daily_mae(standins.prediction_log(spark, folder))
    limits = [25.0, 27.0, 29.0, 100.0]
    rows = [drift.longest_streak(daily, x).withColumn("mae_limit", F.lit(x)) for x in limits]
    return reduce(DataFrame.unionByName, rows)


STREAK_LIMITS = [25.0, 27.0, 29.0, 100.0]


@query
def mae_streak_uneven(spark, folder):
    """Streaks over a log with missing days and a good one, so that gaps and resets count."""
    daily = drift.daily_mae(standins.uneven_prediction_log(spark, folder), min_orders=20)
    rows = [drift.longest_streak(daily, x).withColumn("mae_limit", F.lit(x)) for x in STREAK_LIMITS]
    return reduce(DataFrame.unionByName, rows)


@query
def request_metrics(spark, folder):
    log = standins.request_log(spark, folder)
    overall = service.request_metrics(log).withColumn("model_version", F.lit("all"))
    return overall.unionByName(service.request_metrics(log, ["model_version"]))


@query
def request_metrics_approx(spark, folder):
    return service.request_metrics_approx(standins.request_log(spark, folder), ["model_version"])


@query
def request_sketches(spark, folder):
    """Latencies and events per model from sketches kept per day and merged: exact counts, and whether estimates hold their bounds."""
    log = standins.request_log(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    columns = {"latency_ms": True, "event_id": False, "status": False}
    path = new_path(spark, "request-sketches")
    kept.keep(sketches.sketched(log, columns, ["day", "model_version"]), path, "run-1", by=["day"])
    stored = kept.kept(spark, path, f"day STRING, model_version STRING, {sketches.SKETCHES}")
    found = sketches.estimates(sketches.merged(stored, ["model_version"]), [0.5, 0.95])
    return sketches.checked(log, found, columns, [0.5, 0.95], ["model_version"])


@query
def order_sketches(spark, folder):
    """Columns of the order table from sketches per month, merged per year: exact counts, and whether estimates hold their bounds."""
    table = stored_order_table(spark, folder)
    table = table.withColumns({p: F.date_format("order_purchase_timestamp", f) for p, f in (("month", "yyyy-MM"), ("year", "yyyy"))})
    columns = {**{c: True for c in DESCRIBED}, "customer_id": False, "customer_state": False, "order_id": False}
    path = new_path(spark, "order-sketches")
    kept.keep(sketches.sketched(table, columns, ["year", "month"]), path, "run-1", by=["month"])
    stored = kept.kept(spark, path, f"year STRING, month STRING, {sketches.SKETCHES}")
    found = sketches.estimates(sketches.merged(stored, ["year"]), [0.25, 0.5, 0.75])
    return sketches.checked(table, found, columns, [0.25, 0.5, 0.75], ["year"])


@query
def request_last_1000(spark, folder):
    return service.service_status(standins.request_log(spark, folder))


@query
def slo_check(spark, folder):
    log = standins.request_log(spark, folder)
    daily = log.withColumn("day", F.to_date("ts"))
    return service.slo_check(service.request_metrics(daily, ["day"]))


@query
def alert_rows(spark, folder):
    checked = contract.check(_requests(spark, folder), payload=True)
    rejected = alerts.rejection_alerts(checked, "order_id")
    slow = service.slo_check(service.service_status(standins.request_log(spark, folder)))
    return rejected.unionByName(alerts.slo_alerts(slow).withColumn("order_id", F.lit(None).cast("bigint")))


# --- streams ----------------------------------------------------------------------------------------


def _stream_requests(spark, folder) -> DataFrame:
    """The requests as a stream of JSON lines."""
    path = new_path(spark, "requests")
    _requests(spark, folder).write.json(path)
    return jobs.read_json_stream(spark, path, ["order_id", *contract.CONTRACT_COLUMNS])


@query
def stream_quarantine(spark, folder):
    out = new_path(spark, "quarantine")
    jobs.quarantine(_stream_requests(spark, folder), out, f"{out}-state").awaitTermination()
    accepted, rejected, noted = (spark.read.parquet(f"{out}/{n}") for n in ("accepted", "quarantine", "alerts"))
    count = lambda df, name: df.agg(F.lit(name).alias("sink"), F.count("*").alias("n"))
    parts = [count(accepted, "accepted"), count(rejected, "quarantine"), count(noted, "alerts")]
    reasons = rejected.select(F.inline("violations")).groupBy("column", "rule").agg(F.count("*").alias("n"))
    named = reasons.select(F.concat_ws(": ", "column", "rule").alias("sink"), "n")
    return reduce(DataFrame.unionByName, [*parts, named])


@query
def stream_score_check(spark, folder):
    """One saved model over the accepted requests, as a batch and as a stream: how many rows, how many of them differ."""
    rows = _model_rows(spark, folder)
    fitted = models.fit_candidates(rows.where("split = 'train'"), ["linear_regression"])["linear_regression"]
    out = new_path(spark, "scores")
    jobs.scored(_stream_requests(spark, folder), fitted, "1", out, f"{out}-state").awaitTermination()
    accepted, _ = contract.route(contract.check(_requests(spark, folder)))
    batch = models.score(fitted, accepted, version="1").withColumnRenamed("prediction", "in_batch")
    streamed = spark.read.parquet(out).select(F.col("order_id").cast("bigint").alias("order_id"), "prediction")
    both = batch.select("order_id", "in_batch").join(streamed, "order_id", "full")
    same = F.abs(F.col("in_batch") - F.col("prediction")) < 1e-6
    differ = F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    return both.agg(F.count("*").alias("n"), F.coalesce(differ, F.lit(0)).alias("n_different"))


@query
def stream_score(spark, folder):
    """Scores of the accepted stream, with the same saved model as a batch would use."""
    rows = _model_rows(spark, folder)
    fitted = models.fit_candidates(rows.where("split = 'train'"), ["linear_regression"])["linear_regression"]
    out = new_path(spark, "scores")
    jobs.scored(_stream_requests(spark, folder), fitted, "1", out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out)


def _log_stream(spark, folder) -> DataFrame:
    """The request log as a stream in which every seventh event is replayed."""
    log = standins.as_request_log(jobs.read_parquet_stream(spark, folder, "events"))
    times = F.when(F.col("event_id") % 7 == 0, 2).otherwise(1)
    return log.select("*", F.explode(F.sequence(F.lit(1), times)).alias("_time")).drop("_time")


@query
def stream_request_metrics(spark, folder):
    """Closed daily windows only: the newest one is still open when the input ends."""
    out = new_path(spark, "windows")
    jobs.request_metrics(_log_stream(spark, folder), out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out)


@query
def stream_alerts(spark, folder):
    out = new_path(spark, "stream-alerts")
    jobs.alerts(_log_stream(spark, folder), out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out).select("window_start", "title", "detail")


@query
def stream_daily_mae(spark, folder):
    """Predictions joined with the deliveries that follow within the bound, then the error per day."""
    return drift.daily_mae(_labelled_stream(spark, folder)[0])


@query
def stream_daily_mae_small_days(spark, folder):
    """The same with days of five orders judged."""
    return drift.daily_mae(_labelled_stream(spark, folder)[0], min_orders=5)


@query
def stream_label_gaps(spark, folder):
    """How many deliveries were reported, and how many met no prediction within the bound."""
    return jobs.unjoined_labels(*reversed(_labelled_stream(spark, folder)))


@query
def stream_mae_streak(spark, folder):
    """The same streaks followed on streams: errors of closed days, then runs in the state of each limit.

    The newest day is still open when the input ends.
    """
    log = standins.as_uneven(standins.as_predictions(jobs.read_parquet_stream(spark, folder, "events")))
    out = new_path(spark, "streaks")
    jobs.daily_errors(log, f"{out}/days", f"{out}/days-state", min_orders=20).awaitTermination()
    days = spark.readStream.schema(jobs.DAYS).parquet(f"{out}/days")
    jobs.streaks(days, STREAK_LIMITS, f"{out}/runs", f"{out}/runs-state").awaitTermination()
    found = spark.read.schema(jobs.RUNS).parquet(f"{out}/runs")
    return found.groupBy("mae_limit").agg(
        F.max("n_days").alias("n_days"), F.max("longest").alias("streak"), F.max_by("run", "n_days").alias("run"), F.max("day").alias("last_day")
    )


@query
def stream_unlabelled(spark, folder):
    """Per month, predictions whose label came within the bound, and those released without one after it had passed."""
    found = _labelled_stream(spark, folder, "left_outer")[0]
    month = F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month")
    missing = F.col("delivered_at").isNull()
    return found.groupBy(month).agg(
        F.sum((~missing).cast("bigint")).alias("n_labelled"), F.sum(missing.cast("bigint")).alias("n_unlabelled")
    )


def _labelled_stream(spark, folder, how: str = "inner") -> tuple[DataFrame, DataFrame]:
    """What the stream has joined, and all labels that were reported."""
    heads = standins.as_orders(jobs.read_parquet_stream(spark, folder, "orders"))
    made = heads.select(
        "order_id",
        "order_purchase_timestamp",
        scalar.elapsed_days("order_purchase_timestamp", "order_estimated_delivery_date").cast("double").alias("prediction"),
    )
    again = standins.as_orders(jobs.read_parquet_stream(spark, folder, "orders"))
    arrived = again.where("order_delivered_customer_date IS NOT NULL").select(
        "order_id",
        F.col("order_delivered_customer_date").alias("delivered_at"),
        scalar.elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias(TARGET),
    )
    out = new_path(spark, "labelled")
    jobs.labelled(made, arrived, out, f"{out}-state", how).awaitTermination()
    (reported,) = _raw(spark, folder, "orders")
    return spark.read.parquet(out), reported.where("order_delivered_customer_date IS NOT NULL").select("order_id")
