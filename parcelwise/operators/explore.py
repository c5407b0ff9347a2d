"""Profiling and exploration: what is in a table, and how satisfied customers are."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from parcelwise.functions.order_stats import match, medians, percentiles, smallest
from parcelwise.functions.scalar import hash_key, holds, item_group, late_bin_label, right_closed_bin, satisfaction
from parcelwise.session import cut_lineage

LABELS = ["satisfied", "unsatisfied"]


def _as_long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """One row per cell: column name and value."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, columns, missing cells and repeated rows (missing equals missing)."""
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"), F.sum(missing).alias("_missing"))
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_n"), zero).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.coalesce(F.sum("_missing"), zero).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_n") - 1), zero).alias("duplicate_rows"),
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile_table(df, name) for name, df in tables.items()])


def cell_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each value occurs in each column; the base of the column profiles.

    Grouping by (column, value) combines on the map side and spreads every column over all tasks,
    which one distinct count per column in a single aggregate would not.
    """
    return _as_long(df, columns or df.columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, missing cells, distinct values, their ratio, and whether it is a key or constant."""
    columns = list(columns or df.columns)
    kinds = F.create_map(*[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())])
    grouped = cell_counts(df, columns).groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.count("value").alias("n_distinct"),
    )
    return grouped.select(
        "column",
        kinds[F.col("column")].alias("type"),
        "n_rows",
        "n_nulls",
        "n_distinct",
        (F.col("n_distinct") / F.col("n_rows")).alias("ratio"),
        F.when(F.col("n_distinct") == F.col("n_rows"), "key")
        .when(F.col("n_distinct") == 1, "constant")
        .otherwise("")
        .alias("flag"),
    )


def profile_columns_approx(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Approximate twin of the distinct counts: one pass, no shuffle of the values."""
    columns = list(columns or df.columns)
    one = df.agg(
        F.count("*").alias("n_rows"), *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)]
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"d_{i}").alias("n_distinct_approx")) for i, c in enumerate(columns)]
    return one.select("n_rows", F.inline(F.array(*cells)))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum per numeric column."""
    return _described(_as_long(df, columns, "double"), ["column"])


def describe_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The same for all numeric columns of several tables, in one pass over the values of all of them."""
    parts = []
    for name, df in tables.items():
        numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
        if numbers:
            parts.append(_as_long(df, numbers, "double").withColumn("table_name", F.lit(name)))
    return _described(reduce(DataFrame.unionByName, parts), ["table_name", "column"])


def _described(cells: DataFrame, by: list[str]) -> DataFrame:
    moments = cells.groupBy(*by).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = percentiles(cells, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=by)
    return match(moments, quartiles, by, "left").select(*by, "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_numeric_approx(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Approximate twin of the quartiles: one pass with a bounded sketch per column."""
    cells = _as_long(df, columns, "double")
    return cells.groupBy("column").agg(
        F.count("value").alias("n"),
        F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("quartiles_approx"),
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most common value (the smallest of equals) and its frequency."""
    place = F.struct(F.col("value").isNull(), -F.col("n"), F.col("value"))
    return cell_counts(df, columns).groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n"),
        F.count("value").alias("n_distinct"),
        F.min_by("value", place).alias("top"),
        F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("freq"),
    )


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    value = F.col(column) if isinstance(column, str) else column
    return df.select(value.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))


def rounded_score_counts(orders: DataFrame) -> DataFrame:
    """Orders per review score, halves rounded to the even neighbour."""
    return value_counts(orders, F.bround("review_score").cast("bigint"), "score")


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Distinct rows that occur more than once, with the number of copies."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """All members of every group of equal rows.

    The groups are counted first (equal rows combine on the map side); the join back has unique keys on
    its right side, so a hot group is only ever split, never multiplied.
    """
    columns = df.columns
    return match(df, duplicate_groups(df).drop("copies"), columns, "left_semi")


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Row count and an order-free checksum of a table; one map-side pass, nothing but two numbers move."""
    # Every cell is its length and its text, so no two rows read alike; a null has no length.
    text = [F.col(c).cast("string") for c in df.columns]
    cells = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(digest), F.lit(0)).alias("checksum"),
    )


def repeat_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    """The n people with the most customer ids, of those who have several."""
    per_person = customers.groupBy("customer_unique_id").agg(F.count_distinct("customer_id").alias("n_ids"))
    return per_person.where("n_ids > 1").orderBy(F.desc("n_ids"), "customer_unique_id").limit(n)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A repeatable sample of exactly n rows: the n smallest of a seeded hash of the key."""
    return smallest(df, n, hash_key(key, seed=seed), [key])


def satisfaction_shares(orders: DataFrame) -> DataFrame:
    """Share of each label; labels nobody got appear with 0."""
    counts = orders.agg(
        F.count("*").alias("total"), *[F.sum((satisfaction("review_score") == x).cast("bigint")).alias(x) for x in LABELS]
    )
    share = lambda x: F.coalesce(F.col(x), F.lit(0)) / F.nullif(F.col("total"), F.lit(0))
    cells = [F.struct(F.lit(x).alias("label"), F.coalesce(F.col(x), F.lit(0)).alias("n"), share(x).alias("share")) for x in LABELS]
    return counts.select(F.inline(F.array(*cells)))


def label_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"label": satisfaction("review_score"), "late_bin": late_bin_label("late_days")})


def score_by_lateness(orders: DataFrame) -> DataFrame:
    return orders.groupBy("is_late").agg(F.count("*").alias("n"), F.avg("review_score").alias("mean_score"))


def score_by_items(orders: DataFrame) -> DataFrame:
    grouped = orders.where("n_items IS NOT NULL").groupBy(item_group("n_items").alias("n_items_group"))
    return grouped.agg(F.count("*").alias("n"), F.avg("review_score").alias("mean_score"))


def score_by_late_bin(orders: DataFrame) -> DataFrame:
    """Mean score per lateness bin; bins without orders are left out."""
    grouped = orders.where("late_days IS NOT NULL").groupBy(
        right_closed_bin("late_days").alias("bin"), late_bin_label("late_days").alias("late_bin")
    )
    return grouped.agg(F.count("*").alias("n"), F.avg("review_score").alias("mean_score"))


def month_of(ts: str) -> Column:
    return F.date_trunc("month", F.col(ts))


def monthly_payment_types(orders: DataFrame, types: Sequence[str], min_orders: int = 100) -> DataFrame:
    """Orders per month with one column per main payment type; thin months are left out."""
    known = orders.where("main_payment_type IS NOT NULL")
    # Conditional counts instead of pivot(): a listed pivot plus a total needs two aggregations.
    columns = [F.sum((F.col("main_payment_type") == t).cast("bigint")).alias(t) for t in types]
    grouped = known.groupBy(month_of("order_purchase_timestamp").alias("month")).agg(F.count("*").alias("n"), *columns)
    return grouped.where(F.col("n") >= min_orders)


def monthly_orders(orders: DataFrame, min_orders: int = 100) -> DataFrame:
    """Orders and percentage of unsatisfied ones per month; thin months are left out."""
    bad = (satisfaction("review_score") == "unsatisfied").cast("int")
    grouped = orders.groupBy(month_of("order_purchase_timestamp").alias("month")).agg(
        F.count("order_id").alias("n"), (F.avg(bad) * 100).alias("unsatisfied_pct")
    )
    return grouped.where(F.col("n") >= min_orders)


def trim_above(df: DataFrame, column: str, p: float = 0.99) -> DataFrame:
    """Values up to the exact percentile p of the column."""
    limit = cut_lineage(percentiles(df, column, {"limit": p}), "trim-limit").scalar()
    return df.select(column).where(F.col(column) <= limit)


def _with_all_bins(counts: DataFrame, n_bins: Column, source: DataFrame) -> DataFrame:
    """Add the empty bins, numbered from 0."""
    bins = source.select(F.explode(F.sequence(F.lit(0).cast("bigint"), n_bins - 1)).alias("bin"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def integer_histogram(df: DataFrame, column: str, p: float = 0.99) -> DataFrame:
    """Unit-wide bins centred on 0, 1, 2, ... up to the largest kept value; values below are not shown."""
    kept = trim_above(df, column, p)
    bins = kept.select(F.floor(F.col(column) + 0.5).cast("bigint").alias("bin")).where("bin >= 0")
    counts = bins.groupBy("bin").agg(F.count("*").alias("n"))
    top = counts.agg(F.max("bin").alias("top")).where("top IS NOT NULL")
    return _with_all_bins(counts, F.col("top") + 1, top)


def _equal_bins(df: DataFrame, place: Column, n_bins: int) -> DataFrame:
    """Counts of n equal-width bins over the range of an expression; the last bin is closed."""
    values = df.select(place.alias("_x")).where("_x IS NOT NULL")
    ends = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    spot = F.when(hi > lo, F.floor((F.col("_x") - lo) / F.nullif(hi - lo, F.lit(0.0)) * n_bins)).otherwise(F.lit(0))
    counts = values.groupBy(F.least(spot, F.lit(n_bins - 1)).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    one = values.agg(F.count("*").alias("rows")).where("rows > 0")
    return _with_all_bins(counts, F.lit(n_bins).cast("bigint"), one)


def trimmed_histogram(df: DataFrame, column: str, n_bins: int = 50, p: float = 0.99) -> DataFrame:
    return _equal_bins(trim_above(df, column, p), F.col(column), n_bins)


def log_histogram(df: DataFrame, column: str, n_edges: int = 50) -> DataFrame:
    """Bins between ``n_edges`` log-spaced edges from the smallest to the largest value."""
    return _equal_bins(df.where(F.col(column) > 0), F.log10(column), n_edges - 1)


def segment_summary(df: DataFrame, segment: Column) -> DataFrame:
    """Rows, mean target and exact medians of the main columns per segment."""
    tagged = df.withColumn("segment", segment).where("segment IS NOT NULL")
    columns = ["distance_km", "total_weight_g", "delivery_days"]
    sizes = tagged.groupBy("segment").agg(
        F.count("*").alias("n"),
        F.avg("delivery_days").alias("mean_days"),
        F.avg("estimated_delivery_days").alias("mean_estimate"),
    )
    middle = medians(tagged, {c: f"median_{c}" for c in columns}, by=["segment"])
    return match(sizes, middle, ["segment"], "left")


def confusion(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """Counts per (actual, predicted) label."""
    return df.select(actual.alias("actual"), predicted.alias("predicted")).groupBy("actual", "predicted").agg(
        F.count("*").alias("n")
    )


def label_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label from a confusion table."""
    cells = [
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("named")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("named")),
    ]
    both = counts.select((F.col("actual") == F.col("predicted")).alias("hit"), F.inline(F.array(*cells)))
    grouped = both.groupBy("label").agg(
        F.sum(F.when(holds(F.col("hit")), F.col("support")).otherwise(F.lit(0))).alias("hits"),
        F.sum("support").alias("support"),
        F.sum("named").alias("named"),
    )
    precision = F.coalesce(F.col("hits") / F.nullif(F.col("named"), F.lit(0)), F.lit(0.0))
    recall = F.coalesce(F.col("hits") / F.nullif(F.col("support"), F.lit(0)), F.lit(0.0))
    scored = grouped.withColumns({"precision": precision, "recall": recall})
    total = F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))
    f1 = F.coalesce(2 * F.col("precision") * F.col("recall") / total, F.lit(0.0))
    return scored.withColumn("f1", f1).select("label", "precision", "recall", "f1", "support")
