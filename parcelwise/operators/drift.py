"""Drift of the inputs and of the error, and the verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import percentiles
from parcelwise.functions.scalar import flag
from parcelwise.functions.steps import BUCKET, Gap, first_counts, kolmogorov_p, largest_gaps
from parcelwise.operators.evaluate import mae
from parcelwise.operators.features import TARGET

# Fixed values.
DECIDING_COLUMNS = ["total_weight_g", "distance_km"]
INFO_COLUMNS = ["total_price", "total_freight", TARGET]
PSI_LIMIT = 0.2
KS_P_LIMIT = 0.01
MAE_MARGIN = 2.0
RETRAIN_DAYS = 2
MIN_ORDERS_PER_DAY = 30
NO_DRIFT, DATA_DRIFT, CONCEPT_DRIFT = 0, 2, 3

# Share put in place of an empty bin, so that its logarithm exists.
EMPTY_SHARE = 1e-4


def _cells(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both tables in long form: rows of (ref, cur, column, _v), of which one of ref and cur is 1."""
    cells = ", ".join(f"struct('{c}' AS column, CAST(`{c}` AS DOUBLE) AS _v)" for c in columns)
    side = lambda df, ref: df.selectExpr(f"{ref} AS ref", f"{1 - ref} AS cur", f"inline(array({cells}))")
    return side(reference, 1).unionByName(side(current, 0)).where("_v IS NOT NULL AND NOT isnan(_v)")


def _both_counts() -> list[Column]:
    return [F.sum(F.col(c).cast("bigint")).alias(c) for c in ("ref", "cur")]


def psi_of_bins(bins: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """Population stability from the counts per bin of each group: rows of (by, bin, ref, cur)."""
    sizes = bins.groupBy(*by).agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    # Against an empty table there is no share, so the index is null and nothing counts as drifted.
    share = lambda c: f"CASE WHEN n_{c} > 0 THEN CASE WHEN {c} = 0 THEN {EMPTY_SHARE!r}D ELSE {c} / n_{c} END END"
    # One row per named column and table, so the size of this side is known.
    joined = bins.join(F.broadcast(sizes), list(by))
    shares = joined.selectExpr(*[f"`{c}`" for c in by], f"{share('ref')} AS p", f"{share('cur')} AS q")
    return shares.groupBy(*by).agg(F.sum(F.expr("(q - p) * ln(q / p)")).alias("psi"))


# Equal-width bins from ``lo`` to ``hi``, the last one closed.
BIN = "CAST(CASE WHEN hi > lo THEN least(floor((_v - lo) / (hi - lo) * k), k - 1) ELSE 0 END AS BIGINT)"


def psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: str = "sturges") -> DataFrame:
    """Population stability index per column.

    ``sturges``: ceil(log2(n)) + 1 equal-width bins over the range of both tables. ``deciles``: bins cut
    at the exact deciles of the reference.
    """
    # Two passes: the range, then counts per bin. What is shuffled is a row per bin and task, never one per value.
    cells = _cells(reference, current, columns)
    if bins == "deciles":
        names = [f"d{i}" for i in range(1, 10)]
        cuts = percentiles(
            cells.where("ref = 1"), "_v", {n: i / 10 for i, n in enumerate(names, 1)}, by=["column"]
        )
        place = " + ".join(f"CAST(_v > {n} AS BIGINT)" for n in names)
        placed = cells.join(F.broadcast(cuts), "column")
    else:
        ranges = cells.groupBy("column").agg(
            F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.expr("ceil(log2(count(*))) + 1 AS k")
        )
        place = BIN
        placed = cells.join(F.broadcast(ranges), "column")
    binned = placed.groupBy("column", F.expr(place).cast("bigint").alias("bin")).agg(*_both_counts())
    return psi_of_bins(binned)


def ks_rows(spark: SparkSession, gaps: dict[tuple, Gap], by: str) -> DataFrame:
    """Distances and p-values as a table; ``by`` declares the columns of a group."""
    rows = [(*group, g.largest, kolmogorov_p(g.largest, g.n_ref, g.n_cur)) for group, g in gaps.items()]
    return spark.createDataFrame(rows, f"{by}, ks_d DOUBLE, ks_p DOUBLE")


def ks(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and its asymptotic p-value per column that has values on both sides."""
    cells = _cells(reference, current, columns)
    inside = lambda asked: cells.withColumn("_b", F.expr(BUCKET)).join(F.broadcast(asked), ["column", "_b"])
    gaps = largest_gaps(first_counts(cells, ["column"]), inside, ["column"])
    return ks_rows(reference.sparkSession, gaps, "column STRING")


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    deciding: Sequence[str] = DECIDING_COLUMNS,
    info: Sequence[str] = INFO_COLUMNS,
) -> DataFrame:
    """One row per column: PSI, KS and the result. Only PSI of the deciding columns makes a drift."""
    columns = [*deciding, *info]
    return reported(psi(reference, current, columns).join(ks(reference, current, columns), "column", "left"), deciding)


def reported(both: DataFrame, deciding: Sequence[str]) -> DataFrame:
    """Add the result to rows of (column, psi, ks_d, ks_p)."""
    decides = F.col("column").isin(*deciding)
    result = F.when(~decides, "info").when(F.col("psi") > PSI_LIMIT, "DRIFT").otherwise("ok")
    return both.withColumns({"ks_rejects": F.col("ks_p") < KS_P_LIMIT, "result": result})


def daily_mae(predictions: DataFrame, min_orders: int = MIN_ORDERS_PER_DAY) -> DataFrame:
    """Error per purchase day; days with few orders are too noisy to judge."""
    day = F.to_date("order_purchase_timestamp").alias("day")
    daily = predictions.groupBy(day).agg(F.count("*").alias("n"), mae().alias("mae"))
    return daily.where(F.col("n") >= min_orders)


def longest_streak(daily: DataFrame, limit: Column | float) -> DataFrame:
    """One row: judged days and the longest run of consecutive calendar days above the limit.

    The window runs over the daily table, whose size is the number of days, not of orders.
    """
    limit = limit if isinstance(limit, Column) else F.lit(float(limit))
    over = daily.where(F.col("mae") > limit).selectExpr(
        "date_sub(day, CAST(row_number() OVER (ORDER BY day) AS INT)) AS island"
    )
    longest = over.groupBy("island").agg(F.count("*").alias("length")).agg(F.max("length")).scalar()
    return daily.agg(F.count("*").alias("n_days"), F.coalesce(longest, F.lit(0)).alias("streak"))


def concept_drift(test: DataFrame, current: DataFrame, margin: float = MAE_MARGIN) -> DataFrame:
    """One row: current error against the test error plus a margin. Both inputs carry predictions."""
    errors = current.agg(mae().alias("mae"), test.agg(mae()).scalar().alias("test_mae"))
    limited = errors.withColumns({"margin": F.lit(float(margin)), "mae_limit": F.col("test_mae") + float(margin)})
    return limited.withColumn("over_limit", F.coalesce(F.col("mae") > F.col("mae_limit"), F.lit(False)))


def verdict(judged: DataFrame) -> DataFrame:
    """Add code, verdict and retrain to rows with ``n_drifted``, ``over_limit`` and ``streak``.

    Drifted inputs explain a higher error, so they win over the error.
    """
    drifted = F.col("n_drifted") > 0
    code = F.when(drifted, DATA_DRIFT).when(F.col("over_limit"), CONCEPT_DRIFT).otherwise(NO_DRIFT)
    name = F.when(drifted, "Data Drift").when(F.col("over_limit"), "Concept Drift").otherwise("no drift")
    return judged.withColumns({"code": code, "verdict": name, "retrain": drifted | (F.col("streak") >= RETRAIN_DAYS)})


def psi_text(of: dict[str, Column]) -> Column:
    """The indexes of the deciding columns in words."""
    parts = [F.when(p.isNull(), F.lit(f"{c} PSI=unknown")).otherwise(F.format_string(f"{c} PSI=%.3f", p)) for c, p in of.items()]
    return F.concat_ws(", ", *parts)


def monitor(
    reference: DataFrame,
    current: DataFrame,
    test: DataFrame,
    deciding: Sequence[str] = DECIDING_COLUMNS,
    min_orders: int = MIN_ORDERS_PER_DAY,
    margin: float = MAE_MARGIN,
) -> DataFrame:
    """One row with everything the verdict rests on. ``current`` and ``test`` carry predictions."""
    inputs = psi(reference, current, deciding)
    text = psi_text({c: F.max(F.when(F.col("column") == c, F.col("psi"))) for c in deciding})
    drifted = inputs.agg(
        F.struct(F.coalesce(F.sum(flag(F.col("psi") > PSI_LIMIT)), F.lit(0)).alias("n"), text.alias("psi_text"))
    ).scalar()
    errors = concept_drift(test, current, margin)
    limit = errors.select("mae_limit").scalar()
    runs = longest_streak(daily_mae(current, min_orders), limit).select(F.struct("n_days", "streak")).scalar()
    judged = errors.withColumns({
        "n_drifted": drifted.getField("n"),
        "psi_text": drifted.getField("psi_text"),
        "n_days": runs.getField("n_days"),
        "streak": runs.getField("streak"),
    })
    return verdict(judged)
