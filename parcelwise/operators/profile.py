"""A stored profile of the reference, from one scan of it, for any number of later checks.

A profile holds, per column, exact counts in order-preserving buckets (a few thousand rows), the values themselves in
the order of their buckets, and the size and total of the test error. A check takes whole buckets from the counts. Only
where an edge of a bin falls inside a bucket, or a bucket may hold the largest gap, does it read that bucket's values;
their files are sorted, so that row groups of other buckets are skipped. Results are those of the same check on the tables.

Profiles add up: one over several paths is the profile of all their rows, so a reference that grows by the day is never scanned
again. Writing shuffles a row per column, bucket and task, no values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.scalar import flag
from parcelwise.functions.steps import BUCKET, COUNTS, largest_gaps
from parcelwise.operators.drift import (
    BIN,
    DECIDING_COLUMNS,
    INFO_COLUMNS,
    MAE_MARGIN,
    MIN_ORDERS_PER_DAY,
    PSI_LIMIT,
    ks_rows,
    psi_of_bins,
    psi_text,
    reported,
    verdict,
)
from parcelwise.operators.features import TARGET
from parcelwise.session import cut_lineage

TS = "order_purchase_timestamp"
REPORT = "column STRING, psi DOUBLE, ks_d DOUBLE, ks_p DOUBLE, ks_rejects BOOLEAN, result STRING, name STRING"


def cells(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """The values of the columns in long form: (keep, column, _v)."""
    each = ", ".join(f"struct('{c}' AS column, CAST(`{c}` AS DOUBLE) AS _v)" for c in columns)
    return df.selectExpr(*keep, f"inline(array({each}))").where("_v IS NOT NULL AND NOT isnan(_v)")


def write_profile(reference: DataFrame, columns: Sequence[str], path: str, test: DataFrame | None = None) -> Profile:
    """Write the profile of the columns, and of the error of ``test`` (with predictions)."""
    spark = reference.sparkSession
    values = cells(reference, columns).withColumn("bucket", F.expr(BUCKET))
    values.sortWithinPartitions("column", "_v").write.partitionBy("column").parquet(f"{path}/values")
    counted = spark.read.schema("_v DOUBLE, bucket LONG, column STRING").parquet(f"{path}/values")
    counted = counted.groupBy("column", "bucket").agg(F.count("*").alias("n"), F.min("_v").alias("first"), F.max("_v").alias("last"))
    counted.write.parquet(f"{path}/buckets")
    if test is not None:
        _write_error(test, path)
    return Profile(spark, path)


def _write_error(test: DataFrame, path: str) -> None:
    error = F.abs(F.col("prediction") - F.col(TARGET))
    test.agg(F.count(error).alias("n"), F.sum(error).alias("total")).write.parquet(f"{path}/errors")


def with_error(profile: Profile, test: DataFrame, path: str) -> Profile:
    """The same profile with the test error of another model, which is written; the reference is not read."""
    _write_error(test, path)
    return Profile(profile.spark, *profile.paths, errors=(path,))


class Profile:
    """The stored profiles under one or several paths as one; ``errors``: where the test error lies, if elsewhere."""

    def __init__(self, spark: SparkSession, *paths: str, errors: Sequence[str] = ()):
        self.spark, self.paths, self.errors = spark, paths, errors or paths

    def _read(self, schema: str, name: str, paths: Sequence[str] = ()) -> DataFrame:
        parts = [self.spark.read.schema(schema).parquet(f"{p}/{name}") for p in paths or self.paths]
        return reduce(DataFrame.unionByName, parts)

    def buckets(self) -> DataFrame:
        """(column, bucket, n, first, last): how many values lie in a bucket, the least and the greatest of them."""
        rows = self._read("column STRING, bucket LONG, n LONG, first DOUBLE, last DOUBLE", "buckets")
        return rows.groupBy("column", "bucket").agg(
            F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
        )

    def values(self, wanted: list[tuple[str, int]]) -> DataFrame:
        """(column, bucket, _v) of some buckets; the filter reaches the scan."""
        rows = self._read("_v DOUBLE, bucket LONG, column STRING", "values")
        columns, buckets = ({w[i] for w in wanted} for i in (0, 1))
        return rows.where(F.col("column").isin(*columns) & F.col("bucket").isin(*buckets))

    def test_mae(self) -> float | None:
        row = self._read("n LONG, total DOUBLE", "errors", self.errors).agg(F.sum("total") / F.sum("n")).first()
        return row[0]


def gathered(currents: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """The tables to check as one, with ``name``, written once: the checks read it several times."""
    named = [df.select(F.lit(n).alias("name"), *columns) for n, df in currents.items()]
    return cut_lineage(reduce(DataFrame.unionByName, named), "checked-tables")


def _checks(profile: Profile, current: DataFrame) -> DataFrame:
    """(name, column, lo, hi, k): the bins of every table and column, a small table of the driver's."""
    own = current.groupBy("name", "column").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n"))
    ref = profile.buckets().groupBy("column").agg(F.min("first").alias("r_lo"), F.max("last").alias("r_hi"), F.sum("n").alias("r_n"))
    both = own.join(ref, "column", "left").selectExpr(
        "name", "column", "least(lo, r_lo) AS lo", "greatest(hi, r_hi) AS hi", "ceil(log2(n + coalesce(r_n, 0))) + 1 AS k"
    )
    return profile.spark.createDataFrame(both.collect(), "name STRING, column STRING, lo DOUBLE, hi DOUBLE, k LONG")


def psi(profile: Profile, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population stability per table and column, with the bins of ``drift.psi``; ``current`` has ``name``."""
    values = cells(current, columns, "name")
    checks = F.broadcast(_checks(profile, values))  # a row per table and named column
    place = lambda v: BIN.replace("_v", v)
    placed = profile.buckets().join(checks, "column").selectExpr("*", f"{place('first')} AS bin", f"{place('last')} AS bin_last")
    whole = placed.where("bin = bin_last").selectExpr("name", "column", "bin", "n AS ref", "0L AS cur")
    # At most one bucket per edge of a bin.
    cut = placed.where("bin <> bin_last").select("name", "column", "bucket", "lo", "hi", "k").collect()
    cut_rows = profile.spark.createDataFrame(cut, "name STRING, column STRING, bucket LONG, lo DOUBLE, hi DOUBLE, k LONG")
    parts = profile.values([(r["column"], r["bucket"]) for r in cut]).join(F.broadcast(cut_rows), ["column", "bucket"])
    parts = parts.selectExpr("name", "column", f"{BIN} AS bin", "1L AS ref", "0L AS cur")
    now = values.join(checks, ["name", "column"]).selectExpr("name", "column", f"{BIN} AS bin", "0L AS ref", "1L AS cur")
    bins = whole.unionByName(parts).unionByName(now).groupBy("name", "column", "bin")
    return psi_of_bins(bins.agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")), ["name", "column"])


def ks(profile: Profile, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Kolmogorov-Smirnov distance and p-value per table and column, as ``drift.ks`` gives them."""
    values = cells(current, columns, "name").withColumn("_b", F.expr(BUCKET))
    by = ["name", "column"]
    pairs = values.select(*by).distinct()
    ref = profile.buckets().join(F.broadcast(pairs), "column")  # a row per table and named column
    ref = ref.selectExpr(*by, "bucket AS _b", "n AS ref", "0L AS cur", "first AS lo", "last AS hi")
    now = values.groupBy(*by, "_b").agg(F.lit(0).cast("long").alias("ref"), F.count("*").alias("cur"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    counts = ref.unionByName(now).groupBy(*by, "_b").agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )

    def inside(asked: DataFrame) -> DataFrame:
        wanted = [(r["column"], r["_b"]) for r in asked.select("column", "_b").collect()]
        old = profile.values(wanted).withColumnRenamed("bucket", "_b").join(F.broadcast(asked), ["column", "_b"])
        new = values.join(F.broadcast(asked), [*by, "_b"])
        return old.selectExpr("_id", "_v", "1 AS ref", "0 AS cur").unionByName(new.selectExpr("_id", "_v", "0 AS ref", "1 AS cur"))

    return ks_rows(profile.spark, largest_gaps(counts, inside, by), "name STRING, column STRING")


def drift_reports(
    profile: Profile, currents: dict[str, DataFrame], deciding: Sequence[str] = DECIDING_COLUMNS, info: Sequence[str] = INFO_COLUMNS
) -> DataFrame:
    """The rows of ``drift.drift_report`` for several tables, with ``name``; for an empty one without index and distance."""
    columns = [*deciding, *info]
    current = gathered(currents, columns)
    by = ["name", "column"]
    each = profile.spark.createDataFrame([(n, c) for n in currents for c in columns], "name STRING, column STRING")
    both = each.join(psi(profile, current, columns), by, "left").join(ks(profile, current, columns), by, "left")
    return reported(both, deciding)


def monitored(
    profile: Profile,
    currents: dict[str, DataFrame],
    deciding: Sequence[str] = DECIDING_COLUMNS,
    min_orders: int = MIN_ORDERS_PER_DAY,
    margin: float = MAE_MARGIN,
) -> DataFrame:
    """The row of ``drift.monitor`` for several tables with predictions at once, with ``name``; also for an empty one."""
    spark = profile.spark
    current = gathered(currents, [TS, TARGET, "prediction", *[c for c in deciding if c != TARGET]])
    test_mae = profile.test_mae()
    index = psi(profile, current, deciding)
    of = {c: F.max(F.when(F.col("column") == c, F.col("psi"))) for c in deciding}
    drifted = F.coalesce(F.sum(flag(F.col("psi") > PSI_LIMIT)), F.lit(0)).alias("n_drifted")
    inputs = index.groupBy("name").agg(drifted, *[p.alias(f"_psi_{c}") for c, p in of.items()])
    # One row per table and day from here on.
    error = F.abs(F.col("prediction") - F.col(TARGET))
    days = current.groupBy("name", F.to_date(TS).alias("day")).agg(
        F.count("*").alias("n"), F.count(error).alias("judged"), F.sum(error).alias("total")
    )
    errors = days.groupBy("name").agg((F.sum("total") / F.sum("judged")).alias("mae"))
    kept = days.where(F.col("n") >= min_orders).withColumn("mae", F.col("total") / F.col("judged"))
    limit = F.lit(test_mae).cast("double") + float(margin)
    over = kept.where(F.col("mae") > limit).selectExpr(
        "name", "date_sub(day, CAST(row_number() OVER (PARTITION BY name ORDER BY day) AS INT)) AS island"
    )
    runs = over.groupBy("name", "island").agg(F.count("*").alias("length")).groupBy("name").agg(F.max("length").alias("streak"))
    judged = kept.groupBy("name").agg(F.count("*").alias("n_days")).join(runs, "name", "left")
    names = spark.createDataFrame([(n,) for n in currents], "name STRING")
    rows = names.join(inputs, "name", "left").join(errors, "name", "left").join(judged, "name", "left")
    rows = rows.withColumns({
        "test_mae": F.lit(test_mae).cast("double"),
        "margin": F.lit(float(margin)),
        "mae_limit": limit,
        "over_limit": F.coalesce(F.col("mae") > limit, F.lit(False)),
        "psi_text": psi_text({c: F.col(f"_psi_{c}") for c in deciding}),
        **{c: F.coalesce(c, F.lit(0)) for c in ("n_drifted", "n_days", "streak")},
    })
    order = ["name", "mae", "test_mae", "margin", "mae_limit", "over_limit", "n_drifted", "psi_text", "n_days", "streak"]
    return verdict(rows.select(*order))
