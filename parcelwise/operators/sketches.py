"""Sketches of columns, stored per period and merged over longer ones: distinct values and quantiles with a bound.

A row holds, for one column and one period, the number of rows, a sketch of the distinct values and one of the numbers. Sketches of
days merge into those of months without the rows, so a report over a long time reads a few kilobytes per column and day.
One pass over the rows makes all of them; nothing but sketches is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sizes of the sketches, and what they promise: the share of values below an estimated quantile is off by RANK_BOUND at most, a
# distinct count by DISTINCT_BOUND of itself (three standard errors).
NUMBERS, DISTINCT = 800, 14
RANK_BOUND, DISTINCT_BOUND = 0.01, 0.02
SKETCHES = "column STRING, n LONG, values BINARY, numbers BINARY"


def _cells(columns: Mapping[str, bool], make) -> str:
    return ", ".join(f"struct('{c}' AS column, {make(c, numeric)})" for c, numeric in columns.items())


def sketched(df: DataFrame, columns: Mapping[str, bool], by: Sequence[str]) -> DataFrame:
    """(by, column, n, values, numbers): one row per group and column; ``columns`` says which ones are numbers.

    Nulls and NaN are in neither sketch; a column that is no number, or has none in a group, has a null for that sketch.
    """
    aggs = [F.count("*").alias("_n")]
    for i, (c, numeric) in enumerate(columns.items()):
        aggs.append(F.expr(f"hll_sketch_agg(CAST(`{c}` AS STRING), {DISTINCT}) AS _d{i}"))
        if numeric:
            number = f"nanvl(CAST(`{c}` AS DOUBLE), NULL)"
            aggs.append(F.expr(f"kll_sketch_agg_double({number}, {NUMBERS}) AS _k{i}"))
    at = {c: i for i, c in enumerate(columns)}
    cell = lambda c, numeric: f"_n AS n, _d{at[c]} AS values, {f'_k{at[c]}' if numeric else 'CAST(NULL AS BINARY)'} AS numbers"
    return df.groupBy(*by).agg(*aggs).select(*by, F.expr(f"inline(array({_cells(columns, cell)}))"))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of longer periods: rows of the same ``by`` and column as one."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("n").alias("n"),
        F.expr("hll_union_agg(values)").alias("values"),
        F.expr("kll_merge_agg_double(numbers)").alias("numbers"),
    )


def estimates(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The sketches' answers: ``n_distinct`` and, where there are numbers, their ``quantiles``."""
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    some = "numbers IS NOT NULL AND kll_sketch_get_n_double(numbers) > 0"
    return sketches.selectExpr(
        "* EXCEPT (values, numbers)",
        "hll_sketch_estimate(values) AS n_distinct",
        f"CASE WHEN {some} THEN kll_sketch_get_quantile_double(numbers, array({wanted})) END AS quantiles",
    )


def checked(df: DataFrame, found: DataFrame, columns: Mapping[str, bool], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """How the estimates compare with the rows: exact counts, and whether each estimate lies within its bound."""
    cell = lambda c, numeric: f"CAST(`{c}` AS STRING) AS text, {f'nanvl(CAST(`{c}` AS DOUBLE), NULL)' if numeric else 'CAST(NULL AS DOUBLE)'} AS number"
    cells = df.select(*by, F.expr(f"inline(array({_cells(columns, cell)}))"))
    keys = [*by, "column"]
    exact = cells.groupBy(*keys, "text").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.count("text").alias("exact"))
    # One row per group and column.
    placed = cells.where("number IS NOT NULL").join(F.broadcast(found.select(*keys, "quantiles")), keys)
    share = lambda i, op: F.avg((F.expr(f"number {op} quantiles[{i}]")).cast("int"))
    off = [F.greatest(share(i, "<") - p, p - share(i, "<=")) for i, p in enumerate(probs)]
    ranks = placed.groupBy(*keys).agg(F.greatest(*off, F.lit(0.0)).alias("rank_error"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * DISTINCT_BOUND
    return found.join(exact, keys).join(ranks, keys, "left").select(
        *keys, "n", F.col("exact").alias("n_distinct"), near.alias("distinct_within"), (F.col("rank_error") <= RANK_BOUND).alias("quantiles_within")
    )
