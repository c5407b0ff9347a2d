"""Exact order statistics that no single task has to hold.

``percentile`` and ``median`` keep every distinct value of a group in one buffer, and a ranking
window sorts a whole group in one task. Both break when a group is a third of the table. Here the
search narrows down: coarse buckets are counted where the rows are read, and only rows of buckets that
hold a rank are counted by value (the shuffle key is group and value, so a hot group spreads out), then
placed by fine bucket and value. A window only ever runs over the buckets of a group or over the distinct
values of one fine bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Buckets per doubling of the absolute value: the whole double range has at most 2 * 2098 * COARSE.
COARSE = 256
# Equal-width buckets inside one coarse bucket of one group.
FINE = 4096

# Order-preserving bucket by magnitude: needs no look at the data.
_COARSE = f"""CAST(CASE
    WHEN _v = 0 THEN 0
    WHEN _v > 0 THEN floor(log2(CAST(_v AS DOUBLE)) * {COARSE}) + {1075 * COARSE}
    ELSE -floor(log2(-CAST(_v AS DOUBLE)) * {COARSE}) - {1075 * COARSE} END AS BIGINT) AS _b"""
# Order-preserving equal-width bucket between the least and greatest value of a coarse bucket.
_FINE = f"""CAST(CASE
    WHEN _hi > _lo THEN floor(CAST(_v - _lo AS DOUBLE) / CAST(_hi - _lo AS DOUBLE) * {FINE})
    ELSE 0 END AS BIGINT) AS _f"""


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name where null matches null; the right-hand keys are dropped."""
    marked = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = " AND ".join(f"`{k}` <=> `_right_{k}`" for k in keys)
    return left.join(marked, F.expr(same), how).drop(*[f"_right_{k}" for k in keys])


def _before(column: str, keys: Sequence[str], order: str) -> str:
    """SQL: the sum over the rows before this one."""
    partition = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)}" if keys else ""
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"coalesce(sum(`{column}`) OVER ({partition} ORDER BY {order} {frame}), 0)"


def values(df: DataFrame, value, by: Sequence[str] = (), weight: str = "1") -> DataFrame:
    """One row per row of the table with its value and weight; nulls are left out."""
    value = F.col(value) if isinstance(value, str) else value
    return df.select(*by, value.alias("_v"), F.expr(f"CAST({weight} AS BIGINT) AS _c")).where("_v IS NOT NULL")


def value_counts(df: DataFrame, value, by: Sequence[str] = (), weight: str = "1") -> DataFrame:
    """Distinct values per group with their number of rows; nulls are left out."""
    return values(df, value, by, weight).groupBy(*by, "_v").agg(F.sum("_c").alias("_c"))


def hits(counts: DataFrame, ranks: Sequence[str], by: Sequence[str] = (), few: bool = False) -> DataFrame:
    """The values at given 0-based ranks of every group.

    ``counts`` comes from :func:`values`, or from :func:`value_counts` where counting first is worth a shuffle. The
    coarse buckets are counted in the tasks that read the rows; only rows of a bucket that holds a rank go
    further, counted by value. Each rank is a SQL expression over the group columns and
    ``_total``, the row count of the group. A result row is a value that lies at one rank at least:
    ``_r{i}`` is null unless it lies at rank i, and then the number of equal values before that rank.

    Without groups, or with ``few`` (their number is bounded by what they mean, as that of zip prefixes), the buckets that hold a
    rank are sent to the tasks that read the rows, so that the other rows are not shuffled.
    """
    by = list(by)
    # At most one row per group and rank.
    sent = F.broadcast if few or not by else lambda df: df
    wanted = [f"_r{i}" for i in range(len(ranks))]
    firsts = [f"CAST({rank} AS BIGINT)" for rank in ranks]

    def narrow(buckets: DataFrame, size: str, places: Sequence[str], keep: Sequence[str]) -> DataFrame:
        # Rows a rank falls into, with the rank counted from the start of the row. The filter comes
        # before the projection: a filter over its results makes the optimizer's constraint sets explode.
        falls = [f"{place} >= _at AND {place} < _at + {size}" for place in places]
        relative = [f"CASE WHEN {f} THEN {p} - _at END AS {r}" for f, p, r in zip(falls, places, wanted)]
        return buckets.where(" OR ".join(f"({f})" for f in falls)).selectExpr(*keep, *relative)

    everything = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in by)})" if by else "OVER ()"
    coarse = counts.selectExpr("*", _COARSE)
    first = coarse.groupBy(*by, "_b").agg(F.expr("sum(_c) AS _n"), F.expr("min(_v) AS _lo"), F.expr("max(_v) AS _hi"))
    first = first.selectExpr("*", f"sum(_n) {everything} AS _total", f"{_before('_n', by, '_b')} AS _at")
    first = narrow(first, "_n", firsts, [*by, "_b", "_lo", "_hi", "_total"])

    near = match(coarse, sent(first), [*by, "_b"]).selectExpr(*by, "_b", "_v", "_c", "_total", _FINE, *wanted)
    same = [F.max(c).alias(c) for c in ["_total", *wanted]]
    near = near.groupBy(*by, "_b", "_f", "_v").agg(F.sum("_c").alias("_c"), *same)
    second = near.groupBy(*by, "_b", "_f").agg(F.expr("sum(_c) AS _n"), *[F.expr(f"max({r}) AS {r}") for r in wanted])
    second = second.selectExpr("*", f"{_before('_n', [*by, '_b'], '_f')} AS _at")
    second = narrow(second, "_n", wanted, [*by, "_b", "_f"])

    last = match(near.drop(*wanted), sent(second), [*by, "_b", "_f"])
    last = last.selectExpr("*", f"{_before('_c', [*by, '_b', '_f'], '_v')} AS _at")
    return narrow(last, "_c", wanted, [*by, "_v", "_total"])


def smallest(df: DataFrame, n: int, by: Column, ties: Sequence[str]) -> DataFrame:
    """The n rows with the smallest ``by`` (a long), of equals those first in ``ties``.

    The n-th value is found from bucket counts, and rows beyond it are filtered where they are read, so
    about n rows in all reach the final sort, however many tasks there are.
    """
    bound = locate(values(df, by), [f"least({int(n)}, _total) - 1"]).select("_v0").scalar()
    return df.where(by.isNull() | (by <= bound)).orderBy(by.asc_nulls_last(), *ties).limit(n)


def _at_rank(i: int, condition: str = "TRUE") -> str:
    return f"max(CASE WHEN _r{i} IS NOT NULL AND {condition} THEN _v END)"


def locate(counts: DataFrame, ranks: Sequence[str], by: Sequence[str] = (), few: bool = False) -> DataFrame:
    """One row per group: ``_total`` and for rank i its value ``_v{i}`` and ``_skip{i}``, the number of
    equal values that come before the rank."""
    found = [F.expr("max(_total) AS _total")]
    for i in range(len(ranks)):
        found += [F.expr(f"{_at_rank(i)} AS _v{i}"), F.expr(f"max(_r{i}) AS _skip{i}")]
    return hits(counts, ranks, by, few).groupBy(*by).agg(*found)


def _neighbours(probs: Sequence[float]) -> list[str]:
    return [f"{side}((_total - 1) * {float(p)!r}D)" for p in probs for side in ("floor", "ceil")]


def _interpolated(i: int, p: float, condition: str = "TRUE") -> str:
    low, high = (f"CAST({_at_rank(2 * i + k, condition)} AS DOUBLE)" for k in (0, 1))
    total = f"max(CASE WHEN {condition} THEN _total END)"
    place = f"({total} - 1) * {float(p)!r}D"
    return f"{low} + ({high} - {low}) * ({place} - floor({place}))"


def percentiles(
    df: DataFrame, value, probs: Mapping[str, float], by: Sequence[str] = (), weight: str = "1"
) -> DataFrame:
    """Exact percentiles with linear interpolation, one output column per entry of ``probs``."""
    found = hits(values(df, value, by, weight), _neighbours(list(probs.values())), by)
    out = [F.expr(_interpolated(i, p)).alias(name) for i, (name, p) in enumerate(probs.items())]
    return found.groupBy(*by).agg(*out)


def medians(
    df: DataFrame, columns: Mapping[str, str], by: Sequence[str] = (), weight: str = "1", few: bool = False
) -> DataFrame:
    """Exact medians of several columns in one pass; ``columns`` maps source to output name."""
    cells = ", ".join(f"struct('{c}' AS _name, CAST(`{c}` AS DOUBLE) AS _value)" for c in columns)
    long = df.selectExpr(*by, f"{weight} AS _weight", f"inline(array({cells}))")
    # Without groups of the caller's there is one per column.
    found = hits(values(long, "_value", [*by, "_name"], "_weight"), _neighbours([0.5]), [*by, "_name"], few or not by)
    out = [F.expr(_interpolated(0, 0.5, f"_name = '{c}'")).alias(name) for c, name in columns.items()]
    return found.groupBy(*by).agg(*out)


def running_counts(values: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``{c}_upto``: the sum of c over all values up to and including ``_v``, per group.

    ``values`` has one row per group and value. Two bucket levels give the offsets, so the last window
    only sees the distinct values of one fine bucket.
    """
    by = list(by)
    sums = [F.expr(f"sum({c}) AS {c}") for c in columns]
    offsets = [f"_{c}_off" for c in columns]
    coarse = values.selectExpr("*", _COARSE)
    first = (
        coarse.groupBy(*by, "_b")
        .agg(*sums, F.expr("min(_v) AS _lo"), F.expr("max(_v) AS _hi"))
        .selectExpr(*by, "_b", "_lo", "_hi", *[f"{_before(c, by, '_b')} AS {o}" for c, o in zip(columns, offsets)])
    )
    placed = match(coarse, first, [*by, "_b"]).selectExpr("*", _FINE).drop("_lo", "_hi")
    second = (
        placed.groupBy(*by, "_b", "_f")
        .agg(*sums, *[F.expr(f"max({o}) AS {o}") for o in offsets])
        .selectExpr(
            *by, "_b", "_f", *[f"{o} + {_before(c, [*by, '_b'], '_f')} AS {o}" for c, o in zip(columns, offsets)]
        )
    )
    last = match(placed.drop(*offsets), second, [*by, "_b", "_f"])
    upto = [f"{o} + {_before(c, [*by, '_b', '_f'], '_v')} + {c} AS {c}_upto" for c, o in zip(columns, offsets)]
    return last.selectExpr(*values.columns, *upto)
