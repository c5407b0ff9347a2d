"""Connected components of a table of links, by rounds of joins.

Alternating rounds in the way of large star and small star: in each, every node is tied to the least node it knows
of, first its greater neighbours, then the lesser ones. Rounds go on until the links no longer change; their number grows
with the logarithm of the longest path. A hub's links never meet in one task: minima are
taken before the shuffle, and adaptive execution splits the hub's key in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.session import cut_lineage


def _sum_of(edges: DataFrame):
    """A digest of the links and their number: equal when a round has changed nothing."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its greater neighbours to the least node among its neighbours and itself."""
    both = edges.select("u", "v").unionAll(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its lesser neighbours and itself to the least of them; links run from greater to lesser."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
    return moved.unionAll(least.selectExpr("u", "m AS v")).distinct()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for all nodes that have a link."""
    edges = links.where(f"`{a}` <> `{b}`").selectExpr(f"greatest(`{a}`, `{b}`) AS u", f"least(`{a}`, `{b}`) AS v")
    edges = cut_lineage(edges.distinct(), "components-links")
    state = _sum_of(edges)
    while state[0]:
        edges = cut_lineage(_small_star(_large_star(edges)), "components-links")
        now = _sum_of(edges)
        if now == state:
            break
        state = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.selectExpr("u AS node", "root").unionAll(edges.selectExpr("v AS node", "v AS root").distinct())
