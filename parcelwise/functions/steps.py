"""The largest gap between two empirical distributions, by bounds that are refined.

Both sides are counted per order-preserving bucket where their rows are read. At the end of a bucket the gap between the two running
shares is exact; inside it cannot leave what the bucket's own counts allow. Only buckets that could hold a larger gap
than the largest exact one are cut finer and counted again, until none is left: a bucket of one value is exact. So
what is shuffled is a row per bucket and task, never one per value, and a round never counts more than ``PARTS`` buckets
(or twice the buckets in question, if these are more).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Buckets per doubling of the absolute value in the first round: the double range has 2 * 2098 * COARSE at most.
COARSE = 32
# Buckets counted in a later round.
PARTS = 1 << 16

# Order-preserving bucket by magnitude: needs no look at the data.
BUCKET = f"""CAST(CASE
    WHEN _v = 0 THEN 0
    WHEN _v > 0 THEN floor(log2(_v) * {COARSE}) + {1075 * COARSE}
    ELSE -floor(log2(-_v) * {COARSE}) - {1075 * COARSE} END AS BIGINT)"""
COUNTS = "CAST(sum(ref) AS BIGINT) AS ref", "CAST(sum(cur) AS BIGINT) AS cur", "min(_v) AS lo", "max(_v) AS hi"


@dataclass
class Bucket:
    """Counts of both sides in one bucket and before it, and its least and greatest value."""

    key: tuple
    ref: int
    cur: int
    lo: float
    hi: float
    ref_before: int = 0
    cur_before: int = 0


@dataclass
class Gap:
    """What is known of one group: its sizes, the largest exact gap, and the buckets that may hold a larger one."""

    n_ref: int = 0
    n_cur: int = 0
    largest: float = 0.0
    open: list[Bucket] = field(default_factory=list)

    def at(self, ref: int, cur: int) -> float:
        return abs(ref / self.n_ref - cur / self.n_cur)

    def walk(self, buckets: list[Bucket], ref: int, cur: int) -> None:
        """Take in ascending buckets that follow ``ref`` and ``cur`` smaller values."""
        for b in buckets:
            b.ref_before, b.cur_before = ref, cur
            ref, cur = ref + b.ref, cur + b.cur
            self.largest = max(self.largest, self.at(ref, cur))
        self.open += buckets

    def close(self) -> None:
        """Leave only buckets of several values that could hold a larger gap."""
        most = lambda b: max(
            self.at(b.ref_before, b.cur_before + b.cur), self.at(b.ref_before + b.ref, b.cur_before)
        )
        self.open = [b for b in self.open if b.lo < b.hi and most(b) > self.largest]


def first_counts(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of (by, _v, ref, cur) counted per coarse bucket."""
    return cells.groupBy(*by, F.expr(BUCKET).alias("_b")).agg(*map(F.expr, COUNTS))


def rows_of(counts: DataFrame) -> list[Row]:
    """Bucket counts on the driver: a row per bucket in question."""
    return counts.collect()


def largest_gaps(
    counts: DataFrame, enter: Callable[[DataFrame], DataFrame], by: Sequence[str]
) -> dict[tuple, Gap]:
    """The exact largest gap of every group that has values on both sides.

    ``counts``: as of :func:`first_counts`. ``enter`` joins the rows with a table of (by, _b, _id) of the buckets
    in question, which is small, and gives (_id, _v, ref, cur) of the rows inside them.
    """
    gaps: dict[tuple, Gap] = {}
    found: dict[tuple, list[Bucket]] = {}
    for row in rows_of(counts):
        group = tuple(row[c] for c in by)
        found.setdefault(group, []).append(Bucket((*group, row["_b"]), row["ref"], row["cur"], row["lo"], row["hi"]))
    for group, buckets in found.items():
        gap = Gap(sum(b.ref for b in buckets), sum(b.cur for b in buckets))
        if gap.n_ref and gap.n_cur:
            gap.walk(sorted(buckets, key=lambda b: b.key[-1]), 0, 0)
            gap.close()
            gaps[group] = gap
    kinds = {f.name: f.dataType.simpleString() for f in counts.schema.fields}
    spark, placed = counts.sparkSession, None
    while any(g.open for g in gaps.values()):
        asked = [(g, b) for g in gaps.values() for b in g.open]
        parts = max(2, min(4096, PARTS // len(asked)))
        if placed is None:
            keys = ", ".join(f"`{c}` {kinds[c]}" for c in (*by, "_b"))
            table = spark.createDataFrame([(*b.key, i) for i, (_, b) in enumerate(asked)], f"{keys}, _id LONG")
            placed = enter(table)
        else:
            table = spark.createDataFrame([(*b.key, i) for i, (_, b) in enumerate(asked)], "_id LONG, _part LONG, _next LONG")
            # One row per bucket in question, so the size of this side is known.
            placed = placed.join(F.broadcast(table), ["_id", "_part"]).selectExpr("_next AS _id", "_v", "ref", "cur")
        edges = spark.createDataFrame([(i, b.lo, b.hi) for i, (_, b) in enumerate(asked)], "_id LONG, _lo DOUBLE, _hi DOUBLE")
        part = f"CAST(least(floor((_v - _lo) / (_hi - _lo) * {parts}), {parts - 1}) AS BIGINT) AS _part"
        placed = placed.join(F.broadcast(edges), "_id").selectExpr("_id", part, "_v", "ref", "cur")
        finer: dict[int, list[Bucket]] = {}
        for row in rows_of(placed.groupBy("_id", "_part").agg(*map(F.expr, COUNTS))):
            bucket = Bucket((row["_id"], row["_part"]), row["ref"], row["cur"], row["lo"], row["hi"])
            finer.setdefault(row["_id"], []).append(bucket)
        for gap in gaps.values():
            gap.open = []
        for i, (gap, b) in enumerate(asked):
            gap.walk(sorted(finer[i], key=lambda x: x.key), b.ref_before, b.cur_before)
        for gap in gaps.values():
            gap.close()
    return gaps


def kolmogorov_p(distance: float, n_ref: int, n_cur: int) -> float:
    """The asymptotic p-value of a distance."""
    lam = distance * math.sqrt(n_ref * n_cur / (n_ref + n_cur))
    if lam < 0.2:
        return 1.0
    series = 2 * sum((1 if j % 2 else -1) * math.exp(-2.0 * j * j * lam * lam) for j in range(1, 101))
    return max(0.0, min(1.0, series))
