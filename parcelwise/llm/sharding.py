"""A reproducible shuffle into shards: a permutation of the row numbers that can be computed row by row.

Rows get global numbers that depend on their content alone, not on files or tasks. A Feistel network over
two mixed-radix halves (a x b >= rows, a and b near the root) permutes the numbers; a result beyond the last
row walks on until it falls inside. Position p then is slot p div n of shard p mod n, so the counts of the shards differ by one
at most, and any row's place, or the row at any place, follows from the number of rows, the seed and n.

Defined cases: equal rows get numbers of their own; null columns count as a value of their own; an empty
table gives an empty table; columns named like the results are replaced.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import without

# Rows are numbered within buckets of their digest; one row per bucket is all that meets in one task.
BUCKETS = 16384
ROUNDS = 8
# A prime below 2^31: squares of residues stay within a long.
PRIME = 2147483647


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Two residues for each round."""
    draw = random.Random(seed)
    return [(draw.randrange(1, PRIME), draw.randrange(1, PRIME)) for _ in range(rounds)]


def _mix(value: Column, keys: Column) -> Column:
    """The round function: shift and square twice, modulo the prime."""
    once = F.pmod(value + keys["k1"], F.lit(PRIME).cast("long"))
    once = F.pmod(once * once + keys["k2"], F.lit(PRIME).cast("long"))
    return F.pmod(once * once, F.lit(PRIME).cast("long"))


def _keys(seed: int, backwards: bool = False) -> Column:
    rounds = list(enumerate(round_keys(seed)))
    cells = [
        F.struct(F.lit(i % 2 == 0).alias("left"), F.lit(k1).cast("long").alias("k1"), F.lit(k2).cast("long").alias("k2"))
        for i, (k1, k2) in (reversed(rounds) if backwards else rounds)
    ]
    return F.array(*cells)


def _network(number: Column, a: Column, b: Column, seed: int, sign: int) -> Column:
    """One pass over the pair (number div b, number mod b); sign -1 undoes it."""

    def turn(state: Column, key: Column) -> Column:
        left = F.pmod(state["l"] + F.lit(sign) * _mix(state["r"], key), a)
        right = F.pmod(state["r"] + F.lit(sign) * _mix(state["l"], key), b)
        return F.when(key["left"], F.struct(left.alias("l"), state["r"].alias("r"))).otherwise(
            F.struct(state["l"].alias("l"), right.alias("r"))
        )

    first = F.struct(F.floor(number / b).cast("long").alias("l"), F.pmod(number, b).alias("r"))
    return F.aggregate(_keys(seed, sign < 0), first, turn, lambda s: s["l"] * b + s["r"])


def permuted(number: Column, total: Column, seed: int, sign: int = 1) -> Column:
    """Where a row number goes (sign 1) or which number went there (sign -1), both in [0, total).

    Outside [0, total) there are a * b - total < a points, and a walk meets each of them once at most: that
    many steps always suffice. Only the few numbers that leave the range walk at all.
    """
    a = F.greatest(F.ceil(F.sqrt(total.cast("double"))).cast("long"), F.lit(1).cast("long"))
    b = F.greatest(F.floor((total + a - 1) / a).cast("long"), F.lit(1).cast("long"))
    once = _network(number, a, b, seed, sign)
    return F.when(once < total, once).otherwise(
        F.aggregate(
            F.sequence(F.lit(1).cast("long"), a * b - total),
            once,
            lambda at, _: F.when(at < total, at).otherwise(_network(at, a, b, seed, sign)),
        )
    )


def row_digest(columns: list[str]) -> Column:
    """Hex digest of a row's content; nulls differ from every text."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("|", *cells))


def numbered(df: DataFrame, number: str = "_number", total: str = "_total", buckets: int = BUCKETS) -> DataFrame:
    """Global row numbers from 0 without a gap, by (bucket of the digest, columns in order).

    Equal rows are counted before any shuffle and unfolded at the end, so a row repeated very often never
    gathers in a task. The offsets of the buckets are one row each (``buckets`` bounds the broadcast).
    """
    columns = df.columns
    cells = [F.col(f"`{c}`") for c in columns]
    rows = df.groupBy(*cells).agg(F.count(F.lit(1)).alias("_copies"))
    bucket = F.conv(F.substring(row_digest(columns), 1, 7), 16, 10).cast("long") % buckets
    rows = rows.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.sum("_copies").alias("_size"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
            F.sum("_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(offsets), "_bucket")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))
    return placed.select(
        *cells, (F.col("_start") + F.col("_before")).alias("_first"), F.col("_all").alias(total), copy.alias("_copy")
    ).select(*cells, (F.col("_first") + F.col("_copy")).alias(number), total)


def shard(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """The table with ``shard`` in [0, shards) and ``slot``, gapless from 0 in every shard."""
    if shards < 1:
        raise ValueError("there must be a shard at least")
    rows = numbered(without(df, ["shard", "slot", "_number", "_total"]))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("_number", "_total")]
    at = rows.select(*kept, permuted(F.col("_number"), F.col("_total"), seed).alias("_place"))
    return at.select(
        *kept,
        F.pmod(F.col("_place"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / F.lit(shards)).cast("long").alias("slot"),
    )
