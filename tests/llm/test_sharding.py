"""The permutation as plain Python, and the law of the shards."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelwise.llm import sharding


def permuted(number, total, seed, sign=1):
    a = max(1, next(x for x in range(total + 2) if x * x >= total))
    b = max(1, -(-total // a))
    keys = list(enumerate(sharding.round_keys(seed)))

    def mix(v, k1, k2):
        v = (v + k1) % sharding.PRIME
        v = (v * v + k2) % sharding.PRIME
        return v * v % sharding.PRIME

    while True:
        left, right = divmod(number, b)
        for i, (k1, k2) in keys if sign > 0 else reversed(keys):
            if i % 2 == 0:
                left = (left + sign * mix(right, k1, k2)) % a
            else:
                right = (right + sign * mix(left, k1, k2)) % b
        number = left * b + right
        if number < total:
            return number


@pytest.mark.parametrize("total", [1, 2, 3, 5, 17, 100, 997])
def test_every_place_once_and_back_again(spark, total):
    n = F.lit(total).cast("long")
    there = sharding.permuted(F.col("id"), n, 3)
    rows = spark.range(total).withColumn("p", there).withColumn("back", sharding.permuted(F.col("p"), n, 3, -1)).collect()
    assert sorted(r["p"] for r in rows) == list(range(total))
    assert all(r["back"] == r["id"] and r["p"] == permuted(r["id"], total, 3) for r in rows)
    assert total < 100 or sum(abs(r["p"] - r["id"]) < 3 for r in rows) < total / 5


@pytest.mark.parametrize("shards", [1, 3, 8, 50])
def test_shards_are_even_and_gapless(spark, shards):
    df = spark.range(101).selectExpr("id AS doc_id", "repeat('x', CAST(id AS INT)) AS text", "'old' AS shard")
    rows = sharding.shard(df, shards).collect()
    assert len(rows) == 101 and set(rows[0].asDict()) == {"doc_id", "text", "shard", "slot"}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(i, 0) for i in range(shards)) <= 1


def test_the_place_depends_on_content_alone(spark):
    df = spark.range(500).selectExpr("id AS doc_id", "id % 7 AS size")
    place = lambda d: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(d, 8, 5).collect()}
    first = place(df.repartition(7))
    assert first == place(df.coalesce(1).orderBy(F.desc("doc_id")))
    assert first != {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(df, 8, 6).collect()}


def test_equal_rows_nulls_and_empty_tables(spark):
    rows = [(1, 5)] * 300 + [(None, None)] * 20 + [(2, None), (None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, size long")
    got = sharding.shard(df, 8).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter(rows)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(rows)
    assert sharding.shard(df.limit(0), 8).count() == 0
