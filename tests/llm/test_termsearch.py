"""Pipelined term search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelwise.llm import termsearch

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def plain(docs, items, best):
    bodies = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    bodies = [b for b in bodies if b[2]]
    count, words = len(bodies), sum(b[2] for b in bodies)
    df = Counter(t for _, own, _ in bodies for t in own)
    out = []
    for item, text in set(items):
        found = []
        for doc, own, n in bodies:
            m = 100 - 25 + (25 * n * count) // words
            score = 0
            for t in terms(text):
                if own[t]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * own[t]) // (1000 * own[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is not None, doc or 0))
        out += [(item, rank, d if named else None, -s) for rank, (s, named, d) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=str)


def fixture(seed, size=400):
    draw = random.Random(seed)
    stock = [f"w{i}" for i in range(60)] + ["É", "naïve", "😀x", "A1"]
    weights = [1 / (i + 1) for i in range(len(stock))]
    text = lambda n: "".join(w + draw.choice([" ", ". ", "\n", "-"]) for w in draw.choices(stock, weights, k=n))
    docs = [(i, text(draw.randrange(40))) for i in range(size)]
    docs += [(900, None), (901, ""), (902, "?! "), (None, "w1 w2 w50"), (7, docs[7][1]), (7, docs[7][1])]
    docs += [(1000 + i, "w55 w56 W57") for i in range(30)] + [(2000, "w3 " * 5000)]
    items = [(i, text(draw.choice([1, 2, 5, 30]))) for i in range(25)]
    items += [(50, "w55 w56 w57 w55"), (51, None), (52, " "), (53, "unknown"), (50, "w55 w56 w57 w55"), (None, "w1"), (54, "w0")]
    return docs, items


@pytest.mark.parametrize("owners,shard_bytes,block_bytes", [(4, 1 << 25, 1 << 23), (3, 700, 1 << 23), (1, 2000, 1 << 23), (5, 900, 900)])
def test_every_rank_equals_brute_force(spark, owners, shard_bytes, block_bytes):
    docs, items = fixture(owners)
    bodies = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS score", "3 AS term")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS rank")
    got = termsearch.ranked(bodies.repartition(3), asked, 7, owners=owners, shard_bytes=shard_bytes, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain(docs, [i for i in items if i[1] is not None], 7)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 100


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    items = spark.createDataFrame([("x", "b")], "item_id string, text string")
    assert [tuple(r)[:3] for r in termsearch.ranked(docs, items).collect()] == [("x", 1, 1)]
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), items)):
        assert termsearch.ranked(a, b).collect() == []


def test_stages_drop_what_cannot_win():
    # One rare term decides; the frequent one cannot lift another document over the first two.
    plan = termsearch.Plan([Counter({0: 1, 1: 1})], {0: (3, 40), 1: (900, 1)}, 1000, 100_000, 2)
    assert plan.owner == {0: 0, 1: 1} and plan.above[2] == [0] and plan.above[0] > plan.above[1]
    import pyarrow as pa

    docs = [np.arange(1000), np.array([1, 2, 3]), np.arange(900)]
    tfs = [np.full(1000, 100), np.array([40, 40, 1]), np.full(900, 1)]
    own = lambda *at: pa.table({
        "term": pa.array([at_ - 1 for at_ in at], pa.int32()),
        "doc": termsearch.as_lists([docs[a] for a in at], pa.int32()),
        "tf": termsearch.as_lists([tfs[a] for a in at], pa.int32()),
    })
    none = pa.table({"item": pa.array([], pa.int32()), "doc": pa.array([], pa.list_(pa.int32())), "score": pa.array([], pa.list_(pa.int64()))})
    ((item, doc, score),) = termsearch.pass_owner(plan, 0, 2, none, own(0, 1))
    assert doc.tolist() == [1, 2]  # the third cannot come up to them
    carried = pa.table({"item": pa.array([item], pa.int32()), "doc": termsearch.as_lists([doc], pa.int32()), "score": termsearch.as_lists([score], pa.int64())})
    ((_, doc, _),) = termsearch.pass_owner(plan, 1, 2, carried, own(0, 2))
    assert doc.tolist() == [1, 2]  # and the frequent term opens no new ones
