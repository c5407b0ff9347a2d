"""The FM-index against plain search; hits, items and spans against a brute-force version."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import fmindex


@pytest.mark.parametrize("seed", range(6))
def test_search_and_locate(seed):
    draw = np.random.default_rng(seed)
    largest = [1, 2, 3, 9, 40, 7][seed]
    text = draw.integers(0, largest + 1, [1, 5, 60, 400, 400, 2][seed])
    text[-1] = 0
    order = fmindex.suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = fmindex.FmIndex(text, largest, sampled=3)
    for length in (1, 2, 3):
        phrases = np.array(list({tuple(draw.integers(1, largest + 1, length).tolist()) for _ in range(30)}))
        which, low, high = index.search(phrases)
        found = {}
        for w, a, b in zip(which, low, high):
            found[w] = sorted(index.locate(np.arange(a, b)).tolist())
        for i, p in enumerate(phrases.tolist()):
            want = [k for k in range(len(text) - length + 1) if text[k : k + length].tolist() == p]
            assert found.get(i, []) == want


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def plain(docs, items):
    out = []
    for _, text in docs:
        own, hit, names = words(text), set(), set()
        for name, item in items:
            w = words(item)
            size = min(13, len(w))
            for i in range(len(w) - size + 1 if w else 0):
                for k in range(len(own) - size + 1):
                    if own[k : k + size] == w[i : i + size]:
                        hit.update(range(k, k + size))
                        names.add(str(name) if name is not None else "null")
        out.append((len(own), len(hit), sorted(names)))
    return out


def cases():
    draw = random.Random(5)
    vocabulary = ["alpha", "Beta", "g7", "é", "漢字", "the", "of", "x_y", "a-b"]
    say = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(i, say(draw.choice([20, 30, 13, 14]))) for i in range(12)]
    items += [(50, "only seven words are in this item"), (51, None), (52, "..."), (None, say(15)), (53, items[0][1]), (9, items[3][1].upper())]
    docs = [(i, say(draw.randrange(60))) for i in range(40)]
    docs += [(100 + i, say(5) + ", " + items[i % 14][1].replace(" ", " \n") + "!" + say(9)) for i in range(14) if items[i % 14][1]]
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1]), (None, items[1][1] * 3), (203, " ".join(items[0][1].split()[:12]))]
    docs += [(204, "only SEVEN words  are in this item only"), (205, (items[2][1] + " zzz ") * 300)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [fmindex.BLOCK_BYTES, 400])
def test_hits_items_and_spans(spark, monkeypatch, block_bytes):
    """In one pass, and with the benchmark cut into blocks that meet again."""
    monkeypatch.setattr(fmindex, "SHARD_BYTES", 700)
    docs, items = cases()
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = fmindex.decontaminated(df, bench, block_bytes=block_bytes).withColumn("clean", fmindex.without_spans(F.col("text"), F.col("spans"))).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = sorted(((*d, *p) for d, p in zip(docs, plain(docs, items))), key=key)
    found = sorted(((r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=key)
    assert found == want
    for r in got:
        inside = "".join((r["text"] or "")[s["start"] : s["end"]] + " " for s in r["spans"])
        assert len(words(inside)) == r["n_hit"]
        assert len(words(r["clean"])) == r["n_words"] - r["n_hit"] or not r["spans"]


def test_empty_sides(spark):
    docs, items = cases()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert fmindex.decontaminated(df.limit(0), bench).count() == 0
    rows = fmindex.decontaminated(df, bench.limit(0)).collect()
    assert len(rows) == len(docs) and all(r["n_hit"] == 0 and r["items"] == [] for r in rows)
    verdicts = df.limit(4).select(F.lit(20).alias("n_words"), F.monotonically_increasing_id().alias("n_hit")).withColumn("c", fmindex.contaminated())
    assert [r["c"] for r in verdicts.collect()] == [False, True, True, True]
