"""SimHash classes against a brute-force version; the guarantee of the masks."""

import random
import re

import numpy as np
import pytest
import xxhash

from parcelwise.llm import simhash
from parcelwise.llm.components import connected


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, ids, radius=3):
    """The least id reachable from each row."""
    group = list(range(len(prints)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                group[max(top(i), top(j))] = min(top(i), top(j))
    best = {}
    for i, x in enumerate(ids):
        if x is not None:
            best[top(i)] = min(x, best.get(top(i), x))
    return [best.get(top(i)) for i in range(len(prints))]


def test_every_pair_within_the_radius_collides():
    draw = random.Random(1)
    for radius in (1, 2, 3):
        masks = simhash.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            flip = sum(1 << b for b in draw.sample(range(64), radius))
            assert any(flip & m == 0 for m in masks)


def near_prints(seed, groups=12, each=30):
    draw = random.Random(seed)
    out = []
    for _ in range(groups):
        base = draw.getrandbits(64)
        out += [base ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(6))) for _ in range(each)]
    return [p - (1 << 64) if p >> 63 else p for p in dict.fromkeys(out)]


@pytest.mark.parametrize("small", [0, 4, 2048])
def test_both_ways_through_buckets_give_the_classes(spark, small):
    prints = near_prints(3)
    df = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint long")
    got = {r["fingerprint"]: r["component_id"] for r in simhash.grouped(df, 3, small).collect()}
    assert [got[p] for p in prints] == plain_classes([p & (2**64 - 1) for p in prints], range(len(prints)))


def test_forest_spans_with_one_link_per_member():
    members = np.array([0, 1, 3, 7, 255, 254, 3 << 40], dtype=np.uint64)
    a, b = simhash.forest(members, 1)
    assert {frozenset(pair) for pair in zip(a.tolist(), b.tolist())} == {frozenset(p) for p in ((0, 1), (1, 3), (3, 7), (254, 255))}
    assert len(a) == 4


ROWS = [
    (4, "the cat sat on the mat"), (3, "THE cat  sat\ton the mat"), (9, "the cat sat on the mat"), (9, "the cat sat on the mat"),
    (5, None), (6, ""), (None, " \n\x0b"), (7, "a"), (8, "a b"), (None, "lonely words"), (1, "é É"), (2, "é É"),
]


def test_classes_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, fingerprint string")
    got = simhash.classes(df).collect()
    want = plain_classes([plain_fingerprint(t) for _, t in ROWS], [i for i, _ in ROWS])
    found = sorted((str(r["doc_id"]), r["fingerprint"] & (2**64 - 1), str(r["component_id"])) for r in got)
    assert found == sorted((str(i), plain_fingerprint(t), str(c)) for (i, t), c in zip(ROWS, want))
    assert simhash.classes(df.limit(0)).count() == 0
    assert simhash.as_hex is not None


def test_one_row_of_each_group_survives(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    kept = simhash.survivors(df).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(["3", "5", "7", "8", "None", "1"])
    twice = spark.createDataFrame([(9, "one two three four"), (9, "one two three four")], "doc_id long, text string")
    assert simhash.survivors(twice).count() == 1


def test_long_chains_end_in_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (700, 700)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected(links, "a", "b").collect()}
    assert roots == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert connected(links.limit(0), "a", "b").count() == 0


def test_documents_of_a_table(spark, small):
    from parcelwise.llm.queries import op7_simhash

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op7_simhash(spark, small).collect()}
    prints = [plain_fingerprint(r["text"]) for r in docs]
    classes = plain_classes(prints, [r["doc_id"] for r in docs])
    assert got == {r["doc_id"]: (f"{p:016x}", c) for r, p, c in zip(docs, prints, classes)}
