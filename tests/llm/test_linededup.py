"""Winnowing guarantees, and deleted lines against a brute-force version."""

import random

import pytest

from parcelwise.llm import linededup


def plain(docs, least):
    """Lines to delete per document: every window met before goes, with all equal lines around it."""
    seen, cut = {}, {}
    bodies = []
    for name, text in docs:
        lines = [(n, " ".join(x.split())) for n, x in enumerate((text or "").encode().decode().split("\n"))]
        bodies.append([(n, x) for n, x in lines if x.strip(" \t\n\x0b\x0c\r")])
    for d, own in enumerate(bodies):
        for start in range(len(own)):
            stop, size = start, 0
            while stop < len(own) and size < least:
                size += len(own[stop][1].split(" "))
                stop += 1
            if size < least:
                break
            content = tuple(x for _, x in own[start:stop])
            if content not in seen:
                seen[content] = (d, start, stop)
                continue
            d0, start0, stop0 = seen[content]
            other = bodies[d0]
            ahead = back = 0
            while stop + ahead < len(own) and stop0 + ahead < len(other) and own[stop + ahead][1] == other[stop0 + ahead][1]:
                ahead += 1
            while start - back > 0 and start0 - back > 0 and own[start - back - 1][1] == other[start0 - back - 1][1]:
                back += 1
            low = max(start - back, stop0) if d == d0 else start - back
            if low < stop + ahead:
                cut.setdefault(docs[d][0], set()).update(range(own[low][0], own[stop + ahead - 1][0] + 1))
    return cut


def lines_of(row):
    return {n for s in row["spans"] for n in range(s["first"], s["last"] + 1)}


@pytest.mark.parametrize("seed", range(4))
def test_random_documents(spark, seed):
    draw = random.Random(seed)
    phrases = [" ".join(draw.choices("abcdefgh", k=draw.randrange(1, 9))) for _ in range(14)] + ["", " \t"]
    docs = [(i, "\n".join(draw.choices(phrases, k=draw.randrange(25)))) for i in range(60)]
    docs += [(100, docs[5][1]), (101, docs[7][1] + "\n" + docs[5][1]), (102, "a b c\n" * 30), (103, "a b\nc\n" * 20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: lines_of(r) for r in linededup.deduplicated(df, min_words=12).collect()}
    want = plain(docs, 12)
    assert {k: v for k, v in got.items() if v} == want


def test_windows_choose_the_same_line_wherever_they_stand():
    draw = random.Random(2)
    shared = [" ".join(draw.choices("abcdefghijkl", k=draw.randrange(1, 12))) for _ in range(40)]
    text = lambda: "\n".join([f"own {draw.random()}" for _ in range(draw.randrange(9))] + shared).encode()
    chosen = [{(w[0], w[2]) for w in linededup.windows_of(text(), 20)} for _ in range(5)]
    common = set.intersection(*chosen)
    assert {c for _, c in common} and all(len({f for f, c in s if c == k}) == 1 for s in chosen for _, k in common)


PASSAGE = " ".join(f"w{i}" for i in range(51))


def test_a_passage_of_51_words_goes_where_it_comes_again(spark):
    rows = [(2, f"b\n{PASSAGE}\nend"), (1, f"a\n{PASSAGE}"), (3, f"{PASSAGE}"), (3, f"{PASSAGE}"), (4, None), (5, ""), (6, "short\nshort"), (None, "x")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, spans int")
    got = [(r["doc_id"], r["kept_text"], r["n_lines"], r["n_removed"]) for r in linededup.deduplicated(df).collect()]
    want = [
        (2, "b\nend", 3, 1), (1, f"a\n{PASSAGE}", 2, 0), (3, "", 1, 1), (3, "", 1, 1), (4, None, 0, 0), (5, "", 1, 0),
        (6, "short\nshort", 2, 0), (None, "x", 1, 0),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert linededup.deduplicated(df.limit(0)).count() == 0


def test_a_null_id_comes_first(spark):
    df = spark.createDataFrame([(1, PASSAGE), (None, PASSAGE + "\nmore")], "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in linededup.deduplicated(df).collect()}
    assert got == {1: "", None: PASSAGE + "\nmore"}


def test_whole_table(spark, small):
    from parcelwise.llm.queries import op10_linededup

    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = {}
    for r in op10_linededup(spark, small).collect():
        spans = [p.split(":") for p in r["removed_lines"].split(",") if p]
        got[r["doc_id"]] = {n for a, b in spans for n in range(int(a), int(b) + 1)}
        assert len(got[r["doc_id"]]) == r["n_removed"]
    assert {k: v for k, v in got.items() if v} == plain(docs, linededup.MIN_WORDS)
