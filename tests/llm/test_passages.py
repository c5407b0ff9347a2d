"""Repeated passages that begin or end inside a line, against a brute-force version."""

import random

import pytest

from parcelwise.llm import passages


def plain(docs, least):
    """Numbers of the words to delete per document: every window of words met before, beyond its own first occurrence."""
    seen, gone = {}, {}
    for name, text in docs:
        words = (text or "").split()
        for start in range(len(words) - least + 1):
            content = tuple(words[start : start + least])
            if content not in seen:
                seen[content] = (name, start)
                continue
            name0, start0 = seen[content]
            begin = max(start, start0 + least) if name == name0 else start
            gone.setdefault(name, set()).update(range(begin, start + least))
    return {n: g for n, g in gone.items() if g}


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed):
    draw = random.Random(seed)
    blanks = [" ", "\n", "\t ", "\n\n"]
    join = lambda words: "".join(w + draw.choice(blanks) for w in words)
    stock = draw.choices(["é", "😀x", *"abcdefghij"], k=300)
    docs = []
    for i in range(60):
        parts = []
        for _ in range(draw.randrange(6)):
            at = draw.randrange(280)
            parts += draw.choice([stock[at : at + draw.randrange(40)], draw.choices("klmnop", k=draw.randrange(20))])
        docs.append((i, join(parts)))
    docs += [(100, "a " * 40), (101, "a b c\n" * 30), (102, None), (103, "")]
    rows = passages.cut(spark.createDataFrame(docs, "doc_id long, text string"), min_words=12).collect()
    want = plain(docs, 12)
    assert want and len(rows) == len(docs)
    for r in rows:
        words = [w for w in passages._WORD.finditer(r["text"] or "")]
        gone = {n for n, w in enumerate(words) if any(s["start"] <= w.start() and w.end() <= s["end"] for s in r["passages"])}
        assert gone == want.get(r["doc_id"], set()) and len(gone) == r["n_passage_words"], r["doc_id"]
        kept = [w.group() for n, w in enumerate(words) if n not in gone]
        assert (r["cut_text"] or "").split() == kept and (r["cut_text"] is None) == (r["text"] is None)


@pytest.mark.parametrize("seed", range(2))
def test_copies_near_copies_and_repeats_inside(spark, seed, monkeypatch):
    """Groups of copies settle as wholes; copies with edits and texts that repeat themselves are compared window by window."""
    monkeypatch.setattr(passages, "OUT_PLACES", 3)
    draw = random.Random(100 + seed)
    words = [f"w{i}" for i in range(400)]
    base = [draw.choices(words, k=draw.randrange(5, 60)) for _ in range(6)]
    docs = []
    for i in range(70):
        own = list(draw.choice(base))
        if draw.random() < 0.4:  # an edit
            own[draw.randrange(len(own))] = f"e{i}"
        if draw.random() < 0.2:
            own = own + draw.choice([own, own[: len(own) // 2], draw.choice(base)])
        if draw.random() < 0.1:
            own = own * 3
        docs.append((None if i == 69 else (i * 37) % 71, " ".join(own)))
    docs.append((200, "a " * 100))
    docs.append((201, "b " + "a " * 100))
    rows = passages.cut(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), min_words=12).collect()
    want = plain(sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)), 12)
    assert len(want) > 40
    for r in rows:
        found = [w for w in passages._WORD.finditer(r["text"])]
        gone = {n for n, w in enumerate(found) if any(s["start"] <= w.start() and w.end() <= s["end"] for s in r["passages"])}
        assert gone == want.get(r["doc_id"], set()), r["doc_id"]


def test_the_query_catches_a_passage_inside_lines(spark, tmp_path):
    from parcelwise.llm.queries import op10_linededup

    words = [f"w{i}" for i in range(53)]
    texts = [f"a start {' '.join(words[:20])}\n{' '.join(words[20:26])}\n{' '.join(words[26:])} and an end", "other\n" + " ".join(words) + " tail"]
    df = spark.createDataFrame([*enumerate(texts), (None, "x"), (1, texts[1])], "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((str(r["doc_id"]), r["n_removed"], r["n_passage_words"], r["passages"]) for r in op10_linededup(spark, str(tmp_path)).collect())
    assert got == [("0", 0, 0, ""), ("1", 0, 53, f"6:{len(texts[1]) - 5}"), ("1", 0, 53, f"6:{len(texts[1]) - 5}"), ("None", 0, 0, "")]
    assert passages.cut(df.limit(0)).count() == 0
