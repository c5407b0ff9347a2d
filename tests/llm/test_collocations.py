"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelwise.llm import collocations


def pieces_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", low)]


def plain(docs, least, most, best, covered):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for words in pieces_of(text):
            n[lang or "und"] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f[(lang or "und", tuple(words[i : i + size]))] += 1
    some = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in some.items():
        inside = lambda longer: any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        if any(k[0] == lang and len(k[1]) > len(words) and 100 * b >= covered * a and inside(k[1]) for k, b in some.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -s)
        for lang, rows in out.items()
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:best], 1)
    )


def fixture(seed):
    draw = random.Random(seed)
    stock = [f"w{i}" for i in range(40)] + ["É", "😀x", "it's", "\x1cq"]
    fixed = ["new york city", "of the", "a b c d e", "New York"]
    blanks = [" ", " ", "  ", "\t", ". ", ",", "\n", " \x0b", "!?"]
    some = lambda n: "".join(draw.choice([draw.choice(stock), draw.choice(fixed)]) + draw.choice(blanks) for _ in range(n))
    docs = [(draw.choice(["en", "en", "de", None]), some(draw.randrange(60))) for _ in range(150)]
    return [*docs, ("en", None), ("en", ""), ("fr", ". , !"), ("en", "x y " * 3000), ("und", "of the " * 30), ("en", "p q. " * 2000)]


@pytest.mark.parametrize("size,most,least", [(1 << 21, 3, 10), (300, 3, 4), (1000, 2, 5), (500, 4, 3), (2000, 5, 3)])
def test_phrases_equal_plain_counts(spark, size, most, least, monkeypatch):
    docs = fixture(size)
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS phrase", "2 AS n", "'x' AS words").repartition(3)
    got = collocations.mined(df, least, most, 50, 50, size)
    want = plain(docs, least, most, 50, 50)
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect()) == want
    assert len(want) > 60


def test_more_bits_than_needed_change_nothing(spark, monkeypatch):
    docs = fixture(9)
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(collocations, "FILTER_BITS", (6, 6))  # 64 bits for everything: nearly all pass
    got = collocations.mined(df, 6, 3, 40)
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect()) == plain(docs, 6, 3, 40, 50)


def test_intervals_of_both_directions_count_all_phrases():
    draw = np.random.default_rng(1)
    symbols = np.append(draw.integers(0, 6, 4000), 0)
    words = [w.split() for w in " ".join(map(str, symbols)).split("0")]
    for depth in (2, 3, 4, 5):
        for size, found in enumerate(collocations.enumerated(symbols, 5, depth), 2):
            want = Counter(tuple(map(int, w[i : i + size])) for w in words for i in range(len(w) - size + 1))
            assert dict(zip(map(tuple, found.words.tolist()), found.count.tolist())) == want


def test_long_texts_are_cut_between_pieces_and_empty_tables_give_none(spark):
    text = b"ab cd, ef gh. " * 100
    assert b",".join(collocations.parts(text, 30)).replace(b".", b",") == text.replace(b".", b",")
    assert all(len(p) < 50 for p in collocations.parts(text, 30))
    assert list(collocations.parts(b"x " * 100, 10)) == [b"x " * 100]
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.mined(empty).collect() == []
