"""Measures against plain Python; fences that adapt; the query against its SQL."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelwise.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n, repeat = len(words), len(hit)
    measures = (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat)
    return (*measures, n < 50 or 100 * repeat > 50 * n)


TEXTS = [
    None, "", " \n\t", "one", "a b c a b c", "a b c x a b c y a b c", "x x x x x", "a b a b a b a", "é ü ß", "#$ %& <|>",
    "l1\nl1\nl2\n \nl1\n", "\x0b\x0c\r", " nbsp em", "😀 😀 😀 😀 😀", "w " * 500, " ".join(map(str, range(300))),
    " ".join(str(i % 97) for i in range(5000)), "x" * 100_000,
]


@pytest.mark.parametrize("bits", [24, 3])
def test_measures(spark, monkeypatch, bits):
    """With few bits for places, texts take the way of the whole hash."""
    monkeypatch.setattr(quality, "PLACE_BITS", bits)
    df = spark.createDataFrame([(i, t, "en", "s", "mine") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_words string")
    names = [*quality.MEASURES, "base_failed"]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in quality.measured(df).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == plain(t), repr(t)[:60]


def table(spark):
    rows = []
    for i in range(600):
        lang, source = ("en", f"s{i % 3}") if i % 2 else ("xx", None)
        words = [("ab" if lang == "en" else "abcdefghij") + str((i * 7 + k * k) % 1009) for k in range(60 + i % 50)]
        if i % 50 == 7:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), lang, source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_fences_adapt_to_language_and_source(spark):
    measured = quality.measured(table(spark))
    found = quality.judged(measured, quality.fences(quality.sketches(measured), min_group=50))
    rows = found.collect()
    assert len(rows) == 600
    assert {r["doc_id"] for r in rows if not r["kept"]} == {i for i in range(600) if i % 50 == 7}


def test_sketches_merge(spark):
    """Sketches of two halves add up to the sketch of the whole."""
    measured = quality.measured(table(spark))
    whole = {tuple(r)[:4]: r["n"] for r in quality.sketches(measured).collect()}
    halves = Counter()
    for part in (measured.where("doc_id < 100"), measured.where("doc_id >= 100")):
        for r in quality.sketches(part).collect():
            halves[tuple(r)[:4]] += r["n"]
    assert dict(halves) == whole


def test_quartiles_are_close(spark):
    measured = quality.measured(table(spark))
    got = quality._quartiles(quality.sketches(measured), []).where("ratio = 'word_length'").first()
    exact = measured.where("NOT base_failed").select(
        F.percentile(F.col("word_chars") / F.col("n_words"), [0.25, 0.75]).alias("q")
    ).first()["q"]
    assert got["q1"] == pytest.approx(exact[0], rel=0.03) and got["q3"] == pytest.approx(exact[1], rel=0.03)


def test_no_python_and_no_cross_join(spark, small):
    from parcelwise.llm.queries import op2_quality

    plan = op2_quality(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Cartesian", "NestedLoop") if w in plan]


def test_empty_tables_and_groups_that_fail(spark):
    df = spark.createDataFrame([(1, "too short", None, "s"), (1, "too short", None, "s")], "doc_id long, text string, lang string, source string")
    for part, n in ((df, 2), (df.limit(0), 0)):
        measured = quality.measured(part)
        got = quality.judged(measured, quality.fences(quality.sketches(measured))).collect()
        assert len(got) == n and not any(r["kept"] for r in got)
