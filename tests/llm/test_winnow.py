"""Places found over many texts at once, against one text and one window at a time."""

import random

import numpy as np
import pytest

from parcelwise.llm import linededup, passages, winnow


def drawn(seed, count=40):
    draw = random.Random(seed)
    stock = ["a", "bb", "é", "😀", "x" * 8, "x" * 9, "y" * 31, "y" * 32, "z" * 33, "z" * 33 + "q", "\x00", "\x00\x00", "\x1c"]
    blanks = [" ", "\n", "\t ", "\n\n", "\r\n", "\x0b", "\x0c"]
    out = ["".join(draw.choice(stock) + draw.choice(blanks) for _ in range(draw.randrange(60))) for _ in range(count)]
    return [t.encode() for t in [*out, "", " \n ", "\nend", out[3]]]


@pytest.mark.parametrize("seed", range(3))
def test_words_and_their_hashes(seed):
    bodies = drawn(seed)
    own = winnow.words_of(bodies)
    plain = [w for b in bodies for w in b.split()]
    assert [own.data[a:b].tobytes() for a, b in zip(own.starts, own.ends)] == plain
    assert [own.first[t + 1] - own.first[t] for t in range(len(bodies))] == [len(b.split()) for b in bodies]
    pairs = set(zip(plain, winnow.hashes_of(own).tolist()))
    assert len(pairs) == len(set(plain)) == len({h for _, h in pairs})


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 31])
def test_least_of_windows(width):
    draw = random.Random(width)
    values = np.array([draw.randrange(9) for _ in range(200)])
    plain = [i + values[i : i + width].tolist().index(min(values[i : i + width])) for i in range(200 - width + 1)]
    assert winnow.least(values, width).tolist() == plain
    ranges = sorted((a, min(200, a + draw.randrange(1, width + 1))) for a in range(200))
    start, stop = np.array(ranges).T
    plain = [max(i for i in range(a, b) if values[i] == min(values[a:b])) for a, b in ranges]
    assert winnow._least_of(values, start, stop).tolist() == plain


@pytest.mark.parametrize("seed", range(3))
def test_many_texts_give_what_each_gives_alone(seed):
    bodies = drawn(seed)
    own = winnow.words_of(bodies)
    hashes = winnow.hashes_of(own)
    found, lines = winnow.word_places(own, hashes, 12), winnow.line_windows(own, hashes, 12)
    together = [[], []]
    for place, body in enumerate(bodies):
        here = own.text[found.start] == place
        together[0].append(list(zip(found.fingerprint[here], found.start[here] - own.first[place], found.size[here], found.whole[here])))
        here = lines.text == place
        low = lines.first[here]
        together[1].append(list(zip(lines.fingerprint[here], lines.chosen[here], lines.content[here], lines.start[here] - low, lines.stop[here] - low)))
    alone = [[], []]
    for body in bodies:
        one = winnow.words_of([body])
        p = winnow.word_places(one, winnow.hashes_of(one), 12)
        alone[0].append(list(zip(p.fingerprint, p.start, p.size, p.whole)))
        alone[1].append(linededup.windows_of(body, 12))
        # Every window of words belongs to one place.
        assert p.size.sum() == max(0, len(body.split()) - 11)
    assert together == alone and any(alone[0]) and any(alone[1])


def test_only_places_that_differ_carry_their_windows(spark):
    """Places whose fingerprint was found once do not leave the texts, and windows are listed only where places differ."""
    words = [f"w{i}" for i in range(120)]
    same, other = " ".join(words), " ".join(f"o{i}" for i in range(60))
    once = "\n".join(f"u{i} v{i}" for i in range(60))
    rows = [(1, same), (2, same), (3, f"{other} left"), (4, f"{other} right"), (5, once), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    places, _ = winnow.found(df, words=50, lines=50)
    found = [(r["lines"], r["doc_id"], r["size"], None if r["windows"] is None else len(r["windows"])) for r in places.collect()]
    assert {d for _, d, _, _ in found} == {1, 2, 3, 4}
    assert {d for lines, d, _, _ in found if lines} == {1, 2}
    plain = [n for lines, d, _, n in found if not lines and d < 3]
    assert plain and set(plain) == {None}
    assert any(n for lines, d, _, n in found if not lines and d > 2)
    assert all(n in (None, size) for lines, _, size, n in found if not lines)


def test_a_passage_that_repeats_in_its_own_text_and_nowhere_else(spark):
    """All places of its fingerprints are equal, so they are settled without their windows; the first occurrence stays."""
    unit = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"{unit} " * 4), (2, f"x {unit} y"), (3, f"q {unit} " * 3), (4, f"{unit} " * 4)]
    from tests.llm.test_passages import plain

    want = plain(docs, 50)
    got = {r["doc_id"]: r for r in passages.cut(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {d: r["n_passage_words"] for d, r in got.items() if r["n_passage_words"]} == {d: len(g) for d, g in want.items()}
    for d, text in docs:
        kept = [w for n, w in enumerate(text.split()) if n not in want.get(d, set())]
        assert got[d]["cut_text"].split() == kept


def test_the_query_reads_the_texts_twice_for_both_kinds(spark, tmp_path, monkeypatch):
    """Lines and words are found in the same readings of the texts, one to count and one to hand on places."""
    from parcelwise.llm.queries import op10_linededup

    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    readings = []
    for name in ("marks", "places"):
        old = getattr(winnow, name)
        monkeypatch.setattr(winnow, name, lambda *a, _old=old, _name=name: readings.append(_name) or _old(*a))
    assert op10_linededup(spark, str(tmp_path)).count() == 2
    assert readings == ["marks", "places"]
