"""Lattice sums against all segmentations written out; counts and base scores against plain Python."""

import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from parcelwise.llm import lattice


def all_segmentations(text):
    for n in range(len(text)):
        for cuts in combinations(range(1, len(text)), n):
            edges = [0, *cuts, len(text)]
            yield [text[a:b] for a, b in zip(edges, edges[1:])]


def spelled(logs, piece):
    return sum(logs[chr(0xE000 + b)] for b in piece.encode())


@pytest.fixture(scope="module")
def logs():
    pieces = [lattice.MARK, lattice.MARK + "t", "t", "h", "e", "th", "he", "the", lattice.MARK + "the", "r", "er"]
    weights = {p: 1.0 + i for i, p in enumerate(pieces)} | {chr(0xE000 + b): 0.01 for b in range(256)} | {lattice.END: 2.0}
    total = sum(weights.values())
    return {p: math.log(w / total) for p, w in weights.items()}


def value(logs, pieces):
    """Log probability of a segmentation; None where a longer run has no piece."""
    out = 0.0
    for p in pieces:
        if p in logs:
            out += logs[p]
        elif len(p) == 1:
            out += spelled(logs, p)
        else:
            return None
    return out


@pytest.mark.parametrize("word", ["the", "there", "thé", "x", "etherthe", "hhhh"])
def test_marginal_and_expected_uses(logs, word):
    model = lattice.Lattice(logs)
    found = [(s, value(logs, s)) for s in all_segmentations(lattice.MARK + word)]
    known = [(s, v) for s, v in found if v is not None]
    total = sum(math.exp(v) for _, v in known)
    assert model.log_probability(word) == pytest.approx(math.log(total), rel=1e-12)
    uses = Counter()
    for pieces, v in known:
        for p in pieces:
            for key in [p] if p in logs else [chr(0xE000 + b) for b in p.encode()]:
                uses[key] += 3 * math.exp(v) / total
    got = {}
    model.expected(word, 3, got)
    assert got == pytest.approx(dict(uses))


def test_very_long_words_do_not_underflow(logs):
    model = lattice.Lattice(logs)
    assert math.isfinite(model.log_probability("the" * 20_000))


# Pieces within pieces, no piece at all, no UTF-8, the mark inside a word, long ones, and less probable than a double can hold.
WORDS = [
    b"the", b"there", "thé".encode(), b"x", b"etherthe", b"hhhh", b"the\xff\xe2", "\u2581the\u2581".encode(), "\ue041\U0001f600the".encode(),
    b"the" * 40, b"the" * 50, b"h" * lattice.LONG, b"h" * (lattice.LONG + 1), "漢字".encode() * 21, "漢字\U0010ffff".encode() * 12, b"t",
]


def check_many(logs, words):
    one, many = lattice.Lattice(logs), lattice.Lattices(logs)
    want = [one.log_probability(w.decode(errors="replace")) for w in words]
    assert many.log_probabilities(words) == pytest.approx(want, rel=1e-12)
    uses, got = {}, np.zeros(len(logs))
    for n, w in enumerate(words, 1):
        one.expected(w.decode(errors="replace"), n, uses)
    many.all_expected(words, np.arange(1, len(words) + 1), got)
    assert dict(zip(logs, got.tolist())) == pytest.approx({p: uses.get(p, 0.0) for p in logs}, rel=1e-9, abs=1e-60)
    return want


@pytest.mark.parametrize("at_once", [1, 40, lattice.AT_ONCE])
def test_many_words_at_once_get_the_sums_of_each(logs, monkeypatch, at_once):
    monkeypatch.setattr(lattice, "AT_ONCE", at_once)
    assert min(check_many(logs, WORDS * 3)) < math.log(lattice.LEAST)


def test_many_words_at_once_with_the_installed_vocabulary():
    check_many(lattice.start_weights(), WORDS + [b"delivery", b"tokenizer's", "façade".encode(), b"42"])


def test_many_words_at_once_without_words_or_pieces(logs):
    many = lattice.Lattices(logs)
    assert len(many.log_probabilities([])) == 0
    many.all_expected([], np.zeros(0), np.zeros(len(logs)))
    check_many({p: x for p, x in logs.items() if not p or p >= "\ue000"}, WORDS)
    check_many({p: x for p, x in logs.items() if not p or p >= "\ue000" or p == "the"}, WORDS)


def test_only_long_and_improbable_words_go_one_by_one(logs, monkeypatch):
    many, alone = lattice.Lattices(logs), []
    forward = lattice.Lattice.forward
    monkeypatch.setattr(lattice.Lattice, "forward", lambda self, text: alone.append(text) or forward(self, text))
    ordinary = [w for w in WORDS if len(w) <= 60]
    many.log_probabilities(ordinary)
    many.all_expected(ordinary, np.ones(len(ordinary)), np.zeros(len(logs)))
    assert not alone
    many.log_probabilities([*ordinary, b"h" * (lattice.LONG + 1)])
    assert alone == [lattice.MARK + "h" * (lattice.LONG + 1)]


def test_fitted_weights_are_those_of_the_words_one_by_one(spark):
    df = spark.createDataFrame([(" ".join(w.decode(errors="replace") for w in WORDS), False), ("the zebra", True)], "text string, held_out boolean")
    words = lattice.word_counts(df)
    start = lattice.start_weights()
    one, uses = lattice.Lattice(start), {lattice.END: 1.0}
    for r in words.where("c > 0 AND octet_length(word) > 0").collect():
        one.expected(bytes(r["word"]).decode(errors="replace"), r["c"], uses)
    total = sum(uses.values()) + len(start)
    want = {p: math.log((uses.get(p, 0.0) + len(start) * math.exp(x)) / total) for p, x in start.items()}
    assert lattice.fitted(words, start) == pytest.approx(want, rel=1e-9)


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", text), ""]


def plain(rows):
    """Per row the counts and the base score."""
    counts = Counter(t for _, text, held in rows if not held for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for _, text, _ in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        out.append((len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


ROWS = [
    (1, "The cat THE cat sat", False), (1, "The cat THE cat sat", False), (2, None, False), (3, "", True), (4, "cat zebra", True),
    (None, "the\x0bend  漢字 É é", False), (5, "the " * 3000 + "rare1 rare2 rare2", False), (6, "y" * 30_000, True),
]


@pytest.mark.parametrize("most", [0, 2, lattice.FREQUENT])
def test_scores_whatever_number_of_words_is_sent(spark, most):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, held_out boolean")
    got = lattice.scored(df, most=most).collect()
    key = lambda r: tuple(str(x) for x in r[:1]) + (round(r[-1], 6),)
    want = sorted(((i, h, *p) for (i, _, h), p in zip(ROWS, plain(ROWS))), key=key)
    found = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    assert [x[:-1] for x in found] == [x[:-1] for x in want]
    assert [x[-1] for x in found] == pytest.approx([x[-1] for x in want])
    assert all(r["score"] < 0 for r in got)


def test_the_score_is_the_sum_over_words(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, held_out boolean")
    words = lattice.word_counts(df)
    logs = lattice.fitted(words, lattice.start_weights())
    assert sum(math.exp(x) for x in logs.values()) == pytest.approx(1)
    model = lattice.Lattice(logs)
    want = {}
    for i, text, _ in ROWS:
        want.setdefault(i, set()).add(round((sum(model.log_probability(w) for w in tokens(text)[:-1]) + logs[lattice.END]) / math.log(10), 5))
    for r in lattice.scored(df).collect():
        assert round(r["score"], 5) in want[r["doc_id"]]


def test_no_documents_and_no_training_documents(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, held_out boolean")
    assert lattice.scored(df.limit(0)).count() == 0
    held = lattice.scored(df.where("held_out")).collect()
    assert len(held) == 3 and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in held)


def test_whole_table(spark, small):
    from parcelwise.llm.queries import op5_lattice

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in docs]
    want = {i: p for (i, _, _), p in zip(rows, plain(rows))}
    for r in op5_lattice(spark, small).collect():
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][3])
