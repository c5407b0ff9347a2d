"""Token counts against the tokenizers library over whole texts."""

import random

import pytest
from tokenizers import Tokenizer

from parcelwise.llm import tokencounts

ODD = [
    *" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　​﻿", *"ab'sStTréÉñİıſŉǅ×÷ªµ漢字😀👍🏽́̇٠²½Ⅷ_-!'reΣσ",
    "<|endoftext|>", "<|startoftext|>", "<|endof", "'ll", "'VE", "é", "≠", "  ", "don't", "the ", "K",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokencounts.default_path())


def odd_texts():
    draw = random.Random(3)
    some = ["".join(draw.choices(ODD, k=draw.randrange(40))) for _ in range(4000)]
    return [*some, "", " ", "a" * 3000, "ab" * 2000, "!" * 500, "1" * 300, "é" * 400, "漢" * 200, "x<|endoftext|><|endoftext|>y"]


@pytest.mark.parametrize("frequent", [[], ["the", "'", "s", "!", "e"]])
def test_counts_equal_the_library(library, frequent, monkeypatch):
    monkeypatch.setattr(tokencounts, "KNOWN", 3000)
    monkeypatch.setattr(tokencounts, "KEPT", 8)
    source = tokencounts.source_of(tokencounts.default_path())
    lengths = tokencounts.Lengths(source, {})
    lengths.frequent = dict(zip(frequent, lengths.encoded(frequent)))
    block = odd_texts()
    want = [len(e.ids) for e in library.encode_batch(block, add_special_tokens=False)]
    for _ in range(2):  # the second time the cache holds something
        got = [n for i in range(0, len(block), 100) for n in lengths.count(block[i : i + 100])]
        assert [(t, a, b) for t, a, b in zip(block, got, want) if a != b] == []


def test_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (3, "Über <|endoftext|> 漢", "b"), (None, "x" * 200_000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string")
    for keep in (True, False):
        got = tokencounts.counted(df, keep_text=keep)
        assert got.columns == ["doc_id", *["text"] * keep, "n_tokens"]
        want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows)
        assert sorted(r["n_tokens"] for r in got.collect()) == want
    assert tokencounts.counted(df.limit(0)).count() == 0


def test_the_first_tier_holds_the_frequent_ones_of_all_texts(spark):
    texts = [(f"the the, w{i} it's " + "z" * 50,) for i in range(300)]
    found = tokencounts.frequent(spark.createDataFrame(texts, "body string").repartition(7), "body", 5)
    assert {"the", "'s"} <= set(found) and len(found) == 5 and not any(len(w) > 32 for w in found)
    with pytest.raises(ValueError):
        import public_tokenizers

        tokencounts.source_of(public_tokenizers.path("byte_bpe_50k.json"))


def test_no_exchange_carries_texts(spark, small, library):
    df = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = tokencounts.counted(df, keep_text=False)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = {r["doc_id"]: len(e.ids) for r, e in zip(df.collect(), library.encode_batch([r["text"] for r in df.collect()], add_special_tokens=False))}
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == want
