"""Byte-level BPE against the tokenizers library, and exact round trips."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from parcelwise.llm import bpe

ODD = list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　​﻿ab'sStTréÉñ漢字😀👍🏽́٠²½Ⅷ_-!'re") + ["<|endoftext|>", "'ll", "  "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(bpe.default_path(), encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def texts():
    draw = random.Random(7)
    odd = ["".join(draw.choices(ODD, k=draw.randrange(50))) for _ in range(3000)]
    return [*odd, "", " ", "a" * 3000, "ab" * 2000, "<|endoftext|>", " x<|endoftext|><|endoftext|> y ", "the quick  brown\n\nfox "]


def test_ids_and_decoded_texts_equal_the_library(library, vocabulary):
    block = texts()
    encoder = bpe.Encoder(vocabulary)
    for _ in range(2):  # the second time all pieces are known
        for text, own, want in zip(block, encoder.encode(block), library.encode_batch(block, add_special_tokens=False)):
            assert ",".join(e[0] for e in own) == ",".join(map(str, want.ids))
            assert b"".join(e[2] for e in own).decode(errors="replace") == library.decode(want.ids, skip_special_tokens=False)


def test_a_small_memory_changes_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 5)
    monkeypatch.setattr(bpe, "KEPT", 2)
    encoder = bpe.Encoder(vocabulary)
    for text in texts()[:200]:
        (own,) = encoder.encode([text])
        assert [int(i) for e in own for i in e[0].split(",")] == library.encode(text, add_special_tokens=False).ids


def test_overlapping_pairs_merge_from_the_left(vocabulary, library):
    for size in range(1, 40):
        for letter in "a- ":
            ids, starts = bpe.merge_block([letter.encode() * size, b"x", letter.encode() * size], vocabulary)
            assert starts[-1] == len(ids) and ids[: starts[1]] == ids[starts[2] :]
            pieces = bpe.Encoder(vocabulary).split(letter * size)
            if len(pieces) == 1:
                assert ids[: starts[1]] == library.encode(letter * size, add_special_tokens=False).ids


def test_columns_nulls_and_repeats(spark, library):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (3, "Über <|endoftext|> 漢", "b"), (None, "x" * 200_000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encoded(df, "text", ("n_tokens", "ids", "decoded", "ids_sha256"))
    assert got.columns == ["doc_id", "text", "n_tokens", "ids", "decoded", "ids_sha256"]
    found = got.collect()
    assert len(found) == 5
    for r in found:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == (r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encoded(df.limit(0)).count() == 0
