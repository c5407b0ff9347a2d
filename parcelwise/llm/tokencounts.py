"""Token counts by a two-tier lookup of pre-tokens, inside the tasks that read the texts.

A text is cut into pre-tokens, and its count is the sum of their lengths in tokens. The first tier is a table of the
lengths of frequent pre-tokens, at most ``FREQUENT`` of them, that is sent to all tasks. It comes from mergeable sketches of
frequent items over all texts: a sketch of bounded size per task crosses the network, never a pre-token of a text. What the first
tier misses is looked up in a cache of the worker; what that misses too is encoded, once per block and distinct pre-token.
The table decides what is encoded anew and never what is counted, so results do not depend on it.

Pre-tokens are cut here where all characters lie below U+0250 (but for U+0130, which lower-casing takes apart): there the
vocabulary's pattern holds in every version of Unicode, and neither composition nor lower-casing reaches over a cut. A run between
blanks with any other character is one entry as a whole, which the library normalises and cuts.

Defined cases: a null text is an empty one and has no tokens; a special token's string in a text is one token, as the
library has it; equal rows get equal counts; an empty table gives an empty one; other columns pass through, but one
named like the result is replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import compress, repeat
from operator import not_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelwise.llm.common import pieces, share, shared, texts, with_fields, without

# Fixed value: how this family of vocabularies cuts normalised texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Entries of the table sent to all tasks, and what a sketch keeps track of; longer pre-tokens stay out of both.
FREQUENT = 1 << 15
TRACKED = 1 << 16
FREQUENT_CHARS = 32
# Sketches merged at once on the way to the last one.
MERGED = 64
# Entries of a worker's cache, and the longest one it keeps.
KNOWN = 400_000
KEPT = 64

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_BLANK = " \t\n\x0b\x0c\r\x85\xa0"
# The pattern for characters below U+0250, in either case.
_CUT = re.compile(
    f"'[sStTmMdD]|'[rR][eE]|'[vV][eE]|'[lL][lL]|[{_LETTER}]+|[{_DIGIT}]|[^{_BLANK}{_LETTER}{_DIGIT}]+"
).findall
_OTHER = re.compile("[İɐ-\U0010ffff]").search
_RUNS = re.compile("[^ \t\n\x0b\x0c\r]+").findall


def default_path() -> str:
    """Where the lower-case vocabulary with word ends is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def source_of(path: str) -> str:
    """The text of a vocabulary file; one with other normalisers or another pattern is an error."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    data = json.loads(source)
    steps = [s["type"] for s in (data["normalizer"] or {}).get("normalizers", [])]
    cuts = [c.get("pattern") for c in (data["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if steps != ["NFC", "Replace", "Lowercase"] or cuts[:1] != [{"Regex": PATTERN}]:
        raise ValueError(f"{path} cuts texts in a way this operator does not know")
    return source


class Lengths:
    """Lengths in tokens of pre-tokens: a table given, a cache, and the library for the rest."""

    def __init__(self, source: str, frequent: dict[str, int]):
        # One task has one core; the library's own threads would take those of its neighbours.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t["content"] for t in json.loads(source)["added_tokens"]]
        self.special = special
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")").split
        self.frequent = frequent
        self.known: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        """The entries of a text, whose lengths add up to its length."""
        if any(s in text for s in self.special):
            parts = self.split(text)
            return [e for i, part in enumerate(parts) for e in ([part] if i % 2 else self.cut_plain(part))]
        return self.cut_plain(text)

    def cut_plain(self, text: str) -> list[str]:
        if _OTHER(text) is None:
            return _CUT(text)
        return [e for run in _RUNS(text) for e in ([run] if _OTHER(run) else _CUT(run))]

    def encoded(self, entries: Sequence[str]) -> Iterator[int]:
        for found in self.library.encode_batch(list(entries), add_special_tokens=False):
            yield len(found.ids)

    def count(self, block: Sequence[str]) -> list[int]:
        """The number of tokens of every text of a block."""
        lookup, sums, missed = self.frequent.get, [], []
        for text in block:
            own = self.cut(text)
            lengths = list(map(lookup, own, repeat(0)))
            sums.append(sum(lengths))
            missed.append(list(compress(own, map(not_, lengths))))
        new = set().union(*missed)
        if len(self.known) + len(new) > KNOWN:
            self.known = {}
        fresh = list(new.difference(self.known))
        now = self.known
        now.update(zip(fresh, self.encoded(fresh)))
        out = [total + sum(map(now.__getitem__, own)) for total, own in zip(sums, missed)]
        for entry in fresh:
            if len(entry) > KEPT:
                del now[entry]
        return out


def frequent(df: DataFrame, column: str, most: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts, by sketches that meet ``MERGED`` at a time."""
    found = F.regexp_extract_all(F.col(f"`{column}`"), F.lit(PATTERN), F.lit(0))
    words = df.select(F.explode(found).alias("word")).where(f"length(word) <= {FREQUENT_CHARS}")
    part = F.floor(F.spark_partition_id() / MERGED).alias("part")
    sketches = words.groupBy(part).agg(F.expr(f"approx_top_k_accumulate(word, {TRACKED})").alias("sketch"))
    # Grouped, so that no text gives no sketch instead of an empty one.
    merged = sketches.groupBy(F.col("part") >= 0).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    top = merged.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top")).first()
    return [] if top is None else [r["item"] for r in top["top"] if r["item"] is not None]


def counted(
    df: DataFrame, column: str = "text", path: str | None = None, most: int = FREQUENT, keep_text: bool = True
) -> DataFrame:
    """The table with ``n_tokens``; without its text column if ``keep_text`` is false.

    ``path``: the vocabulary file, which the driver reads and sends. ``most``: entries of the first tier (0: none).
    """
    source = source_of(path or default_path())
    words = frequent(df, column, most) if most else []
    table = dict(zip(words, Lengths(source, {}).encoded(words))) if words else {}
    sent = share(df, (source, table))
    rows = without(df, ["n_tokens"])
    names = [c for c in rows.columns if keep_text or c != column]
    schema = with_fields(rows.select(*[F.col(f"`{c}`") for c in names]), "n_tokens LONG")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(*shared(sent))
        for batch in batches:
            for start, stop in pieces(batch, column):
                found = lengths.count([t.decode(errors="replace") for t in texts(batch, column, start, stop)])
                part = batch.slice(start, stop - start).select(names)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.int64())], names=[*names, "n_tokens"])

    return rows.mapInArrow(work, schema)
