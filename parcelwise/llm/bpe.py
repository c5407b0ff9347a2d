"""Byte-level BPE: a pair occurrence index over the distinct pieces of a block of texts.

A task takes its texts in blocks. The distinct pieces (what the vocabulary's pattern splits texts into) of a
block that are not yet known are laid out in one symbol array. An index holds, for every pair of
neighbours that the vocabulary can merge, all its positions. The pairs present are worked off in ascending
rank; a merge updates the lists of the pairs to its left and right. So one look at a pair merges it in all
pieces at once, and work is done once per distinct piece, not per token.

Ids and decoded texts equal those of the tokenizers library with special tokens recognised in the text.

Defined cases: a null text is an empty one, with no ids; a text that holds the string of a special token gets
its id there; extra columns pass through, except that the results replace columns of their names.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from parcelwise.llm.common import pieces, texts, with_fields, without

# The pattern that splits a text into pieces for this family of vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

# Text looked through at once, runs of text without a blank whose ids a task keeps, and the longest one
# kept: they bound the memory of a task.
STEP = 8 << 20
KNOWN = 400_000
KEPT = 64
# A private-use character; texts that hold it are cut by the pattern instead.
MARK = "\ue000"

FIELDS = {
    "n_tokens": "n_tokens LONG",
    "ids": "ids ARRAY<INT>",
    "decoded": "decoded STRING",
    "ids_sha256": "ids_sha256 STRING",
    "decoded_sha256": "decoded_sha256 STRING",
}


def default_path() -> str:
    """Where the byte-level vocabulary of 50,257 entries is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte: itself where printable, else the next free code from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE vocabulary file (the tokenizers library's JSON)."""

    def __init__(self, source: str):
        data = json.loads(source)
        ids = data["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.byte_ids = np.array([ids[letters[b]] for b in range(256)], dtype=np.int32)
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in ids.items()}
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in data["model"]["merges"]]
        self.left, self.right, self.merged = (np.array(x, dtype=np.int32) for x in zip(*merges))
        pairs = pair_of(self.left, self.right)
        self.order = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.order]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
        self.bytes_of.update({i: s.encode() for s, i in self.special.items()})

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair of symbols; -1 where the vocabulary does not merge it."""
        wanted = pair_of(left, right)
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.order[at], -1)


def pair_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for a pair of symbols; ends and merged-away places are negative and match no entry."""
    return (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)


END, GONE = -1, -2


class Occurrences:
    """For every rank that can be applied, the positions of its pair, and the ranks not yet worked off."""

    def __init__(self) -> None:
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []

    def add(self, ranks: np.ndarray, places: np.ndarray) -> None:
        known = ranks >= 0
        ranks, places = ranks[known], places[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, start, stop in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.active, rank)
            self.places[rank].append(places[start:stop])

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest active rank with all its positions."""
        rank = heapq.heappop(self.active)
        lists = self.places.pop(rank)
        return rank, lists[0] if len(lists) == 1 else np.concatenate(lists)


def every_second(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of sorted positions of a pair of two equal symbols, those a merge from the left takes."""
    chained = np.zeros(len(places), dtype=bool)
    chained[1:] = after[places[:-1]] == places[1:]
    index = np.arange(len(places))
    start = np.maximum.accumulate(np.where(chained, 0, index))
    return places[(index - start) % 2 == 0]


def merge_block(words: Sequence[bytes], vocabulary: Vocabulary) -> tuple[list[int], list[int]]:
    """The ids of all words in a row, and where each word's ids start (with the end of the last one).

    All pairs of the block stand in an occurrence index and are merged by ascending rank.
    """
    if not words:
        return [], [0]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    raw = np.frombuffer(b"\0".join([*words, b""]), dtype=np.uint8)
    symbols = vocabulary.byte_ids[raw]
    symbols[ends] = END
    size = len(symbols)
    after = np.arange(1, size + 1, dtype=np.int32)
    before = np.arange(-1, size - 1, dtype=np.int32)
    found = Occurrences()
    found.add(vocabulary.ranks(symbols[:-1], symbols[1:]), np.arange(size - 1, dtype=np.int32))
    while found.active:
        rank, at = found.pop()
        left, right = vocabulary.left[rank], vocabulary.right[rank]
        at = at[symbols[at] == left]
        at = at[symbols[after[at]] == right]
        if left == right and len(at) > 1:
            at = every_second(np.unique(at), after)
        if not len(at):
            continue
        second = after[at]
        third = after[second]
        symbols[at], symbols[second] = vocabulary.merged[rank], GONE
        after[at] = third
        before[third] = at
        first = before[at]
        # The first word has nothing before it; -1 then looks at the last end, which matches no pair.
        new = np.concatenate([vocabulary.ranks(symbols[at], symbols[third]), vocabulary.ranks(symbols[first], symbols[at])])
        found.add(new, np.concatenate([at, first]))
    ids = symbols[symbols != GONE]
    stops = np.flatnonzero(ids == END)
    starts = np.concatenate([[0], stops - np.arange(len(stops))])
    return ids[ids != END].tolist(), starts.tolist()


# What one run of text turns into: its ids as text, their number, the bytes they stand for.
Entry = tuple[str, int, bytes]


class Encoder:
    """Encodes and decodes the texts of one task.

    A blank between two characters that are not white space always begins a piece, so texts are cut there
    and each distinct run is split and merged once. Texts with longer white space around a blank, and the
    strings of special tokens, are cut with the pattern as a whole.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.wide = re.compile(r"\s[\s]").search
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.numeral = {i: str(i) for i in vocabulary.bytes_of}
        self.known: dict[str, Entry] = {}

    def runs(self, text: str) -> list[str]:
        """The text cut into runs that can be encoded on their own; those after the first keep their blank."""
        if self.special is not None and any(s in text for s in self.vocabulary.special):
            parts = self.special.split(text)
            return [r for i, part in enumerate(parts) for r in ([part] if i % 2 else self.runs_plain(part))]
        return self.runs_plain(text)

    def runs_plain(self, text: str) -> list[str]:
        # A mark that is put before every blank makes the cut keep the blank.
        if self.wide(text) or MARK in text:
            return self.split(text)
        return text.replace(" ", MARK + " ").split(MARK)

    def learn(self, new: Sequence[str]) -> dict[str, Entry]:
        """Entries of runs not known yet; every distinct piece among them is merged once."""
        special, bytes_of, numeral, split = self.vocabulary.special, self.vocabulary.bytes_of, self.numeral, self.split
        out = {r: (str(special[r]), 1, bytes_of[special[r]]) for r in new if r in special}
        # A blank and letters are one piece; whatever else goes through the pattern.
        mixed = {r: split(r) for r in new if not r[1:].isalpha() and r not in special or r[:1] != " "}
        words = list(set().union(*mixed.values(), [r for r in new if r not in mixed and r not in special]))
        ids, starts = merge_block([w.encode() for w in words], self.vocabulary)
        numerals, decoded = [numeral[i] for i in ids], [bytes_of[i] for i in ids]
        entries = {
            w: (",".join(numerals[a:b]), b - a, b"".join(decoded[a:b])) for w, a, b in zip(words, starts, starts[1:])
        }
        for run, own in mixed.items():
            if run not in out:
                got = [entries[w] for w in own]
                out[run] = (",".join([e[0] for e in got]), sum([e[1] for e in got]), b"".join([e[2] for e in got]))
        for run in new:
            if run not in out:
                out[run] = entries[run]
        return out

    def encode(self, block: Sequence[str]) -> Iterator[list[Entry]]:
        """For every text the entries of its runs in order."""
        split = [self.runs(text) for text in block]
        new: set[str] = set().union(*split)
        if len(self.known) + len(new) > KNOWN:
            self.known = {}
        new.difference_update(self.known)
        new.discard("")
        fresh = self.learn(list(new))
        now = self.known
        now.update(fresh)
        for own in split:
            yield [now[r] for r in own if r]
        for run in [r for r in fresh if len(r) > KEPT]:
            del now[run]


def encoded(df: DataFrame, column: str = "text", results: Sequence[str] = ("n_tokens", "ids", "decoded"), path: str | None = None) -> DataFrame:
    """The table with the named results of encoding and decoding a text column.

    ``results``: of ``n_tokens``, ``ids``, ``decoded`` and the digests ``ids_sha256`` (of the decimal ids
    joined by commas) and ``decoded_sha256``. ``path``: the vocabulary file; the driver reads it
    and sends its few megabytes to the executors.
    """
    with open(path or default_path(), encoding="utf-8") as file:
        source = df.sparkSession.sparkContext.broadcast(file.read())
    rows = without(df, list(results))
    schema = with_fields(rows, ", ".join(FIELDS[r] for r in results))
    make: dict[str, Callable] = {
        "n_tokens": lambda own: sum([e[1] for e in own]),
        "ids": lambda own: [int(i) for e in own for i in e[0].split(",")],
        "decoded": lambda own: b"".join([e[2] for e in own]).decode(errors="replace"),
        "ids_sha256": lambda own: hashlib.sha256(",".join([e[0] for e in own]).encode()).hexdigest(),
        "decoded_sha256": lambda own: hashlib.sha256(
            b"".join([e[2] for e in own]).decode(errors="replace").encode()
        ).hexdigest(),
    }
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Many small lists and no cycles: the collector would only walk them again and again.
        gc.disable()
        encoder = Encoder(Vocabulary(source.value))
        for batch in batches:
            for start, stop in pieces(batch, column, STEP):
                block = [t.decode(errors="replace") for t in texts(batch, column, start, stop)]
                values: list[list] = [[] for _ in results]
                for own in encoder.encode(block):
                    for place, name in zip(values, results):
                        place.append(make[name](own))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(v, kinds.get(r, pa.string())) for v, r in zip(values, results)]],
                    names=[*part.schema.names, *results],
                )

    return rows.mapInArrow(work, schema)
