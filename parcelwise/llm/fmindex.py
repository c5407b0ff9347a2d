"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a few megabytes of consecutive texts of a task. Its words become numbers: those of the benchmark's
vocabulary, and zero for all others. A phrase holds no zero, so only stretches without one that are as long as the
shortest phrase are indexed; what is left out cannot hold a phrase. The index is the
Burrows-Wheeler transform of the stretches, a wavelet matrix for ranks, the counts of smaller symbols
and every eighth position of the suffix array. All phrases of a length are searched backwards at once, and
their rows are walked to sampled positions. The words found merge into removal spans per text.

The benchmark goes to the executors in blocks of at most ``BLOCK_BYTES`` of text, one pass over the documents each;
its digests and lists never stand in the driver as a whole. One block is the usual case.

Defined cases: a null or wordless text has no words and no hit; a null or wordless item has no phrase; a null
item_id is named ``null``; equal rows get equal results; columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import LOWER, TO_LOWER, pieces, share, shared, texts, with_fields, without

WINDOW = 13
# A text is contaminated when at least one word in so many is hit.
ONE_IN = 20
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
SAMPLED = 8

# Bytes that make up words after lower-casing: digits, a to z, and everything beyond ASCII.
_WORD = bytes(range(48, 58)) + LOWER + bytes(range(128, 256))
_TO_WORDS = bytes(TO_LOWER[b] if TO_LOWER[b] in _WORD else 32 for b in range(256))
_WORD_IN_TEXT = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")

RESULT = "n_words LONG, n_hit LONG, items ARRAY<STRING>, spans ARRAY<STRUCT<start: INT, end: INT>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(text: bytes) -> list[bytes]:
    """The lower-cased words of a text."""
    return text.translate(_TO_WORDS).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that start there, by prefix doubling."""
    size = len(symbols)
    rank = symbols.astype(np.int64)
    step = 1
    while True:
        follow = np.zeros(size, dtype=np.int64)
        follow[: max(0, size - step)] = rank[step:] + 1
        key = rank * (int(follow.max(initial=0)) + 1) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(size, dtype=np.int64)
        new[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        rank = np.empty(size, dtype=np.int64)
        rank[order] = new
        if size < 2 or new[-1] == size - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks in a sequence of numbers: how often one occurs before a place, bit by bit from the top."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.zeros: list[np.ndarray] = []
        for bit in self.bits:
            one = (symbols >> bit) & 1 == 1
            count = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(~one, out=count[1:])
            self.zeros.append(count)
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, zeros in zip(self.bits, self.zeros):
            before = zeros[place]
            place = np.where(symbol >> bit & 1 == 1, zeros[-1] + place - before, before)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._down(symbol, place) - self._down(symbol, np.zeros_like(place))


class FmIndex:
    """Backward search over a sequence of numbers, with positions from a sampled suffix array."""

    def __init__(self, symbols: np.ndarray, largest: int, sampled: int = SAMPLED):
        # Every symbol one higher, and an end of its own below all others.
        symbols = np.concatenate([symbols + 1, [0]])
        order = suffix_array(symbols)
        self.last = symbols[order - 1]  # the transform; the end precedes position 0
        self.ranks = WaveletMatrix(self.last, largest + 1)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 2))])
        self.sampled = order % sampled == 0
        self.samples = order[self.sampled]
        self.sample_of = np.cumsum(self.sampled) - 1

    def _step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.ranks.rank(symbol, row)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of phrases of equal length (one a row): which occur, and their ranges of rows."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), len(self.last), dtype=np.int64)
        for column in phrases.T[::-1]:
            symbol = column[which] + 1
            low, high = self._step(symbol, low), self._step(symbol, high)
            some = low < high
            which, low, high = which[some], low[some], high[some]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of rows: back through the text until a sampled one."""
        out = np.zeros(len(rows), dtype=np.int64)
        waiting, walked = np.arange(len(rows)), 0
        while len(waiting):
            here = self.sampled[rows]
            out[waiting[here]] = self.samples[self.sample_of[rows[here]]] + walked
            waiting, rows = waiting[~here], rows[~here]
            rows = self._step(self.last[rows], rows)
            walked += 1
        return out


class Phrases:
    """The windows of a block of benchmark items as rows of word numbers, by length, with the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            if ids:
                length = min(window, len(ids))
                for at in range(len(ids) - length + 1):
                    found.setdefault(tuple(ids[at : at + length]), set()).add(name)
        self.names = sorted({n for names in found.values() for n in names})
        place = {n: i for i, n in enumerate(self.names)}
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for length in sorted({len(w) for w in found}):
            own = [w for w in found if len(w) == length]
            self.by_length[length] = (np.array(own, dtype=np.int64), [sorted(place[n] for n in found[w]) for w in own])


def stretches(ids: np.ndarray, least: int) -> np.ndarray:
    """Indexes of the runs without a zero that are long enough, each followed by the index of the zero after it."""
    inside = np.concatenate([[False], ids > 0, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = change[::2], change[1::2]
    long = stops - starts >= least
    starts, sizes = starts[long], (stops - starts)[long] + 1
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(first, sizes) + np.repeat(starts, sizes)


def search_shard(block: list[bytes], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """For the texts of a shard: where each starts among the shard's words, which words are hit, the items found."""
    get = phrases.number.get
    ids: list[int] = []
    starts = []
    for text in block:
        starts.append(len(ids))
        ids.extend(map(get, words_of(text), repeat(0)))
        ids.append(0)  # no phrase runs from one text into the next
    starts.append(len(ids))
    symbols, edges = np.array(ids, dtype=np.int64), np.array(starts)
    cover = np.zeros(len(symbols) + 1, dtype=np.int64)
    pairs: list[np.ndarray] = []
    kept = stretches(symbols, min(phrases.by_length, default=1)) if phrases.by_length else symbols[:0]
    if len(kept):
        index = FmIndex(symbols[kept], len(phrases.number))
        for length, (rows, items) in phrases.by_length.items():
            which, low, high = index.search(rows)
            if not len(which):
                continue
            count = high - low
            base = np.cumsum(count) - count
            row = np.arange(count.sum()) - np.repeat(base, count) + np.repeat(low, count)
            at = kept[index.locate(row)]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + length, -1)
            doc = np.searchsorted(edges, at, side="right") - 1
            # One row per text and phrase, then the items of the phrase.
            once = np.unique(doc * len(rows) + np.repeat(which, count))
            doc, phrase = once // len(rows), once % len(rows)
            sizes = np.array([len(items[p]) for p in phrase])
            named = np.array([i for p in phrase for i in items[p]], dtype=np.int64)
            pairs.append(np.unique(np.repeat(doc, sizes) * len(phrases.names) + named))
    found: list[list[str]] = [[] for _ in block]
    for pair in np.unique(np.concatenate(pairs)).tolist() if pairs else []:
        found[pair // len(phrases.names)].append(phrases.names[pair % len(phrases.names)])
    return edges, np.cumsum(cover[:-1]) > 0, found


def removal_spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Neighbouring hit words merged into spans of code points, end exclusive."""
    out: list[dict[str, int]] = []
    last = False
    for word, here in zip(_WORD_IN_TEXT.finditer(text.decode(errors="replace")), hit.tolist()):
        if here and last:
            out[-1]["end"] = word.end()
        elif here:
            out.append({"start": word.start(), "end": word.end()})
        last = here
    return out


def _one_pass(rows: DataFrame, text: str, phrases, spans: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared(phrases)
        for batch in batches:
            for start, stop in pieces(batch, text, SHARD_BYTES):
                block = texts(batch, text, start, stop)
                edges, hit, found = search_shard(block, wanted)
                total = np.concatenate([[0], np.cumsum(hit)])
                n_words, n_hit = np.diff(edges) - 1, total[edges[1:]] - total[edges[:-1]]
                cut = [
                    removal_spans(t, hit[a : b - 1]) if spans and n else []
                    for t, n, a, b in zip(block, n_hit, edges[:-1], edges[1:])
                ]
                part = batch.slice(start, stop - start)
                new = [pa.array(n_words), pa.array(n_hit), pa.array(found, pa.list_(pa.string())), pa.array(cut, SPANS)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *new], names=[*part.schema.names, "n_words", "n_hit", "items", "spans"]
                )

    return rows.mapInArrow(work, with_fields(rows, RESULT))


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size, one at a time; an item's windows all lie in its block."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 64).alias("size")).first()["size"] or 0
    count = int(size // block_bytes) + 1
    for block in range(count):
        own = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield [(r["item_id"], r["text"].encode()) for r in own.collect()]


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, spans: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents with ``n_words``, ``n_hit``, ``items`` (ids found, sorted as strings) and ``spans`` to remove.

    ``spans=False`` leaves the spans empty. With more than one block of benchmark items the passes meet by document and
    their spans are merged.
    """
    rows = without(docs, ["n_words", "n_hit", "items", "spans"])
    blocks = [share(docs, Phrases(block, window)) for block in benchmark_blocks(benchmark, block_bytes)]
    passes = [_one_pass(rows, text, block, spans or len(blocks) > 1) for block in blocks]
    return passes[0] if len(passes) == 1 else _merged(rows, passes, text)


def _merged(rows: DataFrame, passes: list[DataFrame], text: str) -> DataFrame:
    """One result per document from several passes: items united, spans merged, hit words counted anew."""
    columns = [F.col(f"`{c}`") for c in rows.columns if c != text]
    together = None
    for number, one in enumerate(passes):
        one = one.withColumn("_first", F.lit(number == 0))
        together = one if together is None else together.unionAll(one)
    grouped = together.groupBy(*columns, F.col(f"`{text}`")).agg(
        F.first("n_words").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.sum(F.col("_first").cast("int")).alias("_copies"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = {n: batch.column(n) for n in batch.schema.names}
            cut, hits = [], []
            for body, parts in zip(texts(batch, text), data["spans"].to_pylist()):
                merged, n_hit = merge_spans(body, [(p["start"], p["end"]) for p in parts])
                cut.append(merged)
                hits.append(n_hit)
            data["spans"], data["n_hit"] = pa.array(cut, SPANS), pa.array(hits, pa.int64())
            yield pa.RecordBatch.from_arrays(list(data.values()), names=list(data))

    out = grouped.mapInArrow(work, grouped.schema)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))
    return out.withColumn("_copy", copies).select(*rows.columns, "n_words", "n_hit", "items", "spans")


def merge_spans(text: bytes, parts: list[tuple[int, int]]) -> tuple[list[dict[str, int]], int]:
    """Removal spans of several passes over a text as one list, and the number of words they hold."""
    if not parts:
        return [], 0
    words = [(m.start(), m.end()) for m in _WORD_IN_TEXT.finditer(text.decode(errors="replace"))]
    hit = np.zeros(len(words) + 1, dtype=np.int64)
    starts, ends = np.array([w[0] for w in words]), np.array([w[1] for w in words])
    for a, b in parts:
        hit[np.searchsorted(starts, a)] += 1
        hit[np.searchsorted(ends, b) + 1] -= 1
    cover = np.cumsum(hit[:-1]) > 0
    return removal_spans(text, cover), int(cover.sum())


def contaminated():
    """The verdict: any word hit, and at least one in ``ONE_IN``."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))


def without_spans(text, spans):
    """A text without its removal spans; both are columns."""
    keep = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda s, x: F.struct(
            F.concat(s["kept"], F.substring(text, s["at"] + 1, x["start"] - s["at"])).alias("kept"), x["end"].alias("at")
        ),
        lambda s: F.concat(s["kept"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])),
    )
    return F.when(F.size(spans) > 0, keep).otherwise(text)
