"""Winnowing over words and over lines: what both kinds of repeats share.

Many texts are handled at once: their bytes stand in one array, blanks between them, and words, lines, runs and least hashes are
found by numpy over all of them; what would reach across two texts is left out.

Windows of words hold ``n`` words; each chooses its least gram (the first of equals). Windows of lines start at every line with a
word and run over as few lines as hold ``n`` words; each chooses its least line (the last of equals). Equal windows choose the
same, so what is equal in two places has a fingerprint found twice. The texts are read twice: the first reading counts the
fingerprints, the second hands on the places whose fingerprints were found twice, without those that were found once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from parcelwise.llm.common import BLANKS, pieces, release, share, shared, text_key, texts
from parcelwise.session import new_path

# Bytes of texts handled at once: the arrays beside them take some twenty times that, and a worker keeps what it once took.
STEP_BYTES = 1 << 18
# Rows with lists handed on at once.
OUT_ROWS = 1 << 13
# Words up to this size are hashed by numpy, the others one by one.
SHORT = 32
# Three filters of 8 MB go to the tasks, however many fingerprints there are.
FILTER_BITS = 26
LINES, WORDS, MIXED = range(3)

_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS.encode())] = True
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_CACHED: dict[int, np.ndarray] = {}

CONTEXT = pa.list_(pa.struct([("hash", pa.int64()), ("line", pa.int32())]))
MARKS = "lines BOOLEAN, fingerprint LONG, whole LONG, n INT"
PLACES = (
    "lines BOOLEAN, whole LONG, start INT, size INT, windows ARRAY<LONG>, inside ARRAY<INT>, "
    "before ARRAY<STRUCT<hash: LONG, line: INT>>, after ARRAY<STRUCT<hash: LONG, line: INT>>"
)
KINDS = [
    pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), CONTEXT, CONTEXT,
]
NAMES = ["lines", "whole", "start", "size", "windows", "inside", "before", "after"]


class Words(NamedTuple):
    """The words of several texts, one after the other."""

    data: np.ndarray
    """The bytes of all texts, a line feed before each."""
    begin: np.ndarray
    """Where each text begins in ``data``."""
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    """The number of each text's first word, and the number of words."""
    text: np.ndarray
    """The text of each word."""


def words_of(bodies: list[bytes]) -> Words:
    data = np.frombuffer(b"\n".join([b"", *bodies, b"\n" * 8]), dtype=np.uint8)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    begin = np.cumsum(sizes + 1) - sizes
    blank = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    first = np.append(np.searchsorted(starts, begin), len(starts))
    return Words(data, begin, starts, ends, first, np.repeat(np.arange(len(bodies)), np.diff(first)))


def _mixed(out: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        out = (out ^ (out >> np.uint64(33))) * np.uint64(factor)
    return out ^ (out >> np.uint64(33))


def hashes_of(words: Words) -> np.ndarray:
    """A 64-bit hash of every word: eight bytes at a time, and of long words by the library."""
    data, starts, size = words.data, words.starts, words.ends - words.starts
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = _mixed((eight[starts] & _KEEP[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(_BASE))
    for done in range(8, SHORT, 8):
        more = np.flatnonzero((size > done) & (size <= SHORT))
        if len(more):
            part = eight[starts[more] + done] & _KEEP[np.minimum(size[more] - done, 8)]
            out[more] = _mixed(out[more] * np.uint64(_BASE) + part)
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = xxh3_64_intdigest(data[starts[i] : words.ends[i]])
    return out


def _powers(base: int, count: int) -> np.ndarray:
    """The first powers of a base; those for usual sizes are kept."""
    known = _CACHED.get(base)
    if known is None or len(known) < count:
        known = np.cumprod(np.append(np.uint64(1), np.full(max(count, STEP_BYTES // 2), base, dtype=np.uint64)), dtype=np.uint64)
        if count <= STEP_BYTES:
            _CACHED[base] = known
    return known[:count]


_BACK = pow(_BASE, -1, 1 << 64)


def sums(hashes: np.ndarray) -> np.ndarray:
    """What :func:`runs_hash` and :func:`rolling` take differences of."""
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64, out=out[1:])
    return out


def rolling(total: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words."""
    count = len(total) - size
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    return _mixed((total[size:] - total[:-size]) * _powers(_BACK, count))


def runs_hash(total: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words of every run, their number included."""
    return _mixed((total[stop] - total[start]) * _powers(_BACK, len(total))[start] + (stop - start).astype(np.uint64)).view(np.int64)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every ``width`` values in a row is, the first of equals."""
    at = np.arange(len(values), dtype=np.int32 if len(values) < 1 << 31 else np.int64)
    span = 1
    while span < width:
        step = min(span, width - span)
        right = values[step:] < values[:-step]
        at = np.where(right, at[step:], at[:-step])
        values = np.minimum(values[step:], values[:-step])
        span += step
    return at


class Places(NamedTuple):
    """Chosen places of windows of words: numbers of words count over all texts."""

    fingerprint: np.ndarray
    start: np.ndarray
    """The first window that chooses the place."""
    size: np.ndarray
    """How many windows do; they follow each other."""
    whole: np.ndarray
    """A hash of all their words."""
    total: np.ndarray


def word_places(words: Words, hashes: np.ndarray, min_words: int) -> Places:
    gram = max(1, min_words * 2 // 5)
    total = sums(hashes)
    if len(hashes) < min_words:
        none = np.zeros(0, np.int64)
        return Places(none, none, none, none, total)
    grams = rolling(total, gram)
    at = least(grams, min_words - gram + 1)
    # Windows within one text.
    own = np.flatnonzero(words.text[: len(at)] == words.text[min_words - 1 :])
    at = at[own]
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
    start, size = own[new], np.diff(np.append(new, len(at)))
    return Places(grams[at[new]].view(np.int64), start, size, runs_hash(total, start, start + size - 1 + min_words), total)


class Lines(NamedTuple):
    """Windows of lines; lines with a word are counted over all texts."""

    hashes: np.ndarray
    number: np.ndarray
    """The number of each line in its text, lines without a word counted."""
    text: np.ndarray
    """The text of each window."""
    first: np.ndarray
    """The first line with a word of that text."""
    fingerprint: np.ndarray
    chosen: np.ndarray
    """The first window with a given fingerprint line."""
    content: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    back: np.ndarray
    """Where the context before a window begins."""
    reach: np.ndarray
    """Where the context after a window ends."""


def _least_of(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Where the least value of every range is, the last of equals."""
    out, width, span = np.zeros(len(start), np.int64), stop - start, 1
    at = np.arange(len(values))
    while len(start):
        # Two halves that may overlap cover the ranges of these sizes.
        here = np.flatnonzero((width >= span) & (width < 2 * span))
        one, two = start[here], stop[here] - span
        out[here] = np.where(values[two] <= values[one], at[two], at[one])
        if not (width >= 2 * span).any():
            break
        right = values[span:] <= values[:-span]
        at = np.where(right, at[span:], at[:-span])
        values = np.minimum(values[span:], values[:-span])
        span *= 2
    return out


def line_windows(words: Words, hashes: np.ndarray, min_words: int) -> Lines:
    feeds = np.cumsum(words.data == 10, dtype=np.int32)
    line = feeds[words.starts]
    begin = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.zeros(0, np.int64)
    text = words.text[begin]
    # Words before each line, and the lines each text has.
    before = np.append(begin, len(line))
    edges = np.searchsorted(begin, words.first)
    own = runs_hash(sums(hashes), begin, before[1:])
    stops = np.searchsorted(before, begin + min_words)
    start = np.flatnonzero(stops <= edges[text + 1])
    text, stop = text[start], stops[start]
    low, high = edges[text], edges[text + 1]
    back = np.maximum(np.searchsorted(before, begin[start] - min_words, side="right") - 1, low)
    reach = np.where(stop < high, np.minimum(high, np.append(stops, 0)[stop]), high)
    at = _least_of(own, start, stop)
    new = np.append(True, at[1:] != at[:-1])[: len(at)]
    number = line[begin] - feeds[words.begin - 1][words.text[begin]]
    content = runs_hash(sums(own.view(np.uint64)), start, stop)
    return Lines(own, number, text, low, own[at], new, content, start, stop, back, reach)


def _named(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))


def _batch(arrays: list, schema: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=schema)


def marks(docs: DataFrame, text: str, words: int | None, lines: int | None) -> DataFrame:
    """Fingerprints of windows of so many words, and of lines; those of words with the hash of all their windows' words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in pieces(batch, "text", STEP_BYTES):
                own = words_of(texts(batch, "text", begin, end))
                hashes = hashes_of(own)
                if words is not None:
                    found = word_places(own, hashes, words)
                    whole, at, n = np.unique(found.whole, return_index=True, return_counts=True)
                    yield _marked(False, found.fingerprint[at], whole, n)
                if lines is not None:
                    found = line_windows(own, hashes, lines)
                    mark, n = np.unique(found.fingerprint[found.chosen], return_counts=True)
                    yield _marked(True, mark, np.zeros_like(mark), n)

    return docs.select(F.col(text).alias("text")).mapInArrow(work, MARKS)


def _marked(lines: bool, fingerprint: np.ndarray, whole: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(n), lines)), pa.array(fingerprint), pa.array(whole), pa.array(n.astype(np.int32))]
    return _batch(columns, ["lines", "fingerprint", "whole", "n"])


def found_twice(marked: DataFrame) -> np.ndarray:
    """Filters of ``FILTER_BITS`` bits: fingerprints of lines found twice, of words found twice, and those of words whose
    places differ beyond it. What they let through beside these finds no equal."""
    twice = marked.groupBy("lines", "fingerprint").agg(F.sum("n").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high"))
    kinds = F.when(F.col("lines"), F.array(F.lit(LINES))).when(F.expr("low = high"), F.array(F.lit(WORDS)))
    kinds = kinds.otherwise(F.array(F.lit(WORDS), F.lit(MIXED)))
    twice = twice.where("n > 1").select("fingerprint", F.explode(kinds).alias("kind"))
    slot = f"fingerprint & {(1 << FILTER_BITS) - 1}L"
    rows = twice.groupBy("kind", F.expr(f"cast(shiftright({slot}, 6) AS INT)").alias("word"))
    rows = rows.agg(F.expr("bit_or(shiftleft(1L, cast(fingerprint & 63L AS INT)))").alias("bits")).toArrow()
    out = np.zeros((3, 1 << (FILTER_BITS - 6)), dtype=np.int64)
    out[rows["kind"].to_numpy(), rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def _passed(bits: np.ndarray, fingerprint: np.ndarray) -> np.ndarray:
    slot = fingerprint & ((1 << FILTER_BITS) - 1)
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1


def _spread(start: np.ndarray, size: np.ndarray, step: int = 1) -> tuple[pa.Array, np.ndarray]:
    """List offsets for ranges of so many numbers, and the numbers: from each start on, up or down."""
    edges = np.append(0, np.cumsum(size))
    inner = np.arange(edges[-1]) - np.repeat(edges[:-1], size)
    return pa.array(edges.astype(np.int32)), np.repeat(start, size) + step * inner


def _context(found: Lines, start: np.ndarray, size: np.ndarray, step: int) -> pa.Array:
    offsets, at = _spread(start, size, step)
    pairs = [pa.array(found.hashes[at]), pa.array(found.number[at].astype(np.int32))]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(pairs, fields=list(CONTEXT.value_type)))


def _word_rows(own: Words, found: Places, min_words: int, bits: dict[int, np.ndarray], rows: int) -> Iterator[tuple[np.ndarray, list]]:
    good = np.flatnonzero(_passed(bits[WORDS], found.fingerprint))
    windows = rolling(found.total, min_words).view(np.int64)
    for i in range(0, len(good), rows):
        part = good[i : i + rows]
        start, size, text = found.start[part], found.size[part], own.text[found.start[part]]
        mixed = _passed(bits[MIXED], found.fingerprint[part])
        offsets, at = _spread(start, np.where(mixed, size, 0))
        lists = pa.ListArray.from_arrays(offsets, pa.array(windows[at]), mask=pa.array(~mixed))
        numbers = [pa.array((start - own.first[text]).astype(np.int32)), pa.array(size.astype(np.int32))]
        nulls = [pa.nulls(len(part), k) for k in KINDS[5:]]
        yield text, [pa.array(np.zeros(len(part), bool)), pa.array(found.whole[part]), *numbers, lists, *nulls]


def _line_rows(found: Lines, good: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, list]]:
    for i in range(0, len(good), rows):
        part = good[i : i + rows]
        start, stop, first = found.start[part], found.stop[part], found.first[part]
        offsets, at = _spread(start, stop - start)
        yield found.text[part], [
            pa.array(np.ones(len(part), bool)),
            pa.array(found.content[part]),
            pa.array((start - first).astype(np.int32)),
            pa.array((stop - first).astype(np.int32)),
            pa.nulls(len(part), KINDS[4]),
            pa.ListArray.from_arrays(offsets, pa.array(found.number[at].astype(np.int32))),
            _context(found, start - 1, start - found.back[part], -1),
            _context(found, stop, found.reach[part] - stop, 1),
        ]


def places(docs: DataFrame, text: str, words: int | None, lines: int | None, marked: np.ndarray, rows: int = OUT_ROWS) -> DataFrame:
    """What the filters let through. Of words one row per chosen place: its first window, how many choose it (``size``),
    a hash of all their words (``whole``), and where places with the fingerprint differ the hashes of the windows. Of lines one row
    per window: its lines from ``start`` to ``size`` (end exclusive) and their numbers, a hash of them, and its contexts."""
    kinds = [*([] if words is None else [WORDS, MIXED]), *([] if lines is None else [LINES])]
    # One by one, and only those in use: a worker holds what was sent beside what it reads from that.
    named, sent = _named(docs, text), {kind: share(docs, marked[kind]) for kind in kinds}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {kind: shared(filter_) for kind, filter_ in sent.items()}
        for batch in batches:
            names = batch.select(["doc_id", "text_key"])
            for begin, end in pieces(batch, "text", STEP_BYTES):
                own = words_of(texts(batch, "text", begin, end))
                hashes = hashes_of(own)
                if words is not None:
                    for at, columns in _word_rows(own, word_places(own, hashes, words), words, bits, rows):
                        yield _batch([*names.take(pa.array(at + begin)).columns, *columns], schema)
                if lines is not None:
                    found = line_windows(own, hashes, lines)
                    good = np.flatnonzero(_passed(bits[LINES], found.fingerprint))
                    for at, columns in _line_rows(found, good, rows):
                        yield _batch([*names.take(pa.array(at + begin)).columns, *columns], schema)

    schema = ["doc_id", "text_key", *NAMES]
    return named.mapInArrow(work, f"doc_id {named.schema['doc_id'].dataType.simpleString()}, text_key LONG, {PLACES}")


def found(
    docs: DataFrame, text: str = "text", words: int | None = None, lines: int | None = None, rows: int = OUT_ROWS
) -> tuple[DataFrame, str]:
    """The places of windows of so many words, and of lines of so many words, whose fingerprints are found twice; and where they are."""
    twice = found_twice(marks(docs, text, words, lines))
    return written(places(docs, text, words, lines, twice, rows), "repeat-places")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table written to the shared folder and read back, and where it is."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of this job that nothing reads any more, and let Spark delete its shuffle files."""
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)
