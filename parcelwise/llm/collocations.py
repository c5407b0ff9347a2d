"""Phrases that occur more often together than their parts suggest, by an FM-index per shard over word ids.

A shard is a few million consecutive words of one language, read by one task, as word ids with a break (id 0) between pieces.
Its index is the Burrows-Wheeler transform of the ids and of their reverse, each in a wavelet matrix. A phrase
is an interval of rows in both; it is extended by one word to the left in the one and to the right in the other, and the
counts of smaller words move the other side's interval along. So all phrases up to a depth are
enumerated level by level, with their counts, all intervals of a level at once. Rows need to be in order only as
deep as phrases go, which bounds the sort.

Counts are summed across shards. A phrase that is frequent has frequent parts, so three passes over the written shards
suffice: words are counted by a hash, then phrases of two frequent words; the frequent words, and the phrases whose pairs
of neighbours are all frequent, are then counted as texts. What earlier passes found goes to the tasks as bits, 32 for
each entry and 64 MB at most. Beyond that, and where hashes collide, more phrases are counted than needed, never
fewer: the last sums decide.

Defined cases: a null text is an empty one, a null language is ``und``; a text without words adds nothing; equal rows count each;
equal scores are in the order of count and phrase; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from parcelwise.llm.common import LOWER, UPPER, pieces, release, share, shared, texts
from parcelwise.session import cut_lineage, new_path

MIN_COUNT = 10
MAX_WORDS = 3
# A phrase goes if a longer one that holds it has at least so many hundredths of its count.
COVERED = 50
BEST = 2000
SCALE = 1_000_000

# Words of a shard, and rows handed on at once.
SHARD_WORDS = 1 << 20
OUT_ROWS = 1 << 16
# A longer text is cut between pieces, so that a shard ends in it; a single piece stays whole.
TEXT_BYTES = 8 << 20
FILE_SHARDS = 4
FILTER_BITS = 16, 29
# Of a hash, what words and pairs are first counted by.
KEY_BITS = 40

# A to Z lower-cased, what ends a piece as line feeds, a tab as a blank.
_CLEAN = bytes.maketrans(UPPER + b".,;:!?\x0b\x0c\r\t", LOWER + b"\n" * 9 + b" ")
_END = re.compile(b"[.,;:!?\n\x0b\x0c\r]")
BREAK, NOTHING = 0, 1

SHARDS = "lang STRING, n LONG, words BINARY, ids BINARY"


def parts(text: bytes, step: int = TEXT_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``step`` bytes, cut where a piece ends."""
    at = 0
    while len(text) - at > step and (end := _END.search(text, at + step)):
        yield text[at : end.start()]
        at = end.end()
    yield text[at:]


def numbering() -> defaultdict:
    """Numbers words as they come, from 2; a break is 0 and what lies between two blanks is 1."""
    found: defaultdict = defaultdict()
    found.default_factory = found.__len__
    found[b"\n"], found[b""] = BREAK, NOTHING
    return found


def as_bytes(ids: np.ndarray) -> bytes:
    """The lowest bytes of all ids, then the next ones, and so on: the higher ones are few and compress well."""
    return np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def as_ids(stored: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(stored, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Buffer:
    """The words of one language on their way into a shard."""

    def __init__(self) -> None:
        self.number = numbering()
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        parts = text.translate(_CLEAN).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.number.__getitem__, parts), np.int32, len(parts))
        ids = ids[ids != NOTHING]
        self.ids += [ids, np.zeros(1, np.int32)]
        self.size += len(ids) + 1

    def row(self, lang: str) -> pa.RecordBatch:
        """Words in the order of their numbers, ids counted from 1."""
        ids = np.concatenate(self.ids)
        # Several breaks in a row are one.
        ids = ids[np.concatenate([[True], (ids[1:] > 0) | (ids[:-1] > 0)])]
        ids = np.where(ids > 0, ids - 1, 0).astype(np.int32)
        words = b"\n".join(list(self.number)[2:])
        count = np.count_nonzero(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([count]), pa.array([words], pa.binary()), pa.array([as_bytes(ids)], pa.binary())],
            names=["lang", "n", "words", "ids"],
        )


def shards(docs: DataFrame, size: int = SHARD_WORDS) -> DataFrame:
    """The texts (``lang``, ``text``) as shards of word ids, one language each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Buffer] = {}
        total = 0
        for batch in batches:
            for start, stop in pieces(batch, "text"):
                langs = batch.column("lang").slice(start, stop - start).to_pylist()
                for lang, text in zip(langs, texts(batch, "text", start, stop)):
                    for part in parts(text):
                        buffer = open_.setdefault(lang, Buffer())
                        before = buffer.size
                        buffer.add(part)
                        total += buffer.size - before
                        # A full shard goes; with many languages the largest one does.
                        if buffer.size >= size or total >= 2 * size:
                            full = max(open_, key=lambda x: open_[x].size)
                            total -= open_[full].size
                            yield open_.pop(full).row(full)
        for lang, buffer in open_.items():
            yield buffer.row(lang)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(work, SHARDS)


def stored_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Language, words and ids of one shard after the other."""
    for batch in batches:
        for row in range(batch.num_rows):
            lang, words, ids = (batch.column(c)[row].as_py() for c in ("lang", "words", "ids"))
            yield lang, words.split(b"\n") if words else [], as_ids(ids)


def hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word of a language; index 0 is the break."""
    head = lang.encode() + b"\0"
    out = np.zeros(len(words) + 1, np.uint64)
    out[1:] = np.fromiter((xxh3_64_intdigest(head + w) for w in words), np.uint64, len(words))
    return out


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two neighbours from theirs."""
    out = left * np.uint64(0x9E3779B97F4A7C15) + right
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        out = (out ^ (out >> np.uint64(33))) * np.uint64(factor)
    return out ^ (out >> np.uint64(33))


def order_of(symbols: np.ndarray, largest: int, depth: int) -> np.ndarray:
    """Positions in the order of the next ``depth`` symbols, digit by digit from the last one."""
    order = None
    for step in range(depth - 1, -1, -1):
        key = symbols if step == 0 else np.concatenate([symbols[step:], np.zeros(min(step, len(symbols)), symbols.dtype)])
        for shift in range(0, max(1, int(largest).bit_length()), 16):
            digit = (key >> shift).astype(np.uint16)  # of 16 bits, which numpy sorts by counting
            at = np.argsort(digit if order is None else digit[order], kind="stable")
            order = at if order is None else order[at]
    return order


class Levels:
    """A wavelet matrix: the symbols of a sequence bit by bit from the top, with counts of zeros before each place."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.zeros: list[np.ndarray] = []
        every = np.arange(largest + 1)
        first = np.zeros(largest + 1, np.int32)
        for bit in self.bits:
            zero = symbols & (1 << bit) == 0
            count = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(zero, out=count[1:])
            self.zeros.append(count)
            symbols = np.concatenate([symbols[zero], symbols[~zero]])
            before = count[first]
            first = np.where(every >> bit & 1 == 1, count[-1] + first - before, before)
        self.first = first  # of every symbol, where its places start below the last bit

    def inside(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """The symbols in every interval of places, ascending: (interval, symbol, how often before it, how often in it)."""
        low, high = low.astype(np.int32), high.astype(np.int32)
        which, symbol = np.arange(len(low), dtype=np.int32), np.zeros(len(low), np.int32)
        for zeros in self.zeros:
            low0, high0 = zeros[low], zeros[high]
            low = np.stack([low0, zeros[-1] + low - low0], 1).ravel()
            high = np.stack([high0, zeros[-1] + high - high0], 1).ravel()
            symbol = np.stack([symbol << 1, symbol << 1 | 1], 1).ravel()
            some = high > low
            low, high, symbol, which = low[some], high[some], symbol[some], np.repeat(which, 2)[some]
        return which, symbol.astype(np.int64), low - self.first[symbol], (high - low).astype(np.int64)


class Side:
    """The index of one direction: rows in the order of the next ``depth`` symbols, and the symbols before them."""

    def __init__(self, symbols: np.ndarray, largest: int, depth: int):
        order = order_of(symbols, largest, depth)
        self.levels = Levels(symbols[order - 1], largest)  # the sequence ends in a break, which precedes its start
        count = np.bincount(symbols, minlength=largest + 1)
        self.start = np.cumsum(count) - count
        self.count = count


class Phrases:
    """Phrases of one length of a shard: their words, and their intervals in both directions."""

    def __init__(self, words: np.ndarray, count: np.ndarray, here: np.ndarray, there: np.ndarray):
        self.words, self.count, self.here, self.there = words, count, here, there

    def turned(self) -> Phrases:
        return Phrases(self.words[:, ::-1], self.count, self.there, self.here)


def extended(side: Side, phrases: Phrases) -> Phrases:
    """All phrases one word longer, by a word before them as ``side`` reads; breaks extend nothing."""
    which, symbol, before, count = side.levels.inside(phrases.here, phrases.here + phrases.count)
    # Smaller symbols in the same interval: how far the other direction's interval moves in.
    upto = np.cumsum(count) - count
    head = np.searchsorted(which, np.arange(len(phrases.count)))
    moved = upto - upto[head][which] if len(which) else upto
    word = symbol > BREAK
    which, symbol, before, count, moved = which[word], symbol[word], before[word], count[word], moved[word]
    words = np.concatenate([symbol[:, None], phrases.words[which]], axis=1)
    return Phrases(words, count, side.start[symbol] + before, phrases.there[which] + moved)


def enumerated(symbols: np.ndarray, largest: int, depth: int) -> Iterator[Phrases]:
    """The phrases of two to ``depth`` words of a sequence that ends in a break, one length at a time.

    Extension goes to the left and to the right in turn; only the direction in use is held.
    """
    here = Side(symbols, largest, depth - 1)
    start = np.cumsum(here.count) - here.count
    known = np.flatnonzero(here.count[1:]) + 1
    found = Phrases(known[:, None], here.count[known], start[known], start[known])
    for length in range(2, depth + 1):
        forward = length % 2 == 0
        if length > 2:
            # Reversed, the break at the end comes first; it goes back to the end.
            here = None
            here = Side(symbols if forward else np.concatenate([symbols[-2::-1], symbols[-1:]]), largest, depth - 1)
            found = found.turned()
        found = extended(here, found)
        yield found if forward else found.turned()


def short(keys: np.ndarray) -> np.ndarray:
    """The first bits of hashes, as numbers that are not negative."""
    return (keys >> np.uint64(64 - KEY_BITS)).view(np.int64)


def filter_bits(rows: DataFrame) -> np.ndarray:
    """The entries of a column ``key`` of hashes as bits, two of each: 32 for every entry at least, within bounds."""
    rows = cut_lineage(rows, "frequent-keys")
    least, most = FILTER_BITS
    size = min(most, max(least, (32 * rows.count()).bit_length()))
    # The lowest and the highest bits of a hash.
    slots = rows.select(F.explode(F.array(F.expr(f"key & {(1 << size) - 1}L"), F.shiftright("key", KEY_BITS - size))).alias("slot"))
    words = slots.groupBy(F.expr("CAST(shiftright(slot, 6) AS INT) AS word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63L AS INT))) AS bits")).toArrow()
    out = np.zeros(1 << (size - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    # Nothing needs the counts behind the bits any more.
    release(rows.sparkSession)
    return out


def among(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which hashes have both their bits."""
    key, size = short(keys), (len(bits) * 64).bit_length() - 1
    has = lambda slot: (bits[slot >> 6] >> (slot & 63)) & 1 == 1
    return has(key & ((1 << size) - 1)) & has(key >> (KEY_BITS - size))


def key_counts(stored: DataFrame) -> DataFrame:
    """(key, n): the words of every shard, by hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in stored_shards(batches):
            yield from counted(hashes(lang, words)[1:], np.bincount(ids, minlength=len(words) + 1)[1:])

    return stored.select("lang", "words", "ids").mapInArrow(work, "key LONG, n LONG")


def counted(keys: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Hashes with their counts, some rows at a time."""
    keys = short(keys)
    for i in range(0, len(keys), OUT_ROWS):
        columns = [pa.array(keys[i : i + OUT_ROWS]), pa.array(count[i : i + OUT_ROWS].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n"])


def _frequent_symbols(words: list[bytes], ids: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with breaks for words that are not frequent, and the numbers of the words left."""
    good = among(bits, keys)
    good[0] = False
    left = np.flatnonzero(good)
    new = np.zeros(len(keys), np.int32)
    new[left] = np.arange(1, len(left) + 1)
    symbols = new[ids]
    if not len(symbols) or symbols[-1]:
        symbols = np.append(symbols, BREAK)
    return symbols[np.concatenate([[True], (symbols[1:] > 0) | (symbols[:-1] > 0)])], left


def paired(symbols: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of a sequence in which all neighbours are good pairs, a break after each, and the words left in them.

    Phrases in these stretches are those whose neighbours all are good, with the counts they have in the whole.
    """
    good = good & (symbols[:-1] > BREAK) & (symbols[1:] > BREAK)
    follows, before = np.append(good, False), np.concatenate([[False], good])
    kept = np.flatnonzero(follows | before)
    last = ~follows[kept]
    out = np.zeros(len(kept) + np.count_nonzero(last) + (not len(kept)), np.int32)
    used = np.flatnonzero(np.bincount(symbols[kept]))
    new = np.zeros(int(symbols.max(initial=0)) + 1, np.int32)
    new[used] = np.arange(1, len(used) + 1)
    out[np.arange(len(kept)) + np.cumsum(last) - last] = new[symbols[kept]]
    return out, used


def pair_counts(stored: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(key, n): the phrases of two frequent words of every shard, by hash."""
    sent = share(stored, frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared(sent)
        for lang, words, ids in stored_shards(batches):
            keys = hashes(lang, words)
            symbols, left = _frequent_symbols(words, ids, keys, bits)
            own = np.concatenate([keys[:1], keys[left]])
            for pairs in enumerated(symbols, len(left), 2):
                yield from counted(mixed(own[pairs.words[:, 0]], own[pairs.words[:, 1]]), pairs.count)

    return stored.select("lang", "words", "ids").mapInArrow(work, "key LONG, n LONG")


def phrase_counts(stored: DataFrame, frequent: np.ndarray, pairs: np.ndarray, max_words: int) -> DataFrame:
    """(named, n): the frequent words of every shard, and phrases whose neighbours all are frequent pairs, after their language."""
    sent = share(stored, (frequent, pairs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, both = shared(sent)
        for lang, words, ids in stored_shards(batches):
            keys = hashes(lang, words)
            symbols, left = _frequent_symbols(words, ids, keys, bits)
            own = np.concatenate([keys[:1], keys[left]])
            text = [words[i - 1].decode(errors="replace") for i in left.tolist()]
            alone = np.bincount(symbols, minlength=len(left) + 1)[1:]
            yield from named(lang, text, np.arange(len(left))[:, None], alone)
            symbols, used = paired(symbols, among(both, mixed(own[symbols[:-1]], own[symbols[1:]])))
            text = ["", *[text[i - 1] for i in used.tolist()]]
            for found in enumerated(symbols, len(used), max_words):
                yield from named(lang, text, found.words, found.count)

    return stored.select("lang", "words", "ids").mapInArrow(work, "named STRING, n LONG")


def named(lang: str, text: list[str], words: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases of one length by their words, some rows at a time."""
    for i in range(0, len(count), OUT_ROWS):
        part = words[i : i + OUT_ROWS].T.tolist()
        phrase = list(map(" ".join, zip(*[map(text.__getitem__, column) for column in part])))
        columns = [pa.array([f"{lang}\t{p}" for p in phrase], pa.string()), pa.array(count[i : i + OUT_ROWS].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["named", "n"])


def counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, size: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases of one to ``max_words`` words (lang, phrase, words, f), and all words per language (lang, n)."""
    path = new_path(docs.sparkSession, "phrase-shards")
    shards(docs, size).write.option("maxRecordsPerFile", FILE_SHARDS).option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    often = lambda rows: filter_bits(rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("key"))
    frequent = often(key_counts(stored))
    pairs = often(pair_counts(stored, frequent))
    found = phrase_counts(stored, frequent, pairs, max_words).groupBy("named").agg(F.sum("n").alias("f"))
    # One short text per row in the shuffle; a phrase holds no tab.
    phrase = F.substring_index("named", "\t", -1)
    lang = F.expr("substring(named, 1, length(named) - length(substring_index(named, '\t', -1)) - 1)")
    found = found.select(lang.alias("lang"), phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("words"), "f")
    totals = stored.groupBy("lang").agg(F.sum("n").alias("n"))
    return cut_lineage(found.where(F.col("f") >= min_count), "phrase-counts"), totals


def scored(frequent: DataFrame, covered: int = COVERED) -> DataFrame:
    """The phrases of two and more words with ``a``, ``l``, ``r`` and ``score`` of their lowest cut, without those a longer one covers."""
    longer = frequent.where("words > 1").withColumnRenamed("f", "a")
    at = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cut = longer.withColumn("k", at).withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    part = lambda name, f: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cut = cut.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    # Products take up to 32 digits.
    whole = lambda c: f"CAST({c} AS DECIMAL(16, 0))"
    score = f"CAST(({whole('a')} * {whole('a')} * {SCALE}) DIV ({whole('l')} * {whole('r')}) AS BIGINT)"
    least = F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r")).alias("least")
    found = cut.groupBy("lang", "phrase", "words", "a").agg(least).select("lang", "phrase", "words", "a", "least.l", "least.r", "least.score")
    # Every run of words inside a longer candidate, with that candidate's count.
    held = longer.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    held = held.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("size"))))
    inside = F.array_join(F.slice(F.split("phrase", " "), F.col("k") + 1, F.col("size")), " ")
    most = held.groupBy("lang", inside.alias("phrase")).agg(F.max("a").alias("longest"))
    free = F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * covered)
    return found.join(most, ["lang", "phrase"], "left").where(free).drop("longest")


def mined(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    best: int = BEST,
    covered: int = COVERED,
    size: int = SHARD_WORDS,
) -> DataFrame:
    """Each language's ``best`` phrases: (lang, rank, phrase, words, a, l, r, n, score).

    ``docs`` has (lang, text). ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest cut, ``n`` all words.
    """
    frequent, totals = counts(docs, min_count, max_words, size)
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = scored(frequent, covered).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "words", "a", "l", "r", "n", "score")
