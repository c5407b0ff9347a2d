"""Document likelihood over all segmentations into the pieces of an existing subword vocabulary.

The vocabulary's scores are ranks, so a piece of rank r starts with a weight of 1 / (r + 2). One round of expected
counts over the training words (forward and backward sums over the lattice of every word) turns them into
probabilities of this corpus, the first weights staying as a prior. A document is its words, each after a blank mark, and an end.
Pieces never cross a blank, so its marginal probability is the product over its words, and the forward recursion
runs once per distinct word: over many words at once by numpy, in plain numbers; words that are long or less probable than
those can hold go one by one, in log space. A character without a piece is spelled in byte pieces.

The words are counted over the whole corpus. Documents then meet the words' values in two ways: the
most frequent words (at most ``FREQUENT``, none longer than ``FREQUENT_BYTES``) are sent to all tasks, the rest is joined on the word.
A word of the rest is no more frequent than the ``FREQUENT``-th part of the corpus (or is long), so the join has no hot key.

Defined cases: a null text is empty and has just the end; equal rows get equal results; with no training documents every
token is unknown; an empty table gives an empty one.
"""

from __future__ import annotations

import gc
import math
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import TO_LOWER, pieces, share, shared, text_key, texts
from parcelwise.session import cut_lineage

FREQUENT = 1 << 18
FREQUENT_BYTES = 48
# Words a task counts before it hands them on.
COUNTED = 300_000
MARK = "▁"
END = ""
# Words of more bytes than this go one by one: a step over many words is taken for every position of the longest.
LONG = 128
# Below this a probability is no longer summed in plain numbers: what falls under the least double is then far below rounding.
LEAST = 1e-250
# Bytes of words taken at once.
AT_ONCE = 128 << 10


def default_path() -> str:
    """Where the subword vocabulary of 32,000 pieces is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def start_weights(path: str | None = None) -> dict[str, float]:
    """Log probability of every piece from its score in the vocabulary file; byte pieces are keyed by the character
    U+E000 plus the byte, the end by the empty text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    weight: dict[str, float] = {END: 1.0}
    for i in range(model.vocab_size()):
        if model.is_byte(i):
            weight[chr(0xE000 + int(model.id_to_piece(i)[3:5], 16))] = 1e-4
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e6:
            weight[model.id_to_piece(i)] = 1 / (2 - model.get_score(i))
    total = sum(weight.values())
    return {p: math.log(w / total) for p, w in weight.items()}


class Lattice:
    """Sums over all segmentations of a word."""

    def __init__(self, logs: dict[str, float]):
        self.logs = logs
        # Every prefix of a piece is a key, with None where it is no piece itself: a search stops where no key is left.
        self.steps: dict[str, float | None] = {}
        for piece, log in logs.items():
            if piece and not "" <= piece[0] <= "":
                for size in range(1, len(piece)):
                    self.steps.setdefault(piece[:size], None)
                self.steps[piece] = log

    def spelled(self, char: str) -> float:
        """Log probability of a character in byte pieces."""
        return sum(self.logs[chr(0xE000 + b)] for b in char.encode("utf-8", "replace"))

    def forward(self, text: str) -> tuple[list[float], list[tuple[int, int, float]]]:
        """Log of the summed probability of reaching each position, and the pieces as (start, stop, log probability)
        in order of their starts."""
        steps, size = self.steps, len(text)
        reached: list[float | None] = [None] * (size + 1)
        reached[0] = 0.0
        arcs = []
        for start in range(size):
            here = reached[start]
            stop = start + 1
            log = steps.get(text[start:stop], False)
            if log is False or log is None:  # no piece of one character
                arcs.append((start, stop, self.spelled(text[start])))
                known = log is None
            else:
                arcs.append((start, stop, log))
                known = True
            while known and stop < size:
                stop += 1
                log = steps.get(text[start:stop], False)
                if log is False:
                    break
                if log is not None:
                    arcs.append((start, stop, log))
            at = len(arcs) - 1
            while at >= 0 and arcs[at][0] == start:
                _, stop, log = arcs[at]
                new, old = here + log, reached[stop]
                if old is None:
                    reached[stop] = new
                elif new > old:
                    reached[stop] = new + log1p(exp(old - new))
                else:
                    reached[stop] = old + log1p(exp(new - old))
                at -= 1
        return reached, arcs

    def log_probability(self, word: str) -> float:
        """Natural log of the marginal probability of a word after a blank."""
        return self.forward(MARK + word)[0][-1]

    def expected(self, word: str, times: float, into: dict[str, float]) -> None:
        """Add the expected uses of every piece in so many occurrences of a word."""
        text = MARK + word
        reached, arcs = self.forward(text)
        whole = reached[-1]
        beyond: list[float | None] = [None] * len(reached)
        beyond[-1] = 0.0
        for start, stop, log in reversed(arcs):
            new, old = log + beyond[stop], beyond[start]
            piece = text[start:stop]
            used = times * exp(reached[start] + new - whole)
            if self.steps.get(piece) is not None:
                into[piece] = into.get(piece, 0.0) + used
            else:
                for b in piece.encode("utf-8", "replace"):
                    key = chr(0xE000 + b)
                    into[key] = into.get(key, 0.0) + used
            if old is None:
                beyond[start] = new
            elif new > old:
                beyond[start] = new + log1p(exp(old - new))
            else:
                beyond[start] = old + log1p(exp(new - old))


class Lattices(Lattice):
    """The same sums over many words at once. A word holds no line feed.

    The prefixes of pieces are a trie in two arrays: the child of a node by a character's code is ``base[node] + code``, if its
    ``parent`` is that node. Code 0 is any character that no piece has.
    """

    def __init__(self, logs: dict[str, float]):
        super().__init__(logs)
        self.names = list(logs)
        number = {p: i for i, p in enumerate(self.names)}
        self.bytes_at = [number[chr(0xE000 + b)] for b in range(256)]
        often = Counter(p[-1] for p in self.steps)
        code = {c: i for i, (c, _) in enumerate(often.most_common(), 1)}
        self.codes = np.zeros(0x110000, dtype=np.int32)
        self.codes[[ord(c) for c in code]] = list(code.values())
        base, size = self._places(code)
        self.base = np.zeros(size, dtype=np.int32)
        self.parent = np.full(size, -1, dtype=np.int32)
        # The number of the piece that a node is, or -1.
        self.number = np.full(size, -1, dtype=np.int32)
        node = {"": 0} | {p: base[p[:-1]] + code[p[-1]] for p in self.steps}
        for prefix, place in base.items():
            self.base[node[prefix]] = place
        for prefix, log in self.steps.items():
            self.parent[node[prefix]] = node[prefix[:-1]]
            if log is not None:
                self.number[node[prefix]] = number[prefix]
        self.odds = np.exp(np.array([logs[p] for p in self.names]))

    def _places(self, code: dict[str, int]) -> tuple[dict[str, int], int]:
        """For every prefix that goes on, a base at which its children's places are free; the number of places."""
        below: dict[str, list[int]] = {"": []}
        for prefix in self.steps:
            below.setdefault(prefix[:-1], []).append(code[prefix[-1]])
        first = len(code) + 1  # no base is below 0, and no node has a place that a base of 0 reaches
        taken = np.zeros(len(self.steps) + 2 * (first + 1024), dtype=bool)
        base, low = {}, first
        for prefix, codes in sorted(below.items(), key=lambda x: -len(x[1])):
            if len(codes) < 2:
                break
            own = np.array(codes)
            own_first, at = int(own.min()), low
            while True:
                if at + 1024 + first > len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken), dtype=bool)])
                free = np.flatnonzero(~taken[at : at + 1024]) + (at - own_first)
                fits = np.flatnonzero(~taken[free[:, None] + own].any(axis=1))
                if len(fits):
                    break
                at += 1024
            base[prefix] = int(free[fits[0]])
            taken[base[prefix] + own] = True
            # Where few sets fit, search no more; single children fill it.
            if at > low + 2048:
                low += 1024
        single = [(prefix, codes[0]) for prefix, codes in below.items() if len(codes) == 1]
        taken = np.concatenate([taken, np.zeros(len(single), dtype=bool)])
        for (prefix, c), place in zip(single, np.flatnonzero(~taken[first:])[: len(single)].tolist()):
            base[prefix] = first + place - c
        return base, max(base.values(), default=0) + first + 1

    def _forward(self, words: list[bytes]) -> tuple:
        """The probability of reaching each position, and the arcs by the place of their start in its word."""
        between = "\n" + MARK
        text = MARK + between.encode().join(words).decode(errors="replace") + "\n"
        chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        codes = self.codes[chars]
        ends = np.flatnonzero(chars == 10)
        begins = np.concatenate([[0], ends[:-1] + 1])
        place = np.arange(len(chars)) - np.repeat(begins, ends - begins + 1)

        start = np.flatnonzero(chars != 10)
        node = self.base[0] + codes[start]
        known = self.parent[node] == 0
        number = np.where(known, self.number[node], -1)
        odds = self.odds[number]
        # No piece of one character: an arc in byte pieces.
        other = np.flatnonzero(number < 0)
        spelled, which = np.unique(chars[start[other]], return_inverse=True)
        odds[other] = np.exp([self.spelled(chr(c)) for c in spelled])[which]
        starts, stops, numbers, chances = [start], [start + 1], [number], [odds]
        start, node, stop = start[known], node[known], start[known] + 1
        while len(start):
            child = self.base[node] + codes[stop]
            on = np.flatnonzero(self.parent[child] == node)
            start, node, stop = start[on], child[on], stop[on] + 1
            number = self.number[node]
            whole = np.flatnonzero(number >= 0)
            starts.append(start[whole])
            stops.append(stop[whole])
            numbers.append(number[whole])
            chances.append(self.odds[number[whole]])
        start = np.concatenate(starts)
        order = np.argsort(place[start].astype(np.uint16), kind="stable")
        start, stop, odds = start[order], np.concatenate(stops)[order], np.concatenate(chances)[order]
        number = np.concatenate(numbers)[order]

        reached = np.zeros(len(chars))
        reached[begins] = 1.0
        cuts = np.cumsum(np.bincount(place[start])).tolist()
        # Arcs of one place have different stops: a word has one start there.
        for low, high in zip([0, *cuts], cuts):
            reached[stop[low:high]] += reached[start[low:high]] * odds[low:high]
        return reached, chars, place, ends, start, stop, odds, number

    def _many(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of words to take at once, and of those to take one by one with them."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        short = np.where(size > LONG, 0, size + 4)
        block = np.cumsum(short) // AT_ONCE
        for some in np.split(np.arange(len(words)), np.flatnonzero(np.diff(block)) + 1):
            yield some[size[some] <= LONG], some[size[some] > LONG]

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """:meth:`log_probability` of every word."""
        out = np.empty(len(words))
        for some, single in self._many(words):
            if len(some):
                reached, _, _, ends, *_ = self._forward([words[i] for i in some])
                found = reached[ends]
                least = found < LEAST
                out[some] = np.log(np.where(least, 1.0, found))
                single = np.concatenate([single, some[least]])
            for i in single.tolist():
                out[i] = self.log_probability(words[i].decode(errors="replace"))
        return out

    def all_expected(self, words: list[bytes], times: np.ndarray, into: np.ndarray) -> None:
        """:meth:`expected` of every word; ``into`` has the uses in the order of ``names``."""
        alone: dict[str, float] = {}
        for some, single in self._many(words):
            if len(some):
                reached, chars, place, ends, start, stop, odds, number = self._forward([words[i] for i in some])
                found = reached[ends]
                least = found < LEAST
                # From here to the end, by the occurrences per probability of the whole word.
                beyond = np.zeros(len(chars))
                beyond[ends] = np.where(least, 0.0, times[some] / np.where(least, 1.0, found))
                late = place[stop]
                order = np.argsort(late.astype(np.uint16), kind="stable")
                first, last, chance = start[order], stop[order], odds[order]
                cuts = np.cumsum(np.bincount(late)).tolist()
                for low, high in zip(cuts[-2::-1], cuts[:0:-1]):
                    beyond[first[low:high]] += chance[low:high] * beyond[last[low:high]]
                used = reached[start] * odds * beyond[stop]
                pieces_at = number >= 0
                into += np.bincount(number[pieces_at], used[pieces_at], minlength=len(into))
                spelled, which = np.unique(chars[start[~pieces_at]], return_inverse=True)
                for c, n in zip(spelled.tolist(), np.bincount(which, used[~pieces_at]).tolist()):
                    for b in chr(c).encode("utf-8", "replace"):
                        into[self.bytes_at[b]] += n
                single = np.concatenate([single, some[least]])
            for i in single.tolist():
                self.expected(words[i].decode(errors="replace"), times[i], alone)
        if alone:
            into += np.array([alone.get(p, 0.0) for p in self.names])


def word_counts(docs: DataFrame) -> DataFrame:
    """All distinct words with their number in the training documents (0 if only others have them); the empty word
    is the end. ``docs`` has ``text`` and the flag ``held_out``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"]
            )

        trained: Counter = Counter()
        for batch in batches:
            for text, held in zip(texts(batch, "text"), batch.column("held_out").to_pylist()):
                words = text.translate(TO_LOWER).split()
                if held:
                    for w in set(words):
                        trained[w] += 0
                else:
                    trained.update(words)
                    trained[b""] += 1
                if len(trained) > COUNTED:
                    yield out(trained)
                    trained = Counter()
        yield out(trained)

    rows = docs.select("text", "held_out").mapInArrow(work, "word BINARY, c LONG")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def fitted(words: DataFrame, start: dict[str, float]) -> dict[str, float]:
    """Log probabilities of the pieces after one round of expected counts over the training words."""
    sent = share(words, Lattices(start))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # many small tuples, no cycles
        lattice = shared(sent)
        total = np.zeros(len(lattice.names))
        for batch in batches:
            own, times = batch.column("word").to_pylist(), batch.column("c").to_numpy()
            empty = np.fromiter((not w for w in own), dtype=bool, count=len(own))
            total[lattice.names.index(END)] += times[empty].sum()
            lattice.all_expected([w for w in own if w], times[~empty], total)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lattice.names[i] for i in used], pa.string()), pa.array(total[used])], names=["piece", "uses"]
        )

    # One row per piece of the vocabulary at most.
    used = words.where("c > 0").mapInArrow(work, "piece STRING, uses DOUBLE").groupBy("piece").agg(F.sum("uses").alias("uses"))
    uses = {r["piece"]: r["uses"] for r in used.collect()}
    prior = float(len(start))
    total = sum(uses.values()) + prior
    return {p: math.log((uses.get(p, 0.0) + prior * math.exp(log)) / total) for p, log in start.items()}


def valued(words: DataFrame, logs: dict[str, float], tokens: int, distinct: int) -> DataFrame:
    """Words with ``base`` and ``model``: their log10 probabilities by smoothed counts and by the lattice."""
    sent = share(words, Lattices(logs))
    below = tokens + 0.1 * (distinct + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        lattice = shared(sent)
        for batch in batches:
            own = batch.column("word").to_pylist()
            empty = np.fromiter((not w for w in own), dtype=bool, count=len(own))
            found = np.where(empty, lattice.logs[END], lattice.log_probabilities(own))
            base = np.log10((batch.column("c").to_numpy() + 0.1) / below)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base), pa.array(found / math.log(10))],
                names=["word", "c", "base", "model"],
            )

    return words.select("word", "c").mapInArrow(work, "word BINARY, c LONG, base DOUBLE, model DOUBLE")


def frequent(words: DataFrame, most: int = FREQUENT) -> list:
    """The most frequent known words, ``most`` at the utmost: all above a count that the histogram of counts gives."""
    step = F.floor(F.log2("c") * 16)
    short = words.where(f"c > 0 AND octet_length(word) BETWEEN 1 AND {FREQUENT_BYTES}")
    histogram = short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    room, least = most, None
    for row in histogram:
        room -= row["n"]
        if room < 0:
            break
        least = row["step"]
    return [] if least is None else short.where(step >= least).collect()


SUMS = "n_tokens LONG, n_known LONG, base DOUBLE, model DOUBLE"


def _hot_and_cold(docs: DataFrame, common: list, ends: tuple[int, float, float]) -> DataFrame:
    """One row per document with the sums over its frequent words and the end, and one per other distinct word.

    The first kind has a word of its own that no text holds (a blank and the document's key), so that it
    spreads like the words in the join that follows.
    """
    table = {bytes(r["word"]): i for i, r in enumerate(common)}
    sent = share(docs, (table, np.array([[r["base"], r["model"]] for r in common]).reshape(-1, 2)))
    end_known, end_base, end_model = ends

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, values = shared(sent)
        values = np.concatenate([values, np.zeros((1, 2))])  # index -1: not a frequent word
        get = number.get
        for batch in batches:
            for start, stop in pieces(batch, "text"):
                at, word, times, sums = [], [], [], []
                keys = batch.column("text_key").slice(start, stop - start).to_pylist()
                for place, text in enumerate(texts(batch, "text", start, stop)):
                    own = text.translate(TO_LOWER).split()
                    index = np.fromiter(map(get, own, repeat(-1)), dtype=np.int64, count=len(own))
                    base, model = values[index].sum(axis=0)
                    rest = index < 0
                    at.append(place)
                    word.append(b" %d" % (keys[place] or 0))
                    times.append(0)
                    sums.append((len(own) + 1, int(len(own) - rest.sum()) + end_known, base + end_base, model + end_model))
                    for w, n in Counter(compress(own, rest)).items():
                        at.append(place)
                        word.append(w)
                        times.append(n)
                        sums.append((0, 0, 0.0, 0.0))
                rows = batch.slice(start, stop - start).select(["doc_id", "text_key", "held_out"]).take(pa.array(at))
                four = list(zip(*sums))
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(word, pa.binary()), pa.array(times), *map(pa.array, four, kinds)],
                    names=[*rows.schema.names, "word", "times", "n_tokens", "n_known", "base", "model"],
                )

    rows = docs.select("doc_id", text_key("text").alias("text_key"), "held_out", "text")
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(work, f"{keys}, word BINARY, times LONG, {SUMS}")


def scored(docs: DataFrame, path: str | None = None, most: int = FREQUENT) -> DataFrame:
    """One row per document (``doc_id``, ``text``, ``held_out``): token counts, the base score and the lattice score."""
    words = cut_lineage(word_counts(docs), "word-counts")
    totals = words.agg(F.sum("c").alias("tokens"), F.count(F.when(F.col("c") > 0, 1)).alias("distinct")).first()
    tokens, distinct = int(totals["tokens"] or 0), int(totals["distinct"] or 0)
    logs = fitted(words, start_weights(path))
    table = cut_lineage(valued(words, logs, tokens, distinct), "word-values")
    ending = table.where("octet_length(word) = 0").collect()
    below = tokens + 0.1 * (distinct + 1)
    ends = (
        (1, ending[0]["base"], ending[0]["model"]) if ending else (0, math.log10(0.1 / below), logs[END] / math.log(10))
    )
    rows = _hot_and_cold(docs, frequent(table, most), ends)
    values = table.withColumnsRenamed({"base": "w_base", "model": "w_model"})
    met = rows.join(values, "word", "left")
    known = F.col("n_known") + F.when(F.col("c") > 0, F.col("times")).otherwise(0)
    by = met.groupBy("doc_id", "text_key", "held_out").agg(
        F.sum((F.col("times") == 0).cast("int")).alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(known).alias("n_known"),
        F.sum(F.col("base") + F.coalesce(F.col("times") * F.col("w_base"), F.lit(0.0))).alias("base_score"),
        F.sum(F.col("model") + F.coalesce(F.col("times") * F.col("w_model"), F.lit(0.0))).alias("score"),
    )
    # Equal rows have added up; each gets its share.
    one = by.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return one.select(
        "doc_id",
        "held_out",
        F.floor(F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        F.floor(F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
