"""Language identification by error-correcting output codes.

Every language has a codeword; one binary classifier per bit predicts it from byte n-grams (one to three bytes,
hashed). A classifier's weights are the log odds of each n-gram between the languages whose bit is one and the others.
A text's bits become margins, scaled per bit to -1 and 1 for its two sides. Decoding chooses the language
with the least loss, each bit weighted by how reliable it was for that language; a small lead over
the second one is flagged.

The model is fitted on a sample: documents whose hash falls below ``sample / documents of the language``, that is
``sample`` documents of each language as expected value (and all, of a language with fewer), whole texts. Its size, languages times
``FEATURES`` counts, does not depend on the corpus. Prediction reads all texts whole, in blocks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if there is nothing to learn
from; with a single language every other text is that; rows without a language are never learned from; equal rows get equal
results; columns named like the results are replaced.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import TO_LOWER, pieces, share, shared, texts, with_fields, without
from parcelwise.session import cut_lineage

# Hashed n-grams: single bytes, then a range for pairs and one for triples.
RANGE = 1 << 14
FEATURES = 256 + 2 * RANGE
SAMPLE = 2000
MAX_LANGUAGES = 500
# Lead of the best language over the second, as share of their losses, below which a text is ambiguous.
LEAD = 0.2
SLOPE = 3.0
UNKNOWN = "und"
BLOCK = 1 << 20

_LETTERS = bytes(range(97, 123)) + bytes(range(128, 256))
_TO_LETTERS = bytes(TO_LOWER[b] if TO_LOWER[b] in _LETTERS else 32 for b in range(256))


def codewords(size: int) -> np.ndarray:
    """One row of 0 and 1 per language, no two bits alike or opposite.

    Up to seven languages all useful bits are taken; beyond that, of many random bits those that split the
    languages in halves, enough for a least distance that corrects several errors.
    """
    if size < 2:
        return np.zeros((size, 0), dtype=np.int64)
    if size <= 7:
        return np.array([[(bits >> (size - 1 - i)) & 1 for bits in range(1, 2 ** (size - 1))] for i in range(size)])
    draw = random.Random(size)
    # Of few languages there are not so many ways to take half.
    wanted = min(15 * math.ceil(math.log2(size)), math.comb(size, size // 2) // 2 * 3 // 4)
    bits: list[tuple[int, ...]] = []
    seen: set[tuple[int, ...]] = set()
    while len(bits) < wanted:
        ones = set(draw.sample(range(size), size // 2))
        bit = tuple(int(i in ones) for i in range(size))
        if bit not in seen:
            seen.update((bit, tuple(1 - b for b in bit)))
            bits.append(bit)
    code = np.array(bits).T
    assert all((code[a] != code[b]).any() for a, b in combinations(range(size), 2))
    return code


def features(block: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram length the feature of every byte, and where each text starts.

    Texts are lower-cased, what is no letter becomes one blank, and a blank stands at both ends. N-grams that would run
    into the next text have the feature ``FEATURES``, which weighs nothing.
    """
    flat = [b" " + b" ".join(t.translate(_TO_LETTERS).split()) + b" " for t in block]
    sizes = np.array([len(t) for t in flat])
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(flat), dtype=np.uint8).astype(np.uint32)
    second = np.concatenate([raw[1:], [0]]).astype(np.uint32)
    third = np.concatenate([raw[2:], [0, 0]])[: len(raw)].astype(np.uint32)
    pair = raw << 8 | second
    triple = pair << 8 | third
    shift = np.uint32(32 - RANGE.bit_length() + 1)
    two = (256 + ((pair * np.uint32(2654435761)) >> shift)).astype(np.int64)
    three = (256 + RANGE + ((triple * np.uint32(2246822519)) >> shift)).astype(np.int64)
    two[ends - 1] = FEATURES
    three[ends - 1] = FEATURES
    three[ends - 2] = FEATURES
    return [raw.astype(np.int64), two, three], ends - sizes


class Model:
    """Codewords, weights per feature and bit, and how to read the margins."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        smoothed = counts + 0.5
        for a, b in ((0, 256), (256, 256 + RANGE), (256 + RANGE, FEATURES)):
            smoothed[:, a:b] /= smoothed[:, a:b].sum(axis=1, keepdims=True)
        share = [smoothed[self.code[:, b] == side].mean(axis=0) for b in range(self.code.shape[1]) for side in (1, 0)]
        odds = [np.log(share[2 * b] / share[2 * b + 1]) for b in range(self.code.shape[1])]
        self.weights = np.zeros((FEATURES + 1, self.code.shape[1]), dtype=np.float32)
        if odds:
            self.weights[:FEATURES] = np.array(odds, dtype=np.float32).T
        self.middle = np.zeros(self.code.shape[1])
        self.half = np.ones(self.code.shape[1])
        self.trust = np.ones(self.code.shape)

    def raw_margins(self, block: list[bytes]) -> np.ndarray:
        """The mean weight of a text's n-grams for every bit."""
        out = np.zeros((len(block), self.code.shape[1]))
        for at, stop in _chunks(block):
            part = block[at:stop]
            grams, starts = features(part)
            sizes = np.diff(np.concatenate([starts, [len(grams[0])]]))
            total = sum(np.add.reduceat(self.weights[g], starts, axis=0, dtype=np.float64) for g in grams)
            out[at:stop] = total / sizes[:, None]
        return out

    def calibrate(self, means: np.ndarray) -> None:
        """Scale every bit so that the mean margins of its two sides lie at -1 and 1. ``means``: per language and bit."""
        for b in range(self.code.shape[1]):
            one, zero = means[self.code[:, b] == 1, b].mean(), means[self.code[:, b] == 0, b].mean()
            self.middle[b], self.half[b] = (one + zero) / 2, max((one - zero) / 2, 1e-6)

    def signs(self) -> np.ndarray:
        return 2 * self.code - 1

    def margins(self, block: list[bytes]) -> np.ndarray:
        return (self.raw_margins(block) - self.middle) / self.half

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score and whether the lead is small, for every row of margins."""
        losses = np.zeros((len(margins), len(self.languages)))
        weight = self.trust / self.trust.sum(axis=1, keepdims=True)
        for i, sign in enumerate(self.signs()):
            losses[:, i] = (np.logaddexp(0, -SLOPE * margins * sign) * weight[i]).sum(axis=1)
        best = losses.argmin(axis=1)
        odds = np.exp(-2 * SLOPE * (losses - losses.min(axis=1, keepdims=True)))
        two = np.sort(losses, axis=1)[:, :2]
        close = (two[:, 1] - two[:, 0]) < LEAD * two[:, 1] if two.shape[1] > 1 else np.zeros(len(best), dtype=bool)
        return best, 1 / odds.sum(axis=1), close


def _chunks(block: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(block):
        size += len(text)
        if size >= BLOCK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(block):
        yield start, len(block)


def remainder(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is the empty text."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(name.cast("string"), F.lit("")).cast("binary")) % parts


def sampled(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], DataFrame]:
    """The languages, and about ``sample`` rows of each, chosen by a hash of their content."""
    found = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the label column does not look like one")
    if not found:
        return [], labelled
    draw = F.pmod(F.xxhash64("doc_id", "lang", F.lit("language sample")), F.lit(1 << 30))
    limit = F.create_map(*[x for r in found for x in (F.lit(r["lang"]), F.lit(int(min(1, sample / r["n"]) * (1 << 30))))])
    return [r["lang"] for r in found], labelled.where(draw < F.element_at(limit, F.col("lang")))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rows with ``doc_id``, ``text`` and ``lang``; None when there are none."""
    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    languages, rows = sampled(known, sample)
    if not languages:
        return None
    rows = cut_lineage(rows, "language-sample")
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(place), FEATURES + 1), dtype=np.int64)
        for batch in batches:
            block, own = texts(batch, "text"), np.array([place[x] for x in batch.column("lang").to_pylist()])
            for at, stop in _chunks(block):
                grams, starts = features(block[at:stop])
                sizes = np.diff(np.concatenate([starts, [len(grams[0])]]))
                lang = np.repeat(own[at:stop], sizes)
                for g in grams:
                    total += np.bincount(lang * (FEATURES + 1) + g, minlength=total.size).reshape(total.shape)
        where = np.nonzero(total[:, :FEATURES])
        yield pa.RecordBatch.from_arrays(
            [pa.array(where[0]), pa.array(where[1]), pa.array(total[where])], names=["lang", "gram", "n"]
        )

    counted = rows.mapInArrow(count, "lang LONG, gram LONG, n LONG").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), FEATURES))
    counts[counted["lang"], counted["gram"]] = counted["n"]
    model = Model(languages, counts)
    bits = model.code.shape[1]

    def look(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(sent)
        for batch in batches:
            m = model.margins(texts(batch, "text"))
            right = (np.sign(m) == model.signs()[[place[x] for x in batch.column("lang").to_pylist()]]).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(list(m), pa.list_(pa.float64())), pa.array(list(right), pa.list_(pa.float64()))],
                names=["lang", "m", "r"],
            )

    def means(column: str) -> np.ndarray:
        cells = [F.avg(F.get(column, F.lit(b))).alias(str(b)) for b in range(bits)]
        got = rows.mapInArrow(partial(look, share(rows, model)), "lang STRING, m ARRAY<DOUBLE>, r ARRAY<DOUBLE>").groupBy("lang").agg(*cells).collect()
        out = np.zeros((len(languages), bits))
        for r in got:
            out[place[r["lang"]]] = [r[str(b)] for b in range(bits)]
        return out

    if bits:
        model.calibrate(means("m"))
        # A bit that is no better than chance for a language hardly counts there.
        model.trust = np.maximum(means("r") - 0.5, 0.01)
    return model


def identified(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The table with ``lang_pred``, ``score`` and ``ambiguous``."""
    rows = without(df, ["lang_pred", "score", "ambiguous"])
    names = [F.col(f"`{c}`") for c in rows.columns]
    if model is None:
        return rows.select(
            *names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous")
        )
    sent = share(df, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        for batch in batches:
            for start, stop in pieces(batch, text):
                part = batch.slice(start, stop - start)
                best, score, close = own.decode(own.margins(texts(batch, text, start, stop)))
                new = [pa.array([own.languages[i] for i in best], pa.string()), pa.array(score), pa.array(close)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *new], names=[*part.schema.names, "lang_pred", "score", "ambiguous"]
                )

    seen = rows.withColumn("_lettered", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    out = seen.mapInArrow(work, with_fields(seen, "lang_pred STRING, score DOUBLE, ambiguous BOOLEAN"))
    lettered = F.col("_lettered")
    return out.select(
        *names,
        F.when(lettered, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(lettered, F.col("score")).otherwise(0.0).alias("score"),
        (F.col("ambiguous") | ~lettered).alias("ambiguous"),
    )
