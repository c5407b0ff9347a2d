"""Repeated passages wherever they begin: winnowing over runs of words.

A later occurrence of ``MIN_WORDS`` equal words in a row goes, also when it begins or ends inside a line; what goes is
exactly the union of all such windows of words that stood before, in the order of (doc_id, text) and within a text from
left to right. Words are what blanks part, compared by 64-bit hashes.

Each window of words holds ``MIN_WORDS`` - GRAM + 1 grams; the least gram hash (the first of equals) is its fingerprint, so
equal windows choose the same one. Fingerprints found once end there. For the others there is one row per place, with all the
windows that choose it. A place that equals an earlier document's, in all these windows, is settled at once. Where all places of
a fingerprint are equal, no other place has their windows, so those that repeat inside a document are settled too. Where they
differ, the windows of one place of each kind, and of those that repeat inside, meet their first occurrences, which are found
before the join.

Defined cases: a null text has no words and stays null; a window that overlaps its own first occurrence loses only what lies
beyond; equal rows (same doc_id and text) count as one document; a null doc_id comes first; an empty table gives an
empty one; columns named like the results are replaced. Blanks around a passage stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import BLANKS, pieces, release, text_key, with_fields, without
from parcelwise.llm.winnow import OUT_ROWS, STEP_BYTES, found, remove, words_of, written

MIN_WORDS = 50
# Places handed on at once.
OUT_PLACES = OUT_ROWS

_WORD = re.compile(f"[^{BLANKS}]+")
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "text_key", "start")


def _same() -> Column:
    """Whether a row and the first occurrence it met are of one document."""
    return F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_key") == F.col("o_key"))


def _later() -> Column:
    """Whether a row is another place than the first occurrence it met."""
    return ~(_same() & (F.col("start") == F.col("o_start")))


FIRST = "at.doc_id AS o_id", "at.text_key AS o_key", "at.start AS o_start"


def repeats(docs: DataFrame, text: str, min_words: int, places: DataFrame | None = None) -> DataFrame:
    """Per document with later repeated windows, ``_p_words``: word numbers (end exclusive), not merged.

    A place whose windows all stand in an earlier document, word for word, is settled as a whole. What is compared
    window by window is one place of each kind, and places that repeat inside a document, where the fingerprint has several kinds.
    ``places`` are those of :func:`winnow.found` for these documents and ``min_words``; without them they are found here.
    """
    made = []
    if places is None:
        places, path = found(docs, text, words=min_words, rows=OUT_PLACES)
        made.append(path)
    here = places.where(~F.col("lines")).select("doc_id", "text_key", "whole", "start", "size", "windows")
    first = here.groupBy("whole").agg(F.min(F.struct(_place().alias("at"), "windows")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1 OR first.windows IS NOT NULL")
    # Written, so that a passage that very many documents hold can be split in the join.
    first, path = written(first.selectExpr("whole", "first.at AS at", "first.windows AS windows", "n"), "passage-firsts")
    made.append(path)
    release(docs.sparkSession)
    again = first.where("n > 1").selectExpr("whole", *FIRST, "windows IS NULL AS alike")
    stop = F.col("start") + F.col("size") - 1 + min_words
    later = here.withColumn("stop", stop).drop("windows", "size").join(again, "whole").where(_later())
    begin = F.when(_same(), F.greatest("start", F.col("o_start") + min_words)).otherwise(F.col("start"))
    # Written, since both what is settled and what is compared further come from this join.
    later = later.select("doc_id", "text_key", "whole", "start", begin.alias("begin"), "stop", (~_same() | F.col("alike")).alias("settled"))
    later, path = written(later, "passage-later")
    made.append(path)
    settled = later.where("settled").select("doc_id", "text_key", "begin", "stop")
    inside = later.where(~F.col("settled")).join(first.select("whole", "windows"), "whole")
    alone = first.where("windows IS NOT NULL").selectExpr("at.doc_id AS doc_id", "at.text_key AS text_key", "at.start AS start", "windows")
    each = alone.unionByName(inside.select("doc_id", "text_key", "start", "windows"))
    each = each.select("doc_id", "text_key", F.col("start").alias("_at"), F.posexplode("windows").alias("_i", "content"))
    each = each.select("doc_id", "text_key", "content", (F.col("_at") + F.col("_i")).alias("start"))
    least = each.groupBy("content").agg(F.min(_place()).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least, path = written(least.selectExpr("content", *FIRST), "passage-windows")
    made.append(path)
    met = each.join(least, "content").where(_later())
    single = met.select("doc_id", "text_key", begin.alias("begin"), (F.col("start") + min_words).alias("stop"))
    spans = F.collect_list(F.struct(F.col("begin").alias("first"), "stop"))
    out, _ = written(settled.unionByName(single).groupBy("doc_id", "text_key").agg(spans.alias("_p_words")), "passage-words")
    # The result is written, so what it was made from can go before the texts are shuffled.
    remove(docs.sparkSession, made)
    return out


def cut(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with ``passages`` (removed, in code points, end exclusive), ``n_passage_words`` and
    ``cut_text``."""
    rows = without(docs, ["passages", "n_passage_words", "cut_text"])
    found = repeats(rows, text, min_words).withColumnsRenamed({"doc_id": "_p_id", "text_key": "_p_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_p_id")) & text_key(text).eqNullSafe(F.col("_p_key"))
    joined = rows.join(found, same, "left").select(*[rows[f"`{c}`"] for c in rows.columns], "_p_words")
    return applied(joined, text)


def merged(text: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each text that overlap or adjoin as one, empty ones left out: text, first, stop."""
    some = first < stop
    text, first, stop = text[some], first[some], stop[some]
    if not len(text):
        return text, first, stop
    order = np.lexsort((first, text))
    text, first, stop = text[order], first[order], stop[order]
    # Every text's numbers lie beyond those of the one before, with a gap.
    wide = text * (int(stop.max()) + 2)
    upto = np.maximum.accumulate(wide + stop)
    new = np.flatnonzero(np.append(True, (wide + first)[1:] > upto[:-1]))
    return text[new], first[new], (upto - wide)[np.append(new[1:], len(text)) - 1]


def _cut(bodies: list[bytes | None], own: pa.ListArray) -> tuple[pa.Array, np.ndarray, list[bytes | None]]:
    """Passages in code points, their words, and what stays, of several texts with their spans of words."""
    words = words_of([b or b"" for b in bodies])
    text = np.repeat(np.arange(len(bodies)), pc.list_value_length(own).fill_null(0).to_numpy())
    pairs = own.flatten()
    numbers = [pairs.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("first", "stop")]
    text, first, stop = merged(text, *numbers)
    begin, end = words.starts[words.first[text] + first], words.ends[words.first[text] + stop - 1]
    # Bytes that begin a character, counted up to each place.
    chars = np.append(0, np.cumsum((words.data & 0xC0) != 0x80, dtype=np.int32))
    base = chars[words.begin][text]
    edges = pa.array(np.append(0, np.cumsum(np.bincount(text, minlength=len(bodies)))).astype(np.int32))
    ends = [pa.array((chars[x] - base).astype(np.int32)) for x in (begin, end)]
    spans = pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays(ends, fields=list(SPANS.value_type)))
    kept, at = list(bodies), edges.to_pylist()
    begin, end = (begin - words.begin[text]).tolist(), (end - words.begin[text]).tolist()
    for i, body in enumerate(bodies):
        if at[i] < at[i + 1]:
            here = slice(at[i], at[i + 1])
            kept[i] = b"".join(body[a:b] for a, b in zip([0, *end[here]], [*begin[here], len(body)]))
    sizes = np.bincount(text, weights=stop - first, minlength=len(bodies)).astype(np.int64)
    return spans, sizes, kept


def applied(joined: DataFrame, text: str = "text") -> DataFrame:
    """Documents with their ``_p_words`` (null: none) get the columns of :func:`cut`."""
    rows = joined.drop("_p_words")
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in pieces(batch, text, STEP_BYTES):
                part = batch.slice(begin, end - begin)
                spans, sizes, kept = _cut(part.column(text).cast(pa.binary()).to_pylist(), part.column("_p_words"))
                part = part.select(names)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, spans, pa.array(sizes), pa.array(kept, pa.string())],
                    names=[*part.schema.names, "passages", "n_passage_words", "cut_text"],
                )

    fields = "passages ARRAY<STRUCT<start: INT, end: INT>>, n_passage_words LONG, cut_text STRING"
    return joined.mapInArrow(work, with_fields(rows, fields))
