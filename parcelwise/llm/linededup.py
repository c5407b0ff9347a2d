"""Line deduplication by winnowing over line hashes.

Lines that hold a word are hashed (words joined by single blanks). A window starts at every such line and runs over as
few lines as hold ``MIN_WORDS`` words. The least line hash of each window (the last one of equals) is its fingerprint: windows of the
same lines choose the same one, so a run of ``MIN_WORDS`` words that two documents share always shows as a
fingerprint found twice. Only windows around such fingerprints are handed on (by a filter of bounded size, ``winnow``); they
meet the first occurrence of their whole content, the match is extended both ways line by line, and the later run goes.

Documents come in the order of (doc_id, text); the first occurrence stays. Beyond the window, lines are compared as far as
``MIN_WORDS`` words reach: what is equal beyond that lies in a window of its own. Occurrences of one window, however
many, are reduced to the first before the shuffle and joined to that one row; they are never paired.

Defined cases: a null text has no lines and stays null; lines without a word are kept unless the run around them goes;
a run that overlaps its own first occurrence loses only what lies beyond; equal rows (same doc_id and text) count
as one document and stay all; a null doc_id comes first; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm import winnow
from parcelwise.llm.common import text_key, without
from parcelwise.session import cut_lineage

MIN_WORDS = 50


def windows_of(text: bytes, min_words: int = MIN_WORDS) -> list[tuple]:
    """The windows of a text: fingerprint, whether it is the first with this fingerprint line, hash of its lines, first
    and last line (lines with a word counted, end exclusive)."""
    words = winnow.words_of([text])
    own = winnow.line_windows(words, winnow.hashes_of(words), min_words)
    return list(zip(*[x.tolist() for x in (own.fingerprint, own.chosen, own.content, own.start, own.stop)]))


def _equal_lines(mine: str, other: str) -> Column:
    """How many lines of two contexts are equal from the start."""
    pairs = F.arrays_zip(F.col(mine), F.col(other))
    return F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, p: F.when(
            s["on"] & F.coalesce(p[mine]["hash"] == p[other]["hash"], F.lit(False)),
            F.struct((s["n"] + 1).alias("n"), F.lit(True).alias("on")),
        ).otherwise(F.struct(s["n"].alias("n"), F.lit(False).alias("on"))),
        lambda s: s["n"],
    )


def _line_at(place: Column) -> Column:
    """The line number of a place in a window or in the context before it."""
    return F.when(
        place < F.col("start"), F.get("before", F.col("start") - 1 - place)["line"]
    ).otherwise(F.get("inside", place - F.col("start")))


def matches(windows: DataFrame) -> DataFrame:
    """Runs of lines to delete: one row per later window, with its lines ``first`` to ``last``."""
    here = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "text_key", "start")
    first = (
        windows.groupBy("content")
        .agg(
            F.min(F.struct(here.alias("at"), F.struct("stop", "before", "after").alias("rest"))).alias("first"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .selectExpr(
            "content",
            "first.at.doc_id AS o_id",
            "first.at.text_key AS o_key",
            "first.at.start AS o_start",
            "first.rest.stop AS o_stop",
            "first.rest.before AS o_before",
            "first.rest.after AS o_after",
        )
    )
    # Written, so that the join's two sides are plain tables: a window that very many documents hold is then split.
    first = cut_lineage(first, "line-firsts")
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_key") == F.col("o_key"))
    later = windows.join(first, "content").where(~(same & (F.col("start") == F.col("o_start"))))
    later = later.withColumn("ahead", _equal_lines("after", "o_after")).withColumn("back", _equal_lines("before", "o_before"))
    begin = F.col("start") - F.col("back")
    # Inside one document every line that goes equals one before it, down to the first occurrence.
    later = later.withColumn("begin", F.when(same, F.greatest(begin, F.col("o_stop"))).otherwise(begin))
    extended = F.when(F.col("ahead") > 0, F.get("after", F.col("ahead") - 1)["line"]).otherwise(F.get("inside", F.size("inside") - 1))
    inside = F.col("begin") < F.col("stop")
    first_line = F.when(inside, _line_at(F.col("begin"))).otherwise(F.get("after", F.col("begin") - F.col("stop"))["line"])
    return later.where(F.col("begin") < F.col("stop") + F.col("ahead")).select(
        "doc_id", "text_key", first_line.alias("first"), extended.alias("last")
    )


def runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, places: DataFrame | None = None) -> DataFrame:
    """Per document with later repeated runs, ``spans`` of line numbers (both ends included), merged.

    ``places`` are those of :func:`winnow.found` for these documents and ``min_words``; without them they are found here.
    """
    if places is None:
        places, _ = winnow.found(docs, text, lines=min_words)
    columns = "whole AS content", "start", "size AS stop", "inside", "before", "after"
    windows = places.where("lines").selectExpr("doc_id", "text_key", *columns)
    # Overlapping and adjoining runs of a document become one; they are as many as its lines at most.
    by = Window.partitionBy("doc_id", "text_key").orderBy("first", "last")
    upto = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = matches(windows).distinct().withColumn("new", (upto.isNull() | (F.col("first") > upto + 1)).cast("int"))
    marked = marked.withColumn("island", F.sum("new").over(by))
    merged = marked.groupBy("doc_id", "text_key", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    spans = F.sort_array(F.collect_list(F.struct("first", "last")))
    return merged.groupBy("doc_id", "text_key").agg(spans.alias("spans"))


def deduplicated(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    beside: DataFrame | None = None,
    places: DataFrame | None = None,
) -> DataFrame:
    """The documents with ``spans`` (deleted lines, numbered from 0, both ends included), ``n_lines``, ``n_removed``
    and ``kept_text``.

    ``beside`` has further columns by (doc_id, text_key), which come along in the same join of the texts; ``places`` as in :func:`runs`.
    """
    rows = without(docs, ["spans", "n_lines", "n_removed", "kept_text"])
    found, further = runs(docs, text, min_words, places), []
    if beside is not None:
        further = [c for c in beside.columns if c not in ("doc_id", "text_key")]
        other = beside.withColumnsRenamed({"doc_id": "_b_id", "text_key": "_b_key"})
        same = F.col("doc_id").eqNullSafe(F.col("_b_id")) & (F.col("text_key") == F.col("_b_key"))
        # A null text has no run, so the key tells on which side a row is.
        name = F.when(F.col("text_key").isNull(), F.col("_b_id")).otherwise(F.col("doc_id"))
        found = found.join(other, same, "full_outer").select(
            name.alias("doc_id"), F.coalesce("text_key", "_b_key").alias("text_key"), "spans", *further
        )
    found = found.withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "spans": "_spans"})
    joined = rows.join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & text_key(text).eqNullSafe(F.col("_key")), "left"
    )
    names = [F.col(f"`{c}`") for c in [*rows.columns, *further]]
    none = F.array().cast("array<struct<first:int,last:int>>")
    joined = joined.select(*names, F.coalesce("_spans", none).alias("spans"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1)
    stays = F.filter(
        F.split(text, "\n", -1), lambda line, i: ~F.exists("spans", lambda x: (i >= x["first"]) & (i <= x["last"]))
    )
    # Only texts that lose lines are taken apart.
    kept = F.when(F.size("spans") > 0, F.array_join(stays, "\n")).otherwise(F.col(text))
    feeds = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    count = F.coalesce(feeds + 1, F.lit(0)).cast("long")
    return joined.select(*names, "spans", count.alias("n_lines"), removed.alias("n_removed"), kept.alias("kept_text"))
