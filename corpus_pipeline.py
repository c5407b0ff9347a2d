"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes the documents its predecessor kept and returns them with the same columns (the last one returns
digests of the encoded texts). Rejected documents are gone for the stages after: those that fail the quality rules; those of
which line dedup leaves no word; all but one of each group of near-duplicates; those contaminated by benchmark items. Line dedup
also shortens texts; ``n_chars``, where there is one, then says the new length. Passages that repeat inside lines go after
near dedup, from the documents it kept: near copies are judged as whole documents before.

Defined cases: those of the operators; a column of the documents that has the name of an operator's result is set aside
while the operator works.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import bpe, fmindex, linededup, passages, quality, simhash
from parcelwise.llm.common import read, read_all
from parcelwise.session import cut_lineage

SHINGLE, RADIUS = 3, 3

RESULTS = {
    *quality.MEASURES, "n_lines", "base_failed", "kept", "spans", "n_removed", "kept_text", "n_hit", "items",
    "passages", "n_passage_words", "cut_text",
    *bpe.FIELDS,
}


def _set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The documents without names that operators use, and what gives the old names back."""
    # Working columns of the operators begin with an underscore.
    names = {c: f"_aside_{c}" if c.lower() in RESULTS or c.startswith("_") else c for c in docs.columns}
    renamed = docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda df: df.select([F.col(f"`{n}`").alias(c) for c, n in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the base rules and lie within the fences of their language and source."""
    rows, back = _set_aside(docs)
    # Measured once: the fences and the filter both read what is written here.
    measured = cut_lineage(quality.measured(rows), "pipeline-measured")
    return back(quality.judged(measured, quality.fences(quality.sketches(measured))).where("kept"))


def _shortened(found: DataFrame, removed: str, kept: str) -> DataFrame:
    """The kept texts as the texts, their new lengths, and no document that lost its last word."""
    some = F.col(kept).rlike("[^ \t\n\x0b\x0c\r]")
    found = found.where((F.col(removed) == 0) | some)
    if "n_chars" in found.columns:
        shorter = F.when(F.col(removed) > 0, F.length(kept)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", shorter.cast(found.schema["n_chars"].dataType))
    return found.withColumn("text", F.col(kept))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; those that had words and have none left are gone."""
    rows, back = _set_aside(docs)
    return back(_shortened(linededup.deduplicated(rows), "n_removed", "kept_text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, without later repeated passages."""
    rows, back = _set_aside(docs)
    # Written once: the passages are marked, looked up and cut in three readings.
    rows = cut_lineage(simhash.survivors(rows, SHINGLE, RADIUS), "pipeline-survivors")
    return back(_shortened(passages.cut(rows), "n_passage_words", "cut_text"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows do not contaminate."""
    rows, back = _set_aside(docs)
    found = fmindex.decontaminated(rows, read(spark, sf_dir, "benchmark", "item_id", "text"), spans=False)
    return back(found.where(~fmindex.contaminated()))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text and what they decode to, as digests."""
    results = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return bpe.encoded(docs.select("doc_id", "text"), "text", results).select("doc_id", *results)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# SQL has no 64-bit hash of texts as the fingerprints need it; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next one."""
    docs = read_all(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
