"""The registered corpus queries: each applies one operator to a whole table and derives its digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import (
    bpe,
    chat,
    collocations,
    fmindex,
    langid,
    lattice,
    linededup,
    passages,
    quality,
    secrets,
    sharding,
    simhash,
    termsearch,
    tokencounts,
    winnow,
)
from parcelwise.llm.common import read
from parcelwise.session import cut_lineage

SHARDS = 8
SHARD_SEED = 20
CONTEXT = 2048


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into eight shards whose row counts differ by one at most."""
    text = F.col("text")
    rows = read(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shard(rows, SHARDS, SHARD_SEED).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and adaptive fences for all documents."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    # The measures are written once: both the sketches and the verdicts read them.
    rows = cut_lineage(quality.measured(docs).drop("text"), "quality-measures")
    found = quality.judged(rows, quality.fences(quality.sketches(rows)))
    return found.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from three quarters of them."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs.where(langid.remainder("doc_id", 4) != 2))
    held = (langid.remainder("doc_id", 4) == 2).alias("held_out")
    found = langid.identified(docs.select("doc_id", "text", held), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from every participant's point of view."""
    return chat.perspectives(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of nine tenths of them."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return lattice.scored(docs.select("doc_id", "text", (langid.remainder("doc_id", 10) == 0).alias("held_out")))


def op6_fmindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents, and the spans to remove."""
    found = fmindex.decontaminated(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        fmindex.contaminated().alias("contaminated"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.array_join(spans, ","), 256).alias("spans_sha256"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by their SimHash."""
    found = simhash.classes(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secrets.scanned(read(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)
    count = [secrets.count_of("base", k).alias(f"n_{k}") for k in secrets.KINDS[:3]]
    return found.select(
        "doc_id", *count, F.sha2(secrets.as_text("base"), 256).alias("base_sha256"), secrets.as_text("secrets").alias("spans")
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the byte-level vocabulary and decoded again."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encoded(docs, "text", ("n_tokens", "ids_sha256", "decoded_sha256")).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op10_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later repeated runs in all documents: of whole lines, and of words wherever they begin."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    # Both kinds of places are found in the same two readings of the texts.
    places, _ = winnow.found(docs, words=passages.MIN_WORDS, lines=linededup.MIN_WORDS)
    words = passages.repeats(docs, "text", passages.MIN_WORDS, places)
    found = linededup.deduplicated(docs, beside=words, places=places).withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")
    found = passages.applied(found)
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["first"].cast("string"), x["last"].cast("string")))
    inside = F.transform("passages", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.array_join(spans, ",").alias("removed_lines"),
        "kept_sha256",
        "n_passage_words",
        F.array_join(inside, ",").alias("passages"),
        F.sha2("cut_text", 256).alias("cut_sha256"),
    )


def op11_termsearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's best documents of all documents."""
    return termsearch.ranked(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language in all documents."""
    found = collocations.mined(read(spark, sf_dir, "documents", "lang", "text"))
    return found.withColumns({c: F.col(c).cast("long") for c in ("rank", "words")})


def op13_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens every document has, and whether that is more than a context holds."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    found = tokencounts.counted(docs.select("doc_id", size, "text"), keep_text=False)
    return found.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_langid": op3_langid,
    "op4_perspectives": op4_perspectives,
    "op5_lattice": op5_lattice,
    "op6_fmindex": op6_fmindex,
    "op7_simhash": op7_simhash,
    "op8_secrets": op8_secrets,
    "op9_bpe": op9_bpe,
    "op10_linededup": op10_linededup,
    "op11_termsearch": op11_termsearch,
    "op12_collocations": op12_collocations,
    "op13_tokencounts": op13_tokencounts,
}
