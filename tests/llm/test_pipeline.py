"""The pipeline against its stages in plain Python, on documents planted for each."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parcelwise.llm import bpe, linededup
from tests.llm.test_fmindex import plain as plain_hits
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_quality import plain as plain_measures
from tests.llm.test_simhash import plain_classes, plain_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def documents():
    """Plain documents, and for every stage some that it has to catch."""
    draw = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("", "n", "rt", "s")]
    line = lambda n=12: " ".join(draw.choices(words, k=n))
    body = lambda n=9: "\n".join(line() for _ in range(n))
    passage = "\n".join(line(15) for _ in range(4))
    bench = [(1, line(30)), (2, line(16))]
    texts = [body() for _ in range(60)]
    texts += ["too short", None, "", "again and again " * 60, " ".join(w + "###" for w in line(80).split())]
    texts += [body(5) + "\n" + passage + "\n" + body(4) for _ in range(4)]
    # One long line each, so that line dedup leaves the near copies alone.
    long = line(400)
    texts += [long, long + " end", long.upper()]
    texts += [texts[3], texts[3], body(6) + "\n" + bench[0][1], body(30) + " " + bench[1][1].upper()]
    rows = [(i, t, "en", f"s{i % 2}", None if t is None else len(t), "k") for i, t in enumerate(texts)]
    return rows + [rows[5], (None, body(), None, None, 1, None)], bench


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, bench = documents()
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), rows, bench


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def by_id(df):
    return sorted((str(r["doc_id"]), str(r["text"])) for r in df.collect())


def named(rows):
    return sorted((str(r[0]), str(r[1])) for r in rows)


def test_stages_are_in_order():
    names = ["quality rules", "line dedup", "near dedup", "decontamination", "encoding"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names


def test_each_stage_on_its_own_input(spark, tables):
    folder, rows, bench = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    one = stage("quality rules")(spark, docs, folder)
    assert one.columns == docs.columns
    marked = {i for i, t, *_ in rows if t and "###" in t}
    good = [r for r in rows if not plain_measures(r[1])[-1] and r[0] not in marked]
    assert by_id(one) == named(good) and marked

    two = stage("line dedup")(spark, one, folder)
    order = sorted({(r[0] is not None, r[0] or 0, r[1]): r for r in good}.values(), key=lambda r: (r[0] is not None, r[0] or 0))
    cut = plain_lines([(r[0], r[1]) for r in order], linededup.MIN_WORDS)
    left = []
    for r in good:
        lines = r[1].split("\n")
        text = "\n".join(x for n, x in enumerate(lines) if n not in cut.get(r[0], ()))
        if text.strip():
            left.append((r[0], text))
    assert by_id(two) == named(left) and len(left) < len(good)
    assert two.where("n_chars <> length(text) AND doc_id IS NOT NULL").count() == 0

    three = stage("near dedup")(spark, two, folder)
    classes = plain_classes([plain_fingerprint(t) for _, t in left], [i for i, _ in left])
    first = {(i, t) for (i, t), c in zip(left, classes) if i == c}
    assert by_id(three) == named(first) and len(first) < len(left) and three.columns == docs.columns

    four = stage("decontamination")(spark, three, folder)
    kept = [d for d, (n, hit, _) in zip(sorted(first, key=str), plain_hits(sorted(first, key=str), bench)) if not (hit and 20 * hit >= n)]
    assert by_id(four) == named(kept) and len(kept) == len(first) - 1

    want = {(str(i), len(ids), bpe_digest(ids)) for i, ids in ((i, library().encode(t, add_special_tokens=False).ids) for i, t in kept)}
    five = stage("encoding")(spark, four, folder).collect()
    assert {(str(r["doc_id"]), r["n_tokens"], r["ids_sha256"]) for r in five} == want
    ran = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, ran)) == sorted(map(str, five))


def library():
    return Tokenizer.from_file(bpe.default_path())


def bpe_digest(ids):
    import hashlib

    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_an_empty_table_runs_through(spark, tables, tmp_path):
    folder, _, bench = tables
    spark.read.parquet(f"{folder}/documents.parquet").where(F.lit(False)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_named_like_working_columns_come_through(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(20)
    for name in ("_id", "_key", "_spans", "_lines", "_q_x", "_q_lang", "_p_words"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for name in ("quality rules", "line dedup", "near dedup"):
        out = stage(name)(spark, docs, folder)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r["_id"] == f"_id{r['doc_id']}" and r["_q_x"] == f"_q_x{r['doc_id']}" for r in rows if r["doc_id"] is not None)
