"""Output codes: the codewords, the features, held-out accuracy, odd texts."""

import numpy as np
import pytest

from parcelwise.llm import langid


@pytest.mark.parametrize("size", [2, 3, 4, 7, 8, 30])
def test_codewords_differ_in_several_bits(size):
    code = langid.codewords(size)
    gaps = [(code[a] != code[b]).sum() for a in range(size) for b in range(a)]
    assert min(gaps) >= max(1, 2 ** (size - 2) if size <= 7 else 5)
    columns = {tuple(c) for c in code.T}
    assert len(columns) == code.shape[1] and all(0 < sum(c) < size for c in columns)
    assert not any(tuple(1 - x for x in c) in columns for c in columns)


def test_features_stay_inside_their_text():
    block = ["Ab, c!".encode(), b"", "é".encode()]
    grams, starts = langid.features(block)
    assert starts.tolist() == [0, 6, 8]
    assert bytes(grams[0].astype(np.uint8)) == " ab c ".encode() + b"  " + " é ".encode()
    alone = [langid.features([b])[0] for b in block]
    for order in range(3):
        assert grams[order].tolist() == [x for a in alone for x in a[order].tolist()]


def test_margins_of_long_and_split_texts_agree():
    draw = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], draw.random((3, langid.FEATURES)))
    texts = [bytes(draw.integers(32, 127, 50).astype(np.uint8)) for _ in range(20)]
    together = model.raw_margins(texts)
    assert np.allclose(together, np.concatenate([model.raw_margins([t]) for t in texts]))


def test_held_out_accuracy(spark, small):
    from parcelwise.llm.queries import op3_langid

    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op3_langid(spark, small).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(want) and len(held) > 20
    assert np.mean([want[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_languages_are_never_used(spark, small):
    """Other labels on the held-out rows change nothing."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    held = langid.remainder("doc_id", 4) == 2
    wrong = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    models = [langid.fit(d.where(~held), sample=40) for d in (docs, wrong)]
    assert models[0].languages == models[1].languages and np.array_equal(models[0].weights, models[1].weights)


ODD = [(1, None), (2, ""), (3, "12 ++ 34"), (4, "漢"), (5, "the"), (5, "the"), (None, "und das " * 50_000)]


def test_odd_texts(spark):
    train = [(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("und das ist der Hund", "de"), ("no label", None), (None, "en")] * 5)]
    model = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(*r, "keep") for r in ODD], "doc_id long, text string, score string")
    got = langid.identified(df, model).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["text"]): r for r in got}
    for key in ODD[:3]:
        assert (by[key]["lang_pred"], by[key]["score"]) == ("und", 0.0)
    assert by[5, "the"]["lang_pred"] == "en" and by[ODD[-1]]["lang_pred"] == "de"
    assert by[4, "漢"]["lang_pred"] in ("de", "en")
    assert langid.identified(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a text", None)], "doc_id long, text string, lang string")
    assert langid.fit(df) is None
    assert langid.identified(df, None).first()["lang_pred"] == "und"
    one = langid.fit(spark.createDataFrame([(1, "a text", "en")], "doc_id long, text string, lang string"))
    assert langid.identified(df, one).first()["lang_pred"] == "en"
