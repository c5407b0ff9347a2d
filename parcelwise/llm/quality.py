"""Quality rules with thresholds that the data set, per language and source.

Each text is measured once. The ratios of texts that pass the base rules go into quantile sketches: counts per
logarithmic bucket (relative width 2 %), one sketch per language, source and ratio. Sketches merge by
adding counts, so those of a language, and of everything, are sums of the small ones; a group with too few
texts takes its language's, or else everything's. The fences lie ``REACH`` interquartile ranges outside the quartiles, with a least
range per ratio, so a group of clean texts loses none of them. The fences are then joined to the texts.

Everything is DataFrame code. The sketches are made after partial counts in every task, so one source with a third of
all rows costs no more than others.

Defined cases: a null text has no words and fails the base rules; null languages and sources are a group of their own;
equal rows get equal verdicts; an empty table gives an empty one; columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import without
from parcelwise.session import cut_lineage

MIN_WORDS = 50
# A bucket holds values whose ratio is below this.
GAMMA = 1.02
ZERO = -1_000_000
REACH = 4.0
MIN_GROUP = 200
# Ratio -> (least interquartile range, whether values can also be too low).
RATIOS = {
    "word_length": (0.3, True),
    "symbols_per_word": (0.05, False),
    "dup_lines": (0.1, False),
    "repeat_words": (0.1, False),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Fences of so many groups (a few MB) are sent to all tasks, so that the texts stay where they are.
FEW_GROUPS = 20_000
# Positions in the low bits of a packed hash; longer texts are sorted by the whole hash.
PLACE_BITS = 24


def _neighbours_equal(array: str, same) -> Column:
    """Elements of a sorted array that are like the one before or after."""
    cells = F.col(array)
    return F.filter(
        array,
        lambda x, i: ((i > 0) & same(x, F.get(cells, i - 1))) | ((i + 1 < F.size(cells)) & same(x, F.get(cells, i + 1))),
    )


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from the words in ``_q_words``: words in windows of three that are found twice.

    Most texts repeat no window; they are told by the number of distinct hashes alone. Otherwise the hashes, cut to
    their high bits and packed with their places, are sorted as plain longs; only places with an equal
    neighbour are compared by the whole hash.
    """
    words, empty = F.col("_q_words"), F.array().cast("array<bigint>")
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    df = df.withColumn("_q_hashes", F.when(F.size(words) >= 4, hashes).otherwise(empty))
    repeats = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    all_hashes, low = F.col("_q_hashes"), (1 << PLACE_BITS) - 1
    packed = F.sort_array(
        F.transform("_q_hashes", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    )
    short = F.size("_q_hashes") <= low
    df = df.withColumn("_q_packed", F.when(repeats & short, packed).otherwise(empty))
    near = F.transform(
        _neighbours_equal("_q_packed", lambda a, b: F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)),
        lambda x: x.bitwiseAND(F.lit(low)).cast("int"),
    )
    places = F.when(short, near).otherwise(F.sequence(F.lit(0), F.size("_q_hashes") - 1))
    df = df.withColumn("_q_near", places)
    exact = F.sort_array(F.transform("_q_near", lambda i: F.struct(F.get(all_hashes, i).alias("h"), i.alias("i"))))
    df = df.withColumn("_q_exact", exact)
    at = F.sort_array(F.transform(_neighbours_equal("_q_exact", lambda a, b: a["h"] == b["h"]), lambda x: x["i"]))
    df = df.withColumn("_q_at", at)
    covered = F.transform("_q_at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_q_at"), k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", total)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the five measures and ``base_failed``."""
    names = [*MEASURES, "base_failed"]
    df = without(docs, names).withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_q_words", F.array_remove(F.split("_q_text", "[ \t\n\x0b\x0c\r]+"), ""))
    df = df.withColumn(
        "_q_lines", F.filter(F.split("_q_text", "\n"), lambda line: line.rlike("[^ \t\n\x0b\x0c\r]"))
    )
    df = _repeat_words(df)
    df = (
        df.withColumn("n_words", F.size("_q_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_q_words", "")).cast("long"))
        .withColumn(
            "n_symbols",
            (F.length("_q_text") - F.length(F.regexp_replace("_q_text", "[#*$%&|<>]", ""))).cast("long"),
        )
        .withColumn("n_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))
        .withColumn("_q_n_lines", F.size("_q_lines"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    kept = [F.col(f"`{c}`") for c in df.columns if not c.startswith("_q_")]
    return df.select(*kept, failed.alias("base_failed"), F.col("_q_n_lines").alias("n_lines"))


def ratios() -> dict[str, Column]:
    """The ratios the fences are about, of measured rows."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeat_words": F.col("n_repeat_words") / words,
    }


def sketches(rows: DataFrame) -> DataFrame:
    """One row per language, source, ratio and bucket with its count: a mergeable quantile sketch."""
    cells = F.array(*[F.struct(F.lit(n).alias("ratio"), v.alias("value")) for n, v in ratios().items()])
    long = rows.where("NOT base_failed").select("lang", "source", F.inline(cells))
    bucket = F.when(F.col("value") <= 0, F.lit(ZERO)).otherwise(
        F.floor(F.log("value") / F.log(F.lit(GAMMA))).cast("int")
    )
    return long.groupBy("lang", "source", "ratio", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Both quartiles of every group from its merged sketch, and how many values it holds."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = merged.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("total"))
    middle = F.when(F.col("bucket") == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), F.col("bucket") + 0.5))
    found = [
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, middle)).alias(name) for k, name in ((1, "q1"), (3, "q3"))
    ]
    return placed.groupBy(*keys, "ratio").agg(F.max("total").alias("size"), *found)


def fences(sketch: DataFrame, min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """One row per language and source with ``low_`` and ``high_`` bounds of every ratio."""
    own = _quartiles(sketch, ["lang", "source"])
    by_lang = _quartiles(sketch, ["lang"]).selectExpr("lang AS l2", "ratio AS r2", "size AS s2", "q1 AS a2", "q3 AS b2")
    overall = _quartiles(sketch, []).selectExpr("ratio AS r3", "q1 AS a3", "q3 AS b3")
    rows = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l2")) & (F.col("ratio") == F.col("r2")))
    rows = rows.join(F.broadcast(overall), F.col("ratio") == F.col("r3"))  # one row per ratio

    def chosen(a: str, b: str, c: str) -> Column:
        return F.when(F.col("size") >= min_group, F.col(a)).when(F.col("s2") >= min_group, F.col(b)).otherwise(F.col(c))

    rows = rows.select("lang", "source", "ratio", chosen("q1", "a2", "a3").alias("q1"), chosen("q3", "b2", "b3").alias("q3"))
    out = []
    for name, (least, two_sided) in RATIOS.items():
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * reach
        high, low = F.col("q3") + spread, F.col("q1") - spread
        out.append(F.max(F.when(F.col("ratio") == name, high)).alias(f"high_{name}"))
        if two_sided:
            out.append(F.max(F.when(F.col("ratio") == name, low)).alias(f"low_{name}"))
    return rows.groupBy("lang", "source").agg(*out)


def judged(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Measured rows with ``kept``: the base rules hold and every ratio lies within its group's fences."""
    limits = cut_lineage(bounds, "quality-fences").withColumnsRenamed({"lang": "_q_lang", "source": "_q_source"})
    if limits.count() <= FEW_GROUPS:
        limits = F.broadcast(limits)  # beyond that the join decides by itself
    joined = rows.join(
        limits, F.col("lang").eqNullSafe(F.col("_q_lang")) & F.col("source").eqNullSafe(F.col("_q_source")), "left"
    )
    inside = ~F.col("base_failed")
    for name, value in ratios().items():
        inside = inside & (value <= F.col(f"high_{name}"))
        if RATIOS[name][1]:
            inside = inside & (value >= F.col(f"low_{name}"))
    # A group without fences has only rows that fail the base rules.
    kept = F.coalesce(inside, F.lit(False))
    return joined.select(*[F.col(f"`{c}`") for c in without(rows, ["kept"]).columns], kept.alias("kept"))
