"""Secret scan: three fixed patterns, and a battery of randomness tests under false-discovery control.

Every run of 20 or more characters of the usual encodings, with a letter and a digit, is a candidate. Its encoding is
inferred from the characters it uses; its characters become numbers in that alphabet. Three tests ask whether they
could be drawn evenly and independently: chi-squared over eight ranges of the alphabet, runs above and below its
middle, and correlation of neighbours. Three times the least p-value (at most 1) is the candidate's p: near even for random strings, small
for words, paths and numbering.

Which p is enough depends on the length, since short strings pass by accident: per length class, random candidates are
estimated from those above 0.5 (a random one lies above p with probability (1 - p / 3)^3), and the least threshold is taken at which the
estimated share of others among the accepted is at most ``FALSE_SHARE``. Counts per class and threshold are made in
the tasks; a few dozen rows reach the driver and become a literal.

Everything is DataFrame code on one pass over the texts; spans are code points, end exclusive.

Defined cases: a null text is empty and has no span; equal rows get equal spans; an empty table gives an empty one;
columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import without
from parcelwise.session import cut_lineage

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ["assign", "access", "hex", "random"]

# An equals sign is padding at the end, or parts a name from its value: then the value is a candidate of its own.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?"
# Alphabets in order of their characters, each with the pattern a candidate must match; the first match counts.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = [
    ("base16", "^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("base16", "^[0-9A-F]+$", DIGITS + LOWER[:6].upper()),
    ("base32", "^[A-Z2-7]+$", DIGITS[2:8] + LOWER.upper()),
    ("base36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + LOWER.upper() + LOWER),
    ("base64", "^[A-Za-z0-9+/]+$", "+/" + DIGITS + LOWER.upper() + LOWER),
]
BINS = 8
LEVELS = [0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5]
FALSE_SHARE = 0.05
NEVER = 2.0
# Length classes: two per doubling.
CLASSES = 2


def _normal_below(z: Column) -> Column:
    """The normal distribution function by its logistic approximation (error below 0.0002)."""
    return 1 / (1 + F.exp(-(z * 1.5976 + z * z * z * 0.070565992)))


def _two_sided(z: Column) -> Column:
    return 2 * (1 - _normal_below(F.least(F.abs(z), F.lit(12.0))))


def spans_of(text: Column, pattern: str) -> Column:
    """All matches from left to right as structs of start, end and the matched string."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    parts = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("match"), F.slice(parts, 1, F.size(found)).alias("gap"))
    start = F.struct(
        F.array().cast("array<struct<start:int,end:int,match:string>>").alias("spans"), F.lit(0).alias("at")
    )
    walked = F.aggregate(
        pairs,
        start,
        lambda s, p: F.struct(
            F.concat(
                s["spans"],
                F.array(
                    F.struct(
                        (s["at"] + F.length(p["gap"])).alias("start"),
                        (s["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("end"),
                        p["match"].alias("match"),
                    )
                ),
            ).alias("spans"),
            (s["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("at"),
        ),
        lambda s: s["spans"],
    )
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(text.rlike(pattern), walked).otherwise(none)


def _place_in(alphabet: str):
    return lambda c: F.instr(F.lit(alphabet), c) - 1


def _numbers(value: Column) -> Column:
    """Characters as numbers of the inferred alphabet, and its size."""
    even = F.rtrim(F.translate(value, "-_", "+/"), F.lit("="))
    out = F.lit(None).cast("struct<size:int,numbers:array<int>>")
    for _, pattern, alphabet in reversed(ENCODINGS):
        numbers = F.transform(F.split(even, ""), _place_in(alphabet))
        cell = F.struct(F.lit(len(alphabet)).alias("size"), F.filter(numbers, lambda i: i >= 0).alias("numbers"))
        out = F.when(even.rlike(pattern), cell).otherwise(out)
    return out


def _in_range(size: Column, b: int):
    return lambda x: F.floor(x * F.lit(BINS) / size) == b


def _sum(array: Column, value) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + value(x))


def _tests(c: Column) -> Column:
    """What the three tests need, from the numbers of a candidate."""
    numbers, size, n = c["numbers"], c["size"], F.size(c["numbers"]).cast("double")
    middle = (size - 1) / 2.0
    mean = _sum(numbers, lambda x: x) / n
    chi = F.lit(0.0)
    for b in range(BINS):
        width = F.ceil((size * (b + 1)) / F.lit(BINS)) - F.ceil((size * b) / F.lit(BINS))
        expected = n * width / size
        seen = F.size(F.filter(numbers, _in_range(size, b)))
        chi = chi + (seen - expected) * (seen - expected) / expected
    steps = F.sequence(F.lit(0), F.size(numbers) - 2)
    high = F.size(F.filter(numbers, lambda x: x > middle)).cast("double")
    changes = F.size(F.filter(steps, lambda i: (F.get(numbers, i) > middle) != (F.get(numbers, i + 1) > middle)))
    return F.struct(
        n.alias("n"),
        chi.alias("chi"),
        high.alias("high"),
        (changes + 1).cast("double").alias("runs"),
        _sum(numbers, lambda x: (x - mean) * (x - mean)).alias("around"),
        mean.alias("mean"),
        numbers.alias("numbers"),
    )


def _p(t: Column) -> Column:
    """The candidate's p-value from the sums of its tests."""
    n, df = t["n"], float(BINS - 1)
    chi = (F.pow(t["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    chi_p = 1 - _normal_below(F.greatest(F.least(chi, F.lit(12.0)), F.lit(-12.0)))
    both = 2 * t["high"] * (n - t["high"])
    spread = both * (both - n) / (n * n * (n - 1))
    runs_p = F.when(spread > 0, _two_sided((t["runs"] - both / n - 1) / F.sqrt(spread))).otherwise(0.0)
    steps = F.sequence(F.lit(0), F.size(t["numbers"]) - 2)
    lagged = _sum(steps, lambda i: (F.get(t["numbers"], i) - t["mean"]) * (F.get(t["numbers"], i + 1) - t["mean"]))
    serial_p = F.when(t["around"] > 0, _two_sided((lagged / t["around"] + 1 / n) * F.sqrt(n))).otherwise(0.0)
    return F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p))


def candidates(text: Column) -> list[tuple[str, Column]]:
    """The steps that turn a text into its candidates with p-values, as columns to be added one after another."""
    mixed = F.filter(
        spans_of(text, CANDIDATE), lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]")
    )
    numbers = F.transform("_s_found", lambda s: F.struct(s["start"], s["end"], _numbers(s["match"]).alias("c")))
    able = F.filter("_s_numbers", lambda s: s["c"].isNotNull() & (F.size(s["c"]["numbers"]) >= 16))
    tested = F.transform("_s_able", lambda s: F.struct(s["start"], s["end"], _tests(s["c"]).alias("t")))
    valued = F.transform(
        "_s_tested", lambda s: F.struct(s["start"], s["end"], s["t"]["n"].alias("n"), _p(s["t"]).alias("p"))
    )
    return [("_s_found", mixed), ("_s_numbers", numbers), ("_s_able", able), ("_s_tested", tested), ("_s_valued", valued)]


def length_class(n: Column) -> Column:
    return F.floor(F.log2(n) * CLASSES).cast("int")


def thresholds(rows: DataFrame) -> dict[int, float]:
    """The least p that is enough, for every length class; a few rows of counts reach the driver."""
    each = rows.select(F.explode("_s_valued").alias("c")).select(length_class(F.col("c.n")).alias("size"), "c.p")
    counts = each.groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum((F.col("p") > level).cast("int")).alias(f"above_{i}") for i, level in enumerate(LEVELS)]
    )
    out = {}
    for row in counts.collect():
        random = min(row["n"], row[f"above_{len(LEVELS) - 1}"] / (1 - LEVELS[-1] / 3) ** 3)
        out[row["size"]] = NEVER
        for i, level in enumerate(LEVELS):
            above = row[f"above_{i}"]
            if above and max(0.0, above - random * (1 - level / 3) ** 3) <= FALSE_SHARE * above:
                out[row["size"]] = level
                break
    return out


def _of_kind(kind: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def count_of(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scanned(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``base`` and ``secrets``: spans (kind, start, end) of the patterns, and of patterns and tests.

    ``keep_text=False`` drops the text, so that what is written between the pass over the texts and the thresholds
    stays small.
    """
    rows = without(docs, ["base", "secrets"]).withColumn("_s_text", F.coalesce(F.col(text), F.lit("")))
    body = F.col("_s_text")
    rows = rows.withColumn(
        "_s_assign",
        F.filter(spans_of(body, ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST),
    )
    rows = rows.withColumn("_s_access", spans_of(body, ACCESS)).withColumn("_s_hex", spans_of(body, HEX))
    for name, column in candidates(body):
        rows = rows.withColumn(name, column)
    base = F.concat(
        *[F.transform(name, _of_kind(k)) for k, name in enumerate(["_s_assign", "_s_access", "_s_hex"])]
    )
    names = [c for c in without(docs, ["base", "secrets"]).columns if keep_text or c != text]
    rows = rows.select(*[F.col(f"`{c}`") for c in names], base.alias("_s_base"), "_s_valued")
    rows = cut_lineage(rows, "secret-candidates")
    limits = thresholds(rows)
    limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))]) if limits else None
    accepted = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if limit is not None:
        accepted = F.transform(
            F.filter("_s_valued", lambda c: c["p"] > F.element_at(limit, length_class(c["n"]))),
            _of_kind(3),
        )
    return rows.select(
        *[F.col(f"`{c}`") for c in names],
        named(F.sort_array("_s_base")).alias("base"),
        named(F.sort_array(F.concat("_s_base", accepted))).alias("secrets"),
    )


def named(spans: Column) -> Column:
    """Spans in order, their kinds by name."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(
        spans, lambda s: F.struct(F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def as_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    cells = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(cells, ",")
