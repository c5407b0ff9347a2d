"""Scalar column expressions. All of them are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371
ZIP_WIDTH = 5
SATISFIED_FROM = 4.0
LATE_BIN_EDGES = [-20, -10, -5, 0, 5, 10, 20]
LATE_BIN_LABELS = ["< -20", "-20…-10", "-10…-5", "-5…0", "1…5", "6…10", "11…20", "> 20"]

# Every character that counts as whitespace in Unicode text.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

DAY_MICROS = 86_400_000_000


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in km; null as soon as one coordinate is null."""
    lat1, lng1, lat2, lng2 = (F.radians(c) for c in (lat1, lng1, lat2, lng2))
    half = lambda a, b: F.pow(F.sin((b - a) / 2), F.lit(2.0))
    chord = half(lat1, lat2) + F.cos(lat1) * F.cos(lat2) * half(lng1, lng2)
    # Rounding can push the chord of antipodal points past 1; a plain least() would hide nulls.
    chord = F.when(chord > 1, F.lit(1.0)).otherwise(chord)
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def pad_zip(code) -> Column:
    """Left-pad a zip prefix with zeros to five characters; longer codes are kept whole."""
    code = F.col(code) if isinstance(code, str) else code
    code = code.cast("string")
    return F.when(F.length(code) < ZIP_WIDTH, F.lpad(code, ZIP_WIDTH, "0")).otherwise(code)


def strip(text) -> Column:
    """Trim any whitespace, tabs and line ends included."""
    return F.trim(text, F.lit(WHITESPACE))


def squeeze(text) -> Column:
    """Collapse every run of whitespace to one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def state_code(text) -> Column:
    """State code as a web form sends it: trimmed and in capitals."""
    return F.upper(strip(text))


def elapsed_days(start, end) -> Column:
    """Whole 24-hour days from start to end, rounded down (minus 1.5 days gives -2)."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    # Integer arithmetic: exact for any span, no detour through a double.
    return F.floor((micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("bigint")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; a missing answer counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def holds(condition: Column) -> Column:
    """The condition as true or false only, so that it can be negated safely."""
    return F.coalesce(condition, F.lit(False))


def weekday(ts) -> Column:
    """Day of the week, Monday = 0."""
    return F.weekday(ts)


def freight_ratio(freight, price) -> Column:
    """Share of freight in the total; null where the total is zero."""
    freight = F.col(freight) if isinstance(freight, str) else freight
    price = F.col(price) if isinstance(price, str) else price
    return freight / F.nullif(price + freight, F.lit(0.0))


def satisfaction(score, threshold: float = SATISFIED_FROM) -> Column:
    """Label of a (real or predicted) review score."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score >= threshold, "satisfied").otherwise("unsatisfied")


def item_group(n_items) -> Column:
    """Item counts 1, 2, 3 and "4+"."""
    n_items = F.col(n_items) if isinstance(n_items, str) else n_items
    return F.when(n_items >= 4, F.lit("4+")).otherwise(n_items.cast("bigint").cast("string"))


def right_closed_bin(value, edges=LATE_BIN_EDGES) -> Column:
    """0-based bin; bin i holds edges[i-1] < value <= edges[i], the outer bins are open."""
    value = F.col(value) if isinstance(value, str) else value
    out = F.when(value.isNull(), F.lit(None))
    for i, edge in enumerate(edges):
        out = out.when(value <= edge, F.lit(i))
    return out.otherwise(F.lit(len(edges))).cast("int")


def late_bin_label(late_days) -> Column:
    label = F.element_at(F.array(*[F.lit(x) for x in LATE_BIN_LABELS]), right_closed_bin(late_days) + 1)
    return label


def clip_score(value, low: float = 1.0, high: float = 5.0) -> Column:
    """Clip a predicted review score to the scale; null stays null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def floor_at_zero(prediction) -> Column:
    """A delivery time is never negative; null stays null."""
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.when(prediction < 0, F.lit(0.0)).otherwise(prediction)


def number_or_null(text) -> Column:
    """Text as a double, null where it is no finite number."""
    text = F.col(text) if isinstance(text, str) else text
    return nan_to_null(text.try_cast("double"))


def nan_to_null(value) -> Column:
    """NaN means "missing" in the sources, so it becomes null at the edge."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(value), value)


def parse_timestamp(text) -> Column:
    """Text in the blank or the T form to a timestamp; null where it is none."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("timestamp")


def request_class(status) -> Column:
    """Class of a request by its status code."""
    status = F.col(status) if isinstance(status, str) else status
    return (
        F.when(status.between(400, 499), F.lit("rejected"))
        .when(status >= 500, F.lit("error"))
        .otherwise(F.lit("ok"))
    )


def hash_key(*cols, seed: int | str = 42) -> Column:
    """60-bit number from md5(seed|values): a repeatable, engine-independent shuffle order."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def null_out(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Set a column to null where the condition holds; a missing answer changes nothing."""
    return df.withColumn(column, F.when(~holds(condition), F.col(column)))
