import math

import pytest
from pyspark.sql import functions as F

from parcelwise.functions import scalar as s


def one(spark, column, **values):
    row = ", ".join(f"{v} AS {k}" for k, v in values.items()) or "1 AS x"
    return spark.sql(f"SELECT {row}").select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, out",
    [("'1234'", "01234"), ("'123456'", "123456"), ("'12345'", "12345"), ("NULL", None), ("'7'", "00007")],
)
def test_pad_zip_never_cuts(spark, text, out):
    assert one(spark, s.pad_zip("z"), z=f"CAST({text} AS STRING)") == out


def test_strip_and_squeeze(spark):
    assert one(spark, s.strip("c"), c=r"'\t rio \n'") == "rio"
    assert one(spark, s.squeeze("c"), c=r"' a \n\t b '") == "a b"
    assert one(spark, s.state_code("c"), c=r"' sp\t'") == "SP"


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2018-01-01 12:00:00", "2018-01-03 11:59:59", 1),
        ("2018-01-03 00:00:00", "2018-01-01 12:00:00", -2),
        ("2018-01-01 00:00:00", "2018-01-01 00:00:00", 0),
        ("1700-01-01 00:00:00", "2200-01-01 00:00:00", 182621),
        ("2200-01-01 00:00:00.000001", "1700-01-01 00:00:00", -182622),
    ],
)
def test_elapsed_days_rounds_down(spark, start, end, days):
    assert one(spark, s.elapsed_days("a", "b"), a=f"TIMESTAMP'{start}'", b=f"TIMESTAMP'{end}'") == days


def test_haversine(spark):
    place = dict(a="-23.5D", b="-46.6D", c="-22.9D", d="-43.2D")
    p1, p2 = math.radians(-23.5), math.radians(-22.9)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(3.4) / 2) ** 2
    assert one(spark, s.haversine_km("a", "b", "c", "d"), **place) == pytest.approx(2 * 6371 * math.asin(math.sqrt(h)))
    assert one(spark, s.haversine_km("a", "b", "c", "d"), **{**place, "c": "CAST(NULL AS DOUBLE)"}) is None
    antipodes = dict(a="0D", b="0D", c="0D", d="180D")
    assert one(spark, s.haversine_km("a", "b", "c", "d"), **antipodes) == pytest.approx(math.pi * 6371)


@pytest.mark.parametrize(
    "late, bin_", [(-21, 0), (-20, 0), (-19, 1), (-10, 1), (-5, 2), (0, 3), (1, 4), (5, 4), (6, 5), (20, 6), (21, 7)]
)
def test_late_bins_are_closed_on_the_right(spark, late, bin_):
    assert one(spark, s.right_closed_bin("x"), x=str(late)) == bin_
    assert one(spark, s.late_bin_label("x"), x=str(late)) == s.LATE_BIN_LABELS[bin_]


def test_small_helpers(spark):
    assert one(spark, s.weekday("t"), t="TIMESTAMP'2018-05-07 10:00:00'") == 0  # a Monday
    assert one(spark, s.freight_ratio("f", "p"), f="0D", p="0D") is None
    assert one(spark, s.freight_ratio("f", "p"), f="5D", p="15D") == 0.25
    assert one(spark, s.item_group("n"), n="7") == "4+"
    assert one(spark, s.item_group("n"), n="3") == "3"
    assert one(spark, s.floor_at_zero("p"), p="-2D") == 0.0
    assert one(spark, s.clip_score("p"), p="7D") == 5.0
    assert one(spark, s.number_or_null("t"), t="'NaN'") is None
    assert one(spark, s.number_or_null("t"), t="'x'") is None
    assert one(spark, F.bround(F.col("x")), x="2.5D") == 2.0
    assert [one(spark, s.request_class("c"), c=c) for c in ("200", "422", "499", "500", "503")] == [
        "ok", "rejected", "rejected", "error", "error",
    ]
    assert one(spark, s.flag(F.col("a") == F.col("b")), a="'SP'", b="CAST(NULL AS STRING)") == 0
    assert one(spark, s.satisfaction("x"), x="4.0D") == "satisfied"
    both = [one(spark, s.parse_timestamp("t"), t=t) for t in ("'2018-05-01 10:00:00'", "'2018-05-01T10:00:00'")]
    assert both[0] == both[1] and both[0] is not None
