"""Geolocation cleaning: stray points out, one point per zip prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import match, medians
from parcelwise.functions.scalar import haversine_km, holds, pad_zip, strip
from parcelwise.session import cut_lineage

# Fixed values.
BOX_LAT = (-34, 6)
BOX_LNG = (-74, -32)
FAR_KM = 100

ZIP = "geolocation_zip_code_prefix"
LAT = "geolocation_lat"
LNG = "geolocation_lng"
CITY = "geolocation_city"
STATE = "geolocation_state"


def normalize_zip(geo: DataFrame) -> DataFrame:
    return geo.withColumns({ZIP: pad_zip(ZIP), CITY: strip(CITY)})


def outside_box() -> Column:
    lat, lng = F.col(LAT), F.col(LNG)
    return (lat > BOX_LAT[1]) | (lat < BOX_LAT[0]) | (lng > BOX_LNG[1]) | (lng < BOX_LNG[0])


def zip_medians(
    points: DataFrame, lat: str = "zip_median_lat", lng: str = "zip_median_lng", weight: str = "1"
) -> DataFrame:
    """Median latitude and longitude per zip prefix, in one pass over (zip, axis, value).

    One row per zip that several steps join with, so it is written once. ``weight``: how many points a row stands for.
    """
    return cut_lineage(medians(points, {LAT: lat, LNG: lng}, [ZIP], weight, few=True), "zip-medians")


def flag_points(geo: DataFrame) -> DataFrame:
    """Every point with its distance from the median of its zip, an outlier flag and a duplicate flag.

    The median is over all points of the zip, stray ones included. All members of a group of equal
    rows are flagged as duplicates.
    """
    points = normalize_zip(geo)
    columns = points.columns
    measured = match(points, zip_medians(points), [ZIP], "left")
    distance = haversine_km(LAT, LNG, "zip_median_lat", "zip_median_lng")
    repeated = (
        points.groupBy(*columns).count().where("count > 1").select(*columns, F.lit(True).alias("is_duplicate_row"))
    )
    flagged = (
        measured.withColumn("dist_from_zip_median_km", distance)
        .withColumn(
            "is_coord_outlier", holds(outside_box()) | holds(F.col("dist_from_zip_median_km") > FAR_KM)
        )
        .drop("zip_median_lat", "zip_median_lng")
    )
    return match(flagged, repeated, columns, "left").withColumn("is_duplicate_row", holds(F.col("is_duplicate_row")))


def clean_points(geo: DataFrame) -> DataFrame:
    """Points inside the box and near the median of their zip; points without coordinates stay."""
    return _without_strays(normalize_zip(geo))


def _without_strays(points: DataFrame, weight: str = "1") -> DataFrame:
    distance = haversine_km(LAT, LNG, "zip_median_lat", "zip_median_lng")
    return (
        match(points, zip_medians(points, weight=weight), [ZIP], "left")
        .where(~holds(outside_box()) & ~holds(distance > FAR_KM))
        .select(*points.columns)
    )


def most_common(points: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Most common value of each column per key; of equally common ones the smallest."""
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("text")) for c in columns])
    counts = points.select(key, F.inline(pairs)).groupBy(key, "kind", "text").agg(F.count("*").alias("n"))
    place = F.struct(F.col("text").isNull(), -F.col("n"), F.col("text"))
    top = counts.groupBy(key, "kind").agg(F.min_by("text", place).alias("top"))
    return top.groupBy(key).agg(*[F.max(F.when(F.col("kind") == c, F.col("top"))).alias(c) for c in columns])


def zip_points(points: DataFrame) -> DataFrame:
    """One row per zip prefix: median point, most common city and state."""
    names = most_common(points, ZIP, [CITY, STATE])
    zips = match(names, zip_medians(points, LAT, LNG), [ZIP], "left").select(ZIP, LAT, LNG, CITY, STATE)
    return cut_lineage(zips, "zips")


def zip_coordinates(geo: DataFrame) -> DataFrame:
    """Raw points to one coordinate per zip prefix, which is all the order table needs.

    The medians before and after cleaning read the points six times, so these are counted by place and written once.
    """
    counted = geo.groupBy(ZIP, LAT, LNG).agg(F.count("*").alias("n_points")).withColumn(ZIP, pad_zip(ZIP))
    kept = _without_strays(cut_lineage(counted, "zip-places"), "n_points")
    return zip_medians(kept, LAT, LNG, "n_points")
