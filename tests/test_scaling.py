"""What large tables must not do: shuffle rows that no rank falls into, run joins again to find ranges, carry rows that are dropped later."""

import glob
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import medians, percentiles
from parcelwise.operators import geo, order_table, splits
from parcelwise.plans import stored
from parcelwise.sources.tables import RAW_TABLES, read_raw, write_table


@pytest.fixture
def no_small_sides(spark):
    """No side of a join counts as small by its size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_without_groups_shuffle_no_row_outside_their_buckets(spark, no_small_sides):
    rng = random.Random(5)
    xs = [rng.uniform(-50, 50) for _ in range(2001)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    found = percentiles(df, "x", {"q": 0.25, "m": 0.5})
    assert "SortMergeJoin" not in physical(found)
    assert tuple(found.first()) == pytest.approx(tuple(np.percentile(xs, [25, 50])), rel=1e-12)
    grouped = medians(df.withColumn("g", F.lit("a")), {"x": "m"}, ["g"], few=True)
    assert "SortMergeJoin" not in physical(grouped)
    assert grouped.first()["m"] == pytest.approx(np.median(xs), rel=1e-12)


def test_time_cuts_with_many_orders_of_one_moment(spark, no_small_sides):
    rows = [(i, 0 if i < 900 else i) for i in range(1000)]
    df = spark.createDataFrame(rows, "order_id long, s long")
    df = df.select("order_id", F.timestamp_seconds("s").alias("order_purchase_timestamp"))
    sizes = {r["split"]: r["count"] for r in splits.time_split(df).groupBy("split").count().collect()}
    assert sizes == {"train": 700, "val": 150, "test": 150}


def test_weighted_medians_are_those_of_repeated_rows(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.choice([1.5, 2.5, None, 9.0]), rng.uniform(-9, 9), rng.randint(1, 5)) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, x double, y double, n int")
    names = {"x": "mx", "y": "my"}
    repeated = df.select("*", F.explode(F.sequence(F.lit(1), "n")))
    got, want = medians(df, names, ["g"], weight="n").collect(), medians(repeated, names, ["g"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_coordinates_come_from_places_counted_once(spark, monkeypatch):
    # The same zip with and without zeros, repeated points, a stray one, points without coordinates, no zip.
    points = [("7", -10.0, -50.0)] * 3 + [("00007", -10.2, -50.2)] * 2 + [("7", 30.0, -50.0), ("7", None, None)]
    points += [("8", -5.0, -40.0), ("8", -5.1, -40.0), ("8", -5.0, -40.0), (None, -1.0, -45.0), (None, -1.0, -45.0)]
    table = spark.createDataFrame([(*p, " c", "SP") for p in points], f"{geo.ZIP} string, {geo.LAT} double, {geo.LNG} double, {geo.CITY} string, {geo.STATE} string")
    written, cut = {}, geo.cut_lineage
    monkeypatch.setattr(geo, "cut_lineage", lambda df, name: written.setdefault(name, cut(df, name)) if name == "zip-places" else cut(df, name))
    got = geo.zip_coordinates(table)
    assert written["zip-places"].count() == 7
    want = geo.zip_medians(geo.clean_points(table), geo.LAT, geo.LNG)
    rows = lambda df: sorted(map(repr, df.select(geo.ZIP, geo.LAT, geo.LNG).collect()))
    assert rows(got) == rows(want)
    assert {r[geo.ZIP]: r[geo.LAT] for r in got.collect()} == {"00007": -10.0, "00008": -5.0, None: -1.0}


def test_the_order_table_is_made_once_and_stored_in_order(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    once = F.udf(seen, "long").asNondeterministic()
    rows = spark.range(0, 3000, 1, 4).select(
        once("id").alias("order_id"), F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(500))).alias(stored.BY[0])
    )
    monkeypatch.setattr(stored, "prepare", lambda raw: rows)
    monkeypatch.setattr(stored, "raw_tables", lambda *_: {})
    paths = []

    def now(spark, folder, name, write):
        paths.append(stored.new_path(spark, name))
        write(paths[0])
        return paths[0]

    monkeypatch.setattr(stored, "_once", now)
    assert stored.stored_order_table(spark, "").distinct().count() == 3000
    assert made.value == 3000


def test_items_of_other_orders_leave_before_the_lookups(spark):
    items = spark.range(40).select(
        F.col("id").alias("order_id"), F.lit(1).cast("long").alias("order_item_id"), F.col("id").alias("product_id"),
        F.lit(1).cast("long").alias("seller_id"), F.lit(2.0).alias("price"), F.lit(1.0).alias("freight_value"),
    )
    known = spark.range(3).select(
        F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"),
        *[F.timestamp_seconds(F.lit(0)).alias(c) for c in order_table.ORDER_FACTS[2:5]], F.lit(4).cast("long").alias("delivery_days"),
    )
    people = spark.createDataFrame([(1, "1", "c", "SP")], "customer_id long, customer_zip_code_prefix string, customer_city string, customer_state string")
    shops = spark.createDataFrame([(1, "1", "RJ")], "seller_id long, seller_zip_code_prefix string, seller_state string")
    goods = spark.range(40).select(F.col("id").alias("product_id"), F.lit(5.0).alias("product_weight_g"))
    zips = spark.createDataFrame([("00001", -9.0, -49.0)], f"{geo.ZIP} string, {geo.LAT} double, {geo.LNG} double")
    table = order_table.order_table(items, known, people, shops, goods, zips)
    lines = table._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda text: next(i for i, line in enumerate(lines) if text in line)
    assert depth("Join LeftSemi") > depth("Aggregate [order_id")
    assert sorted((r["order_id"], r["total_price"], r["total_weight_g"]) for r in table.collect()) == [(i, 2.0, 5.0) for i in range(3)]


@pytest.mark.parametrize("kind, end", [("gzip", "gz"), ("lz4", "lz4")])
def test_compressed_csv_is_scanned_as_it_was_written(spark, tmp_path, kind, end):
    rows = [(f"{i:012d}", i, "p,\"q\"\n", None, "2020-01-02 03:04:05", i / 4, None) for i in range(50)]
    kinds = ", ".join(f"{c} {'string' if k == 'timestamp' else k}" for c, k in RAW_TABLES["order_items"].items())
    items = spark.createDataFrame(rows, kinds).withColumn("shipping_limit_date", F.col("shipping_limit_date").cast("timestamp"))
    items = items.withColumn("product_id", F.translate("product_id", "\n", " ")).repartition(3)
    write_table(items, f"{tmp_path}/order_items.csv", "csv", compression=kind)
    write_table(items, f"{tmp_path}/plain/order_items.csv", "csv")
    assert len(glob.glob(f"{tmp_path}/order_items.csv/*.csv.{end}")) == 3
    got, plain = (read_raw(spark, f, "order_items").collect() for f in (str(tmp_path), f"{tmp_path}/plain"))
    assert sorted(map(repr, got)) == sorted(map(repr, plain)) and len(got) == 50
    assert sorted(r["price"] for r in got) == [i / 4 for i in range(50)]
