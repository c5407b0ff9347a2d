"""Cleaning and the order table on hand-made rows."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import geo, integrity, lookups, order_table, orders
from parcelwise.sources.tables import ORDER_COLUMNS, RAW_TABLES

DAY = timedelta(days=1)
T0 = datetime(2018, 5, 1, 10)


def cosine_km(lat1, lng1, lat2, lng2):
    """Distance by the spherical law of cosines, another formula than the one under test."""
    a, b, turn = math.radians(lat1), math.radians(lat2), math.radians(lng2 - lng1)
    return 6371 * math.acos(math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(turn))


def frame(spark, name, rows):
    schema = ", ".join(f"{c} {k}" for c, k in RAW_TABLES[name].items())
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def raw(spark):
    head = lambda o, c, status, carrier, received: (
        o, c, status, T0, T0, carrier and T0 + carrier, received and T0 + received, T0 + 20 * DAY,
    )
    heads = [
        head("ok", "c1", "delivered", DAY, 10.5 * DAY),
        head("no_review", "c1", "delivered", DAY, 5 * DAY),
        head("no_date", "c1", "delivered", DAY, None),
        head("early_carrier", "c2", "delivered", -DAY, 4 * DAY),
        head("late_carrier", "c2", "delivered", 6 * DAY, 4 * DAY),
        head("canceled", "c2", "canceled", DAY, 4 * DAY),
        head("no_points", "c3", "delivered", None, 25 * DAY),
    ]
    item = lambda o, n, p, s, limit, price, freight: (o, n, p, s, limit and T0 + limit, price, freight)
    items = [
        item("ok", 1, "p1", "near", 60.9 * DAY, 10.0, 1.0),
        item("ok", 2, "p1", "far", 61 * DAY, 20.0, 2.0),
        item("ok", 3, "p2", "far", 3 * DAY, 30.0, None),
        item("early_carrier", 1, "p1", "no_zip", 2 * DAY, 5.0, 1.0),
        item("late_carrier", 1, "p3", "near", None, 7.0, 0.0),
        item("no_points", 1, "p1", "no_zip", 2 * DAY, 8.0, 1.0),
        item("no_points", 2, "p1", "near", 2 * DAY, 9.0, 1.0),
        item("unknown_order", 1, "p1", "near", 900 * DAY, 1.0, 1.0),
    ]
    payments = [
        ("ok", 1, "voucher", 0, 31.0),
        ("ok", 2, "credit_card", 3, 31.0),
        ("early_carrier", 1, "boleto", 1, 6.0),
        ("early_carrier", 2, "credit_card", 8, 9.0),
    ]
    reviews = [(f"r{i}", o, s, T0, T0) for i, (o, s) in enumerate(
        [("ok", 5), ("ok", 4), ("no_date", 1), ("early_carrier", 3), ("late_carrier", 2), ("canceled", 1), ("no_points", 1)]
    )]
    points = [
        ("1000", -10.0, -50.0, "a", "SP"),
        ("1000", -10.2, -50.2, "b", "SP"),
        ("1000", -10.1, -50.1, "b\t", "RJ"),
        ("1000", -10.1, -50.1, " a", "RJ"),
        ("1000", 40.0, -50.1, "c", "SP"),  # outside the box
        ("1000", -14.0, -50.1, "c", "SP"),  # far from the median
        ("1000", None, None, "c", "SP"),  # kept
        ("2000", -20.0, -40.0, "d", "MG"),
        ("123456", -1.0, -60.0, "e", "AM"),
    ]
    return {
        "orders": frame(spark, "orders", heads),
        "order_items": frame(spark, "order_items", items),
        "order_payments": frame(spark, "order_payments", payments),
        "order_reviews": frame(spark, "order_reviews", reviews),
        "customers": frame(spark, "customers", [
            ("c1", "u1", "1000", "x", "SP"), ("c2", "u1", "2000", "y", "MG"), ("c3", "u2", "9", "z", "SP"),
        ]),
        "sellers": frame(spark, "sellers", [("near", "1000", "SP"), ("far", "2000", "MG"), ("no_zip", "77", "AC")]),
        "geolocation": frame(spark, "geolocation", points),
        "products": frame(spark, "products", [
            ("p1", "toys", 3, 4, 1, 100.0, 1.0, 1.0, 1.0),
            ("p2", None, None, None, None, 300.0, 3.0, 3.0, 3.0),
            ("p3", "art", 3, 4, 1, None, None, None, None),
        ]),
    }


def cleaned(raw):
    names = ("orders", "order_items", "order_payments", "order_reviews", "customers")
    return {r["order_id"]: r for r in orders.clean_orders(*[raw[n] for n in names]).collect()}


def test_clean_orders_keeps_delivered_and_reviewed(raw):
    assert set(cleaned(raw)) == {"ok", "early_carrier", "late_carrier", "no_points"}


def test_clean_orders_values(raw):
    rows = cleaned(raw)
    ok = rows["ok"]
    assert (ok["delivery_days"], ok["late_days"], ok["is_late"]) == (10, -10, 0)
    assert (ok["review_score"], ok["n_reviews"]) == (4.5, 2)
    assert (ok["n_items"], ok["n_products"], ok["n_sellers"]) == (3, 2, 2)
    assert (ok["total_price"], ok["total_freight"], ok["freight_ratio"]) == (60.0, 3.0, 3 / 63)
    # 60.9 days are 60 whole days, which is allowed; 61 are not
    assert ok["shipping_limit_date"] == T0 + 60.9 * DAY
    assert ok["order_delivered_carrier_date"] == T0 + DAY
    assert rows["early_carrier"]["order_delivered_carrier_date"] is None
    assert rows["late_carrier"]["order_delivered_carrier_date"] is None
    assert (rows["no_points"]["late_days"], rows["no_points"]["is_late"]) == (5, 1)


def test_payments(raw):
    rows = cleaned(raw)
    ok = rows["ok"]
    assert (ok["total_payment"], ok["n_payments"], ok["max_installments"], ok["used_voucher"]) == (62.0, 2, 3, 1)
    assert ok["main_payment_type"] == "voucher"  # equal amounts: the first one
    assert rows["early_carrier"]["main_payment_type"] == "credit_card"
    assert rows["late_carrier"]["total_payment"] is None


def test_items_without_order_keep_their_limit(raw):
    rows = {r["order_id"]: r for r in orders.items_per_order(raw["order_items"], raw["orders"]).collect()}
    assert rows["unknown_order"]["shipping_limit_date"] == T0 + 900 * DAY


def test_points(raw):
    kept = geo.clean_points(raw["geolocation"]).collect()
    assert len(kept) == 7
    assert sum(r[geo.LAT] is None for r in kept) == 1
    zips = {r[geo.ZIP]: r for r in geo.zip_points(geo.clean_points(raw["geolocation"])).collect()}
    assert set(zips) == {"01000", "02000", "123456"}
    first = zips["01000"]
    assert (first[geo.LAT], first[geo.LNG]) == pytest.approx((-10.1, -50.1))
    assert first[geo.CITY] == "a"  # a and b tie after stripping
    assert first[geo.STATE] == "SP"


def test_point_flags(raw):
    flagged = geo.flag_points(raw["geolocation"].union(raw["geolocation"].where("geolocation_city = 'd'")))
    rows = flagged.collect()
    assert len(rows) == 10
    assert sorted(r[geo.LAT] for r in rows if r["is_coord_outlier"]) == [-14.0, 40.0]
    assert [r[geo.CITY] for r in rows if r["is_duplicate_row"]] == ["d", "d"]


def test_products(raw):
    rows = {r["product_id"]: r for r in lookups.clean_products(raw["products"]).collect()}
    assert rows["p3"]["product_weight_g"] == 200.0 and rows["p3"]["product_height_cm"] == 2.0
    assert rows["p2"]["product_category_name"] == "unknown" and rows["p2"]["product_name_length"] == 0
    assert integrity.count_nulls(lookups.clean_products(raw["products"])).first()["n"] == 0


def items_of(raw):
    return order_table.item_rows(
        raw["order_items"],
        orders.delivered_orders(raw["orders"], raw["order_reviews"]),
        raw["customers"],
        raw["sellers"],
        raw["products"],
        geo.zip_coordinates(raw["geolocation"]),
    )


def test_order_table(raw):
    table = order_table.prepare(raw)
    assert table.columns == list(ORDER_COLUMNS)
    rows = {r["order_id"]: r for r in table.collect()}
    assert set(rows) == {"ok", "early_carrier", "late_carrier", "no_points"}
    ok = rows["ok"]
    # the far seller stands for the order, with all its columns
    assert (ok["seller_state"], ok["seller_lat"], ok["seller_lng"], ok["same_state"]) == ("MG", -20.0, -40.0, 0)
    assert ok["distance_km"] == pytest.approx(cosine_km(-10.1, -50.1, -20.0, -40.0))
    assert (ok["n_sellers"], ok["n_items"], ok["total_price"], ok["total_freight"]) == (2, 3, 60.0, 3.0)
    assert ok["total_weight_g"] == 500.0
    assert (ok["delivery_days"], ok["estimated_delivery_days"]) == (10, 20)
    assert rows["late_carrier"]["total_weight_g"] == 200.0  # median of the known weights
    assert rows["early_carrier"]["distance_km"] is None
    assert rows["no_points"]["distance_km"] is None and rows["no_points"]["n_sellers"] == 2


def test_both_ways_to_the_order_table_agree(raw):
    through_items = order_table.order_table_from_items(items_of(raw)).orderBy("order_id").collect()
    assert through_items == order_table.prepare(raw).orderBy("order_id").collect()


def test_same_rows_at_any_partitioning(raw):
    many = {n: df.repartition(7) for n, df in raw.items()}
    one = {n: df.coalesce(1) for n, df in raw.items()}
    assert order_table.prepare(many).orderBy("order_id").collect() == order_table.prepare(one).orderBy("order_id").collect()


def test_gaps_and_integrity(raw):
    gaps = integrity.data_gaps(items_of(raw)).first()
    assert gaps.asDict() == {
        "n_orders": 4, "missing_customer_point": 1, "missing_seller_point": 2, "several_sellers": 2,
    }
    assert integrity.unmatched(raw["customers"], raw["orders"], "customer_id").first()["n"] == 0
    doubled = raw["customers"].union(raw["customers"].limit(1))
    assert integrity.count_repeated_keys(doubled, "customer_id").first()["n"] == 1
    assert integrity.base_row_change(raw["customers"], doubled).first()["n"] == 1
    assert integrity.lost_keys(raw["customers"], raw["customers"].where("customer_id <> 'c1'"), "customer_id").first()["n"] == 1


def test_customers_keep_their_rows(raw):
    zips = geo.zip_points(geo.clean_points(raw["geolocation"]))
    kept = orders.delivered_orders(raw["orders"], raw["order_reviews"]).where("order_id <> 'late_carrier'")
    joined = lookups.customers_with_orders(raw["customers"], kept, zips)
    rows = {r["customer_id"]: r for r in joined.collect()}
    assert set(rows) == {"c1", "c2", "c3"} and joined.count() == 3
    assert rows["c3"][geo.LAT] is None and rows["c1"][geo.CITY] == "a"


def test_a_hot_order_is_split(spark, raw):
    """A third of all items in one order: the totals are right and nothing is dropped."""
    extra = spark.range(20_000).select(
        F.lit("ok").alias("order_id"), (F.col("id") + 10).alias("order_item_id"), F.lit("p1").alias("product_id"),
        F.when(F.col("id") % 2 == 0, "near").otherwise("far").alias("seller_id"),
        F.lit(T0).alias("shipping_limit_date"), F.lit(1.0).alias("price"), F.lit(0.5).alias("freight_value"),
    )
    hot = {**raw, "order_items": raw["order_items"].unionByName(extra)}
    row = order_table.prepare(hot).where("order_id = 'ok'").first()
    assert (row["n_items"], row["total_price"], row["n_sellers"]) == (20_003, 20_060.0, 2)
    assert row["seller_state"] == "MG"
