"""The contract on golden records, on both edges of each range, and on planted faults."""

import json

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import contract
from parcelwise.operators.contract import CONTRACT_COLUMNS, ContractError, check, require_valid, route
from parcelwise.sources.tables import read_order_json

GOOD = {
    "customer_state": "SP", "seller_state": "SP", "customer_lat": -23.5, "customer_lng": -46.6,
    "seller_lat": -23.6, "seller_lng": -46.7, "n_sellers": 1, "n_items": 2, "total_price": 100.0,
    "total_freight": 15.0, "total_weight_g": 800.0, "estimated_delivery_days": 10,
    "order_purchase_timestamp": "2018-05-01 10:00:00",
}


def records(spark, rows):
    schema = ", ".join(f"{c} string" for c in CONTRACT_COLUMNS)
    return spark.createDataFrame(
        [tuple(None if r.get(c) is None else str(r[c]) for c in CONTRACT_COLUMNS) for r in rows], schema
    )


def rules(spark, **values):
    """The rules that a record with these values breaks."""
    return [(v["column"], v["rule"]) for v in check(records(spark, [order(**values)])).first()["violations"]]


def order(lacks=(), **values):
    """A record as it is sent: a good one with other values, and without some fields."""
    record = dict(GOOD)
    record.update(values)
    return {name: record[name] for name in record if name not in lacks}


# The rule that each kind of bad record breaks, and in which column.
BAD_RECORDS = [
    ("no latitude", order(lacks=["customer_lat"]), "customer_lat", "required"),
    ("null latitude", order(customer_lat=None), "customer_lat", "required"),
    ("weight below zero", order(total_weight_g=-5.0), "total_weight_g", "range"),
    ("outside the box", order(customer_lat=40.0), "customer_lat", "range"),
    ("no such state", order(customer_state="XX"), "customer_state", "membership"),
    ("text for a number", order(n_items="abc"), "n_items", "coercion"),
]


def checked_json(spark, folder, record):
    (folder / "order.json").write_text(json.dumps(record, indent=1))
    return route(check(read_order_json(spark, str(folder / "order.json"), CONTRACT_COLUMNS)))


def test_a_good_record_is_accepted(spark, tmp_path):
    accepted, rejected = checked_json(spark, tmp_path, order())
    assert (accepted.count(), rejected.count()) == (1, 0)


@pytest.mark.parametrize("name, record, column, rule", BAD_RECORDS, ids=[r[0] for r in BAD_RECORDS])
def test_a_bad_record_is_turned_away(spark, tmp_path, name, record, column, rule):
    accepted, rejected = checked_json(spark, tmp_path, record)
    assert accepted.count() == 0
    assert [(v["column"], v["rule"]) for r in rejected.collect() for v in r["violations"]] == [(column, rule)]


EDGES = [
    ("customer_lat", [-34, 6], [-34.001, 6.001]),
    ("seller_lat", [-34, 6], [-34.001, 6.001]),
    ("customer_lng", [-74, -34], [-74.001, -33.999]),
    ("seller_lng", [-74, -34], [-74.001, -33.999]),
    ("n_sellers", [1, 20], [0, 21]),
    ("n_items", [1, 100, "12", " 12 "], [0, 101]),
    ("total_price", [0.01], [0, -1]),
    ("total_freight", [0], [-0.01]),
    ("total_weight_g", [0, 500_000], [-0.01, 500_000.1]),
    ("estimated_delivery_days", [0, 200], [-1, 201]),
]


@pytest.mark.parametrize("column, good, bad", EDGES)
def test_both_edges(spark, column, good, bad):
    rows = [{**GOOD, column: v} for v in [*good, *bad]]
    found = [len(r["violations"]) for r in check(records(spark, rows)).select("violations").collect()]
    assert found == [0] * len(good) + [1] * len(bad)


def test_coercion(spark):
    assert rules(spark, n_items="12.5") == [("n_items", "coercion")]
    assert rules(spark, total_price="NaN") == [("total_price", "required")]
    assert rules(spark, order_purchase_timestamp="2018-05-01T10:00:00") == []
    assert rules(spark, order_purchase_timestamp="not-a-date") == [("order_purchase_timestamp", "coercion")]
    typed = spark.createDataFrame([(2.0,), (2.5,)], "n_items double")
    got = check(typed, [f for f in contract.CONTRACT if f.name == "n_items"]).collect()
    assert [(r["n_items"], len(r["violations"])) for r in got] == [(2, 0), (None, 1)]


def test_all_failures_are_listed(spark):
    found = rules(spark, customer_state="XX", total_price=None, n_items="abc", seller_lat=9)
    assert found == [
        ("customer_state", "membership"), ("seller_lat", "range"), ("n_items", "coercion"), ("total_price", "required"),
    ]


def test_form_input_and_extra_columns(spark):
    typed = records(spark, [{**GOOD, "customer_state": " sp\t"}]).withColumn("delivery_days", F.lit(3))
    assert check(typed, form_input=True).where(contract.is_valid()).count() == 1
    assert check(typed).where(contract.is_valid()).count() == 0
    assert contract.contract_only(check(typed)).columns == CONTRACT_COLUMNS


def test_missing_column_breaks_every_row(spark):
    assert check(records(spark, [GOOD, GOOD]).drop("n_items")).where(contract.is_valid()).count() == 0


def test_table_verdict_and_stop(spark):
    good = records(spark, [GOOD] * 3)
    unlocated = records(spark, [GOOD, {**GOOD, "customer_lat": None}])
    assert require_valid(good).count() == 3
    assert require_valid(unlocated).count() == 1  # leaves the batch before the contract
    with pytest.raises(ContractError, match="required in 1 rows"):
        require_valid(unlocated, drop_missing_points=False)
    with pytest.raises(ContractError, match="missing columns: n_items"):
        require_valid(good.drop("n_items"))


def test_planted_faults_are_found_exactly(spark):
    rows = records(spark, [GOOD] * 50).coalesce(1).withColumn("no", F.monotonically_increasing_id())
    checked = check(contract.plant_faults(rows, "no"))
    found = {(r["no"], r["column"]) for r in contract.violation_rows(checked, "no").collect()}
    assert found == {
        (3, "order_purchase_timestamp"), (4, "total_weight_g"), (20, "customer_lat"), (30, "n_items"),
        (34, "total_price"), (42, "customer_state"), (47, "seller_state"),
    }
