"""Scans and sinks."""

from datetime import datetime

from parcelwise.sources.tables import (
    ORDER_COLUMNS,
    RAW_TABLES,
    read_order_table,
    read_raw,
    read_raw_parquet,
    register,
    write_table,
)


def test_csv_with_byte_order_mark_and_other_column_order(spark, tmp_path):
    text = "﻿product_category_name_english,product_category_name\nhealth,beleza_saúde\n"
    (tmp_path / "raw_category_translation.csv").write_text(text, encoding="utf-8")
    df = read_raw(spark, str(tmp_path), "category_translation", pattern="raw_{name}.csv")
    assert df.columns == list(RAW_TABLES["category_translation"])
    assert df.first().asDict() == {
        "product_category_name": "beleza_saúde", "product_category_name_english": "health",
    }


def test_types_are_fixed(spark, tmp_path):
    (tmp_path / "order_items.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "007,1,p,s,2018-05-01 10:00:00,12.5,NaN\n007,x,p,s,,oops,\n"
    )
    first, second = read_raw(spark, str(tmp_path), "order_items").collect()
    assert first["order_id"] == "007" and first["shipping_limit_date"] == datetime(2018, 5, 1, 10)
    assert first["price"] == 12.5 and first["freight_value"] is None  # NaN means missing
    assert second["order_item_id"] is None and second["price"] is None and second["freight_value"] is None


def test_zip_stays_text_and_scan_is_pruned(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc,u,01234,rio,RJ\n"
    )
    assert read_raw(spark, str(tmp_path), "customers").first()["customer_zip_code_prefix"] == "01234"
    pruned = read_raw(spark, str(tmp_path), "customers", columns=["customer_id", "customer_unique_id"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string,customer_unique_id:string>" in plan


def test_review_texts_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"two\nlines, ""quoted""",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
        "r2,o2,1,,2018-01-01 00:00:00,2018-01-02 00:00:00\n"
    )
    df = read_raw(spark, str(tmp_path), "order_reviews")
    assert [(r["review_id"], r["review_score"]) for r in df.orderBy("review_id").collect()] == [("r1", 5), ("r2", 1)]


def test_written_tables_come_back(spark, tmp_path):
    df = spark.createDataFrame([("s2", "1", "SP"), ("s1", None, "RJ")], "seller_id string, seller_zip_code_prefix string, seller_state string")
    for _ in range(2):  # overwrites
        write_table(df, str(tmp_path / "sellers"), sort_by=["seller_id"])
    assert [r["seller_id"] for r in read_raw_parquet(spark, str(tmp_path), "sellers").collect()] == ["s1", "s2"]
    register({"sellers": df})
    assert spark.sql("SELECT count(*) AS n FROM sellers WHERE seller_state = 'SP'").first()["n"] == 1


def test_order_table_as_csv(spark, tmp_path):
    kinds = {"string": "'x'", "double": "1.5D", "bigint": "7L", "int": "1", "timestamp": "TIMESTAMP'2018-05-01 10:00:00'"}
    df = spark.sql("SELECT " + ", ".join(f"{kinds[k]} AS {c}" for c, k in ORDER_COLUMNS.items()))
    path = str(tmp_path / "orders")
    write_table(df, path, fmt="csv")
    assert read_order_table(spark, path).collect() == df.collect()
    assert read_order_table(spark, path, as_text=True).first()["n_items"] == "7"


def test_partitioned_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x bigint, part string")
    write_table(df, str(tmp_path / "t"), partition_by=["part"])
    plan = spark.read.parquet(str(tmp_path / "t")).where("part = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_cells_and_lines_that_cannot_be_read_are_kept(spark, tmp_path):
    from parcelwise.sources.tables import BAD_LINE, RESCUED, read_order_lines, rescued_cells

    lines = ["﻿order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"]
    lines += ["a,1,p,s,2018-01-01 10:00:00,1.5,0.5", "b,1.5,p,s,soon,,NaN", "c,2,p", "d,3,p,s,2018-01-01,9,1,extra", "e, ,p,s,,x y,1"]
    (tmp_path / "order_items.csv").write_text("\n".join(lines), encoding="utf-8")
    read = read_raw(spark, str(tmp_path), "order_items", rescue=True)
    got = {r["order_id"]: r for r in read.collect()}
    assert {k: r[RESCUED] for k, r in got.items()} == {
        "a": None, "b": {"order_item_id": "1.5", "shipping_limit_date": "soon"}, "c": None, "d": None, "e": {"price": "x y"},
    }
    assert {k for k, r in got.items() if r[BAD_LINE] is not None} == {"c", "d"} and got["c"][BAD_LINE] == "c,2,p"
    assert (got["b"]["freight_value"], got["d"]["price"], got["c"]["price"]) == (None, 9.0, None)
    counts = {r["column"]: (r["n"], r["first"]) for r in rescued_cells(read).collect()}
    assert counts == {
        "order_item_id": (1, "1.5"), "shipping_limit_date": (1, "soon"), "price": (1, "x y"), BAD_LINE: (2, "c,2,p"),
    }
    # The plain scan gives the same typed columns.
    plain = read_raw(spark, str(tmp_path), "order_items")
    assert sorted(map(str, plain.collect())) == sorted(map(str, read.drop(RESCUED, BAD_LINE).collect()))
    (tmp_path / "o.json").write_text('{"x": 1}\n{"x": \n{"x": "b"}')
    rows = read_order_lines(spark, str(tmp_path / "o.json"), ["x"]).collect()
    assert [(r["x"], r[BAD_LINE]) for r in rows] == [("1", None), (None, '{"x": '), ("b", None)]
