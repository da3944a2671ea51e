"""Cleaning: de-duplication order, null handling, types, names; skewed keys."""

import datetime as dt

from pyspark.sql import functions as F

from stockyard.functions.numeric import whole_number
from stockyard.operators.clean import bad_cells, clean_orders, dedupe_first, enrich_orders, sort_orders
from stockyard.schemas import RAW_ORDERS

D = dt.date


def raw_rows():
    # order_id, order_date, product, supplier, region, qty, unit_cost, lead, stock, delay
    return [
        ("ORD-1", D(2022, 1, 5), "  laptop ", "techcorp india", "north", 10, 100.004, 5, 50, 0),
        ("ORD-1", D(2022, 1, 6), "Phone", "Other Co", "South", 99, 1.0, 5, 50, 0),      # later copy: dropped
        ("ORD-2", D(2022, 1, 3), None, "techcorp india", "north", 1, 1.0, 5, 50, 2),    # first copy lacks product
        ("ORD-2", D(2022, 1, 9), "Mouse", "techcorp india", "north", 2, 2.0, 5, 50, 0), # -> whole order lost
        (None, D(2022, 1, 1), "Mouse", "x", "y", 1, 1.0, 1, 1, 0),                      # null id dropped
        ("ORD-3", D(2022, 1, 1), "\tMOUSE\t", None, "EAST", 3, 19.995, 7, 100, 4),
    ]


def raw_df(spark):
    cols = ["order_id", "order_date", "product_name", "supplier_name", "region", "quantity_ordered", "unit_cost",
            "lead_time_days", "warehouse_stock", "delay_days"]
    df = spark.createDataFrame(raw_rows(), cols)
    return enrich_orders(df)


def test_enrich_derives_columns(spark):
    r = raw_df(spark).where("order_id = 'ORD-3'").first()
    assert r.total_cost == 3 * 19.995
    assert r.actual_delivery_days == 11 and r.is_delayed is True
    assert set(RAW_ORDERS.fieldNames()) == set(raw_df(spark).columns)


def test_clean_keeps_first_copy_and_drops_after_dedup(spark):
    out = {r.order_id: r for r in clean_orders(raw_df(spark), first_by=["order_date"]).collect()}
    assert sorted(out) == ["ORD-1", "ORD-3"]
    o1 = out["ORD-1"]
    assert o1.product_name == "Laptop" and o1.supplier_name == "Techcorp India" and o1.region == "North"
    assert o1.quantity_ordered == 10 and o1.unit_cost == 100.0 and o1.total_cost == 1000.0
    assert o1.is_delayed == 0
    o3 = out["ORD-3"]
    assert o3.product_name == "Mouse" and o3.supplier_name is None and o3.region == "East"
    assert o3.unit_cost == 20.0 and o3.total_cost == 60.0 and o3.is_delayed == 1


def test_clean_casts_text_feed(spark):
    rows = [("ORD-9", "2022-03-04 00:00:00", "Camera", "S", "R", "12", "10.5", "3", "7", "1", "True", "4", "126.0"),
            ("ORD-8", "2022-03-05", "Camera", "S", "R", "oops", "1", "3", "7", "0", "False", "3", "0")]
    cols = ["order_id", "order_date", "product_name", "supplier_name", "region", "quantity_ordered", "unit_cost",
            "lead_time_days", "warehouse_stock", "delay_days", "is_delayed", "actual_delivery_days", "total_cost"]
    out = {r.order_id: r for r in clean_orders(spark.createDataFrame(rows, cols), first_by=["order_date"]).collect()}
    assert out["ORD-9"].order_date == D(2022, 3, 4) and out["ORD-9"].quantity_ordered == 12
    assert out["ORD-9"].is_delayed == 1 and out["ORD-9"].total_cost == 126.0
    assert out["ORD-8"].quantity_ordered is None and out["ORD-8"].total_cost is None  # bad cell -> null, and counted:
    faults = {r.column_name: r.bad_cells for r in bad_cells(spark.createDataFrame(rows, cols)).collect()}
    assert faults["quantity_ordered"] == 1 and sum(faults.values()) == 1


def test_whole_numbers_of_cells(spark):
    cells = [("7",), ("7.0",), ("7.9",), (" 8 ",), ("-3.5",), ("oops",), (None,), ("1e3",)]
    got = [r[0] for r in spark.createDataFrame(cells, "c string").select(whole_number(F.col("c"))).collect()]
    assert got == [7, 7, 7, 8, -3, None, None, 1000]
    assert spark.sql("select 7.0D as c").select(whole_number(F.col("c"))).first()[0] == 7


def test_dedupe_hot_key_is_exact(spark):
    # one key holds a third of the rows; the kept row is the minimum by the ordering columns
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("k"),
        ((F.col("id") * 7919) % 10007).alias("o"),
        F.col("id").alias("payload"),
    ).repartition(8)
    out = dedupe_first(df, "k", ["o"])
    assert out.count() == 1 + n - n // 3
    hot = out.where("k = 'HOT'").first()
    expect = df.where("k = 'HOT'").orderBy("o", "payload").first()
    assert (hot.o, hot.payload) == (expect.o, expect.payload)
    assert out.columns == df.columns


def test_dedupe_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([("a", 1, 2)], "k string, o int, p int")
    plan = dedupe_first(df, "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_sort_orders_by_date(spark):
    got = [r.order_id for r in sort_orders(raw_df(spark).where("order_id is not null")).collect()]
    assert got[0] == "ORD-3" and got[-1] == "ORD-2"
