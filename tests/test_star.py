"""Dimensions, dense surrogate keys and the fact table on literal orders."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockyard.operators.star import (
    build_dim_date,
    build_dim_product,
    build_dim_region,
    build_dim_supplier,
    with_dense_ids,
)
from stockyard.plans.warehouse import build_star_schema

D = dt.date
COLS = ["order_id", "order_date", "product_name", "supplier_name", "region", "quantity_ordered", "unit_cost",
        "total_cost", "lead_time_days", "actual_delivery_days", "delay_days", "is_delayed", "warehouse_stock"]


def orders(spark):
    rows = []
    # supplier A: 3 of 20 delayed = 0.15 exactly -> High; B: 6 of 20 = 0.30 -> Medium; C: 7 of 20 -> Low
    for sup, delayed in (("A", 3), ("B", 6), ("C", 7)):
        for i in range(20):
            d = 1 if i < delayed else 0
            rows.append((f"{sup}-{i}", D(2022, 1, 1) + dt.timedelta(days=i), ["Laptop", "Phone", "Gizmo"][i % 3], sup,
                         ["North", "Atlantis"][i % 2], 2, 10.0 + i % 2 * 0.01, 20.0, 5, 5 + d, d, d, 100))
    return spark.createDataFrame(rows, COLS)


def test_dim_supplier_bins_on_exact_edges(spark):
    dim = {r.supplier_name: r for r in build_dim_supplier(orders(spark)).collect()}
    assert dim["A"].reliability == "High" and dim["B"].reliability == "Medium" and dim["C"].reliability == "Low"
    assert [dim[k].supplier_id for k in "ABC"] == [1, 2, 3]
    assert all(r.country == "India" for r in dim.values())


def test_dim_product_category_default_and_mean(spark):
    dim = {r.product_name: r for r in build_dim_product(orders(spark)).collect()}
    assert dim["Gizmo"].category == "Other" and dim["Laptop"].category == "Computing"
    assert [dim[k].product_id for k in ("Gizmo", "Laptop", "Phone")] == [1, 2, 3]
    assert dim["Laptop"].unit_cost == 10.0  # mean of 10.00 / 10.01 pattern, 2 dp
    assert dim["Phone"].unit_cost == 10.01


def test_dim_region_zone_has_no_default(spark):
    dim = {r.region_name: r for r in build_dim_region(orders(spark)).collect()}
    assert dim["North"].zone == "North Zone" and dim["Atlantis"].zone is None
    assert dim["Atlantis"].region_id == 1


def test_dim_date_attributes(spark):
    dim = {r.date_id: r for r in build_dim_date(orders(spark)).collect()}
    assert dim[20220101].week == 0 and dim[20220103].week == 1
    assert dim[20220101].day_of_week == "Saturday" and dim[20220101].full_date == D(2022, 1, 1)
    assert len(dim) == 20


def test_dense_ids_across_many_partitions(spark):
    keys = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(13)
    got = with_dense_ids(keys, ["k"], "kid", small_rows=0)  # force the distributed numbering
    expect = keys.withColumn("kid", F.row_number().over(Window.orderBy("k")))
    assert got.count() == 5000
    assert got.exceptAll(expect.select("kid", "k")).count() == 0
    small = with_dense_ids(keys, ["k"], "kid")
    assert small.exceptAll(expect.select("kid", "k")).count() == 0


def test_fact_lookups_and_null_fk(spark):
    o = orders(spark).union(
        spark.createDataFrame([("X-1", D(2022, 2, 1), "Laptop", None, "North", 1, 1.0, 1.0, 1, 1, 0, 0, 1)],
                              orders(spark).schema)
    )
    star = build_star_schema(o)
    fact = {r.order_id: r for r in star.fact_orders.collect()}
    assert fact["X-1"].supplier_id is None and fact["X-1"].date_id == 20220201
    assert fact["A-0"].supplier_id == 1 and fact["A-0"].region_id == 2
    assert len(fact) == 61 and star.fact_orders.columns[:5] == ["order_id", "date_id", "product_id", "supplier_id", "region_id"]
