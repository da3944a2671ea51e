"""Scale paths forced at small size: they must give the same answers."""

import datetime as dt

from pyspark.sql import functions as F

from stockyard.operators.clean import tidy_names
from stockyard.operators.star import build_fact_orders
from stockyard.plans.warehouse import build_star_schema

COLS = ["order_id", "order_date", "product_name", "supplier_name", "region", "quantity_ordered", "unit_cost",
        "total_cost", "lead_time_days", "actual_delivery_days", "delay_days", "is_delayed", "warehouse_stock"]


def orders(spark, n=200):
    rows = [(f"O{i}", dt.date(2022, 1, 1) + dt.timedelta(days=i % 40), f" prod {i % 7} ", f"sup#{i % 13}",
             ["north", "SOUTH", "east"][i % 3], 1 + i % 5, 10.0, 10.0, 5, 5, 0, 0, i % 300) for i in range(n)]
    return spark.createDataFrame(rows, COLS)


def test_names_cleaned_per_row_beyond_the_limit(spark):
    df = orders(spark)
    cols = ["product_name", "supplier_name", "region"]
    looked_up = tidy_names(df, cols)
    spark.conf.set("stockyard.broadcast.maxRows", "1")
    try:
        per_row = tidy_names(df, cols)
        assert "BroadcastHashJoin" not in per_row._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("stockyard.broadcast.maxRows")
    assert sorted(looked_up.collect()) == sorted(per_row.collect())
    assert {r.product_name for r in per_row.collect()} == {f"Prod {i}" for i in range(7)}


def test_fact_lookups_without_broadcast(spark):
    star = build_star_schema(orders(spark))
    small = {r.order_id: r for r in star.fact_orders.collect()}
    spark.conf.set("stockyard.broadcast.maxRows", "2")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = build_fact_orders(star.orders, star.dim_product, star.dim_supplier, star.dim_region,
                                 {"dim_product": 7, "dim_supplier": 13, "dim_region": 3})
        big = {r.order_id: r for r in fact.collect()}
    finally:
        spark.conf.unset("stockyard.broadcast.maxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert small == big and len(big) == 200
    assert all(r.product_id is not None and r.supplier_id is not None for r in big.values())


def test_hot_key_join_equals_plain_join(spark):
    from stockyard.plans.joins import hot_key_join

    left = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id"),
    )
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    dim = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") * 2).alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("HOT", -7)], "k string, v long"))
    for how in ("left", "inner"):
        got = hot_key_join(left, dim, "k", how)
        assert sorted(got.collect(), key=repr) == sorted(left.join(dim, "k", how).collect(), key=repr)
    plan = hot_key_join(left, dim, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Union" in plan


def test_lookup_join_uses_hot_key_split_without_aqe_skew_handling(spark):
    left = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id"))
    dim = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    from stockyard.plans.joins import lookup_join

    spark.conf.set("stockyard.broadcast.maxRows", "1")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        out = lookup_join(left, dim, "k", "left", dim_rows=5)
        assert "Union" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 3000
    finally:
        spark.conf.unset("stockyard.broadcast.maxRows")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
