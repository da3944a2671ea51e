"""Physical-plan properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from stockyard.operators.kpis import kpi_sliced
from stockyard.operators.risk import supplier_risk
from stockyard.plans.joins import lookup_join
from stockyard.plans.warehouse import warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_cross_products(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_report_aggregates_before_the_join_and_prunes_columns(spark):
    star = warehouse(spark, SF_SMALL)
    p = plan(supplier_risk(star))
    # partial aggregate of the fact by the foreign key sits below the join
    assert p.index("partial_count") > p.index("BroadcastHashJoin")
    fact_scan = [line for line in p.splitlines() if "FileScan parquet" in line and "order_id" in line][0]
    assert "warehouse_stock" not in fact_scan and "delay_days" not in fact_scan


def test_year_slicer_reaches_the_scan(spark):
    star = warehouse(spark, SF_SMALL)
    p = plan(kpi_sliced(star, years=[1997]))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "order_id" in line][0]
    assert "GreaterThanOrEqual(date_id,19970000)" in scan


def test_broadcast_only_under_the_size_limit(spark):
    left = spark.range(1000).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in plan(lookup_join(left, dim, "k", "inner", dim_rows=10))
        spark.conf.set("stockyard.broadcast.maxRows", "5")
        assert "BroadcastHashJoin" not in plan(lookup_join(left, dim, "k", "inner", dim_rows=10))
        assert "BroadcastHashJoin" not in plan(lookup_join(left, dim, "k", "inner"))  # counted, too big
    finally:
        spark.conf.unset("stockyard.broadcast.maxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dedup_combines_copies_before_the_shuffle(spark):
    from stockyard.operators.clean import dedupe_first
    from stockyard.sources import adapter

    star = warehouse(spark, SF_SMALL)
    p = plan(dedupe_first(star.raw_orders, "order_id", adapter.FIRST_BY))
    # partial aggregate below the exchange: copies of a key collapse in every map task
    assert p.index("partial_min") > p.index("Exchange hashpartitioning(order_id")
    assert "Window" not in p


def test_opt_in_bucketed_dedup_needs_no_shuffle(spark, tmp_dir):
    from stockyard.operators.clean import dedupe_first
    from stockyard.plans.warehouse import _write_bucketed

    df = spark.range(2000).select(
        F.concat(F.lit("O"), (F.col("id") % 500).cast("string")).alias("order_id"),
        (F.col("id") % 500).alias("_k"),
        F.col("id").alias("v"),
    )
    t = _write_bucketed(df, tmp_dir + "/raw", "_k", 8)
    p = plan(dedupe_first(t, "order_id", ["v"], colocate_by=["_k"]))
    assert "Bucketed: true" in p and "Exchange" not in p
