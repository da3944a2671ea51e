"""The stand-alone SQL reports (staging queries and KPI queries) as DataFrame plans.

Each groups the fact by one dimension attribute; bare columns that SQL
tolerates (month name, category, reliability) are functionally dependent on
the grouping key and become extra grouping keys.  Every ``ORDER BY`` gets the
name as tie-breaker so equal metrics sort deterministically.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import sql_round
from .kpis import by_month, by_product, by_region, by_supplier
from .measures import (
    avg_cost,
    avg_of,
    avg_unit_cost,
    on_time_pct,
    partial_measures,
    rate_pct,
    revenue,
    total,
)

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

# Stock alert thresholds of the staging report, top-N size.
ALERT_CRITICAL_BELOW = 100
ALERT_LOW_BELOW = 250
TOP_N = 5


def stg_monthly_volume(star: StarSchema) -> DataFrame:
    return by_month(star).select(
        "year",
        "month_name",
        "month",
        F.col("n_orders").alias("total_orders"),
        F.col("sum_qty").alias("total_units"),
        revenue(0).alias("total_revenue"),
    ).orderBy("year", "month")


def stg_supplier_performance(star: StarSchema) -> DataFrame:
    return by_supplier(star).select(
        "supplier_name",
        "reliability",
        F.col("n_orders").alias("total_orders"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
        sql_round(avg_of("actual"), 1).alias("avg_actual_days"),
        rate_pct(1).alias("delay_rate_pct"),
        revenue(0).alias("total_value"),
    ).orderBy(F.desc("delay_rate_pct"), "supplier_name")


def stg_product_profitability(star: StarSchema) -> DataFrame:
    return by_product(star).select(
        "product_name",
        "category",
        F.col("n_orders").alias("order_count"),
        F.col("sum_qty").alias("total_qty"),
        sql_round(avg_unit_cost(), 2).alias("avg_unit_cost"),
        revenue(0).alias("total_revenue"),
        sql_round(avg_of("stock"), 0).alias("avg_stock"),
    ).orderBy(F.desc("total_revenue"), "product_name")


def stg_region_performance(star: StarSchema) -> DataFrame:
    return by_region(star).select(
        "region_name",
        F.col("n_orders").alias("total_orders"),
        revenue(0).alias("total_revenue"),
        sql_round(avg_of("delay"), 1).alias("avg_delay_days"),
        rate_pct(1).alias("delay_rate_pct"),
    ).orderBy(F.desc("total_revenue"), "region_name")


def stg_stock_alert(star: StarSchema) -> DataFrame:
    """Stock status on the unrounded mean stock (<100 CRITICAL, <250 LOW).
    ``monthly_demand`` is the order count, as in the source report."""
    stock = avg_of("stock")
    status = (
        F.when(stock < ALERT_CRITICAL_BELOW, F.lit("CRITICAL"))
        .when(stock < ALERT_LOW_BELOW, F.lit("LOW"))
        .otherwise(F.lit("ADEQUATE"))
    )
    return by_product(star).select(
        "product_name",
        "category",
        sql_round(stock, 0).alias("current_stock"),
        sql_round(avg_of("lead"), 0).alias("avg_lead_time"),
        F.col("n_orders").alias("monthly_demand"),
        status.alias("stock_status"),
    ).orderBy("current_stock", "product_name")


def stg_cost_variance(star: StarSchema) -> DataFrame:
    """Planned vs actual days per product; variance = round of the difference of unrounded means."""
    return by_product(star).select(
        "product_name",
        sql_round(avg_of("lead"), 1).alias("planned_days"),
        sql_round(avg_of("actual"), 1).alias("actual_days"),
        sql_round(avg_of("actual") - avg_of("lead"), 1).alias("avg_variance_days"),
        revenue(0).alias("total_spend"),
    ).orderBy(F.desc("avg_variance_days"), "product_name")


def sql_overall_health(star: StarSchema) -> DataFrame:
    return total(partial_measures(star.fact_orders, [])).select(
        F.col("n_rows").alias("total_orders"),
        revenue(0).alias("total_revenue"),
        sql_round(avg_cost(), 0).alias("avg_order_value"),
        on_time_pct(1).alias("on_time_rate_pct"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
        sql_round(avg_of("delay"), 2).alias("avg_delay_days"),
    )


def sql_monthly_revenue(star: StarSchema) -> DataFrame:
    """Month is sorted on but not projected."""
    return (
        by_month(star)
        .orderBy("year", "month")
        .select("year", "month_name", F.col("n_orders").alias("orders"), revenue(0).alias("revenue"))
    )


def sql_top_products(star: StarSchema, n: int = TOP_N) -> DataFrame:
    return (
        by_product(star)
        .select("product_name", "category", revenue(0).alias("revenue"), F.col("sum_qty").alias("units_sold"))
        .orderBy(F.desc("revenue"), "product_name")
        .limit(n)
    )


def sql_supplier_leaderboard(star: StarSchema) -> DataFrame:
    return by_supplier(star).select(
        "supplier_name",
        "reliability",
        rate_pct(1).alias("delay_rate_pct"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_days"),
        F.col("n_orders").alias("total_orders"),
    ).orderBy(F.desc("delay_rate_pct"), "supplier_name")


def sql_region_sla(star: StarSchema) -> DataFrame:
    return by_region(star).select(
        "region_name",
        revenue(0).alias("revenue"),
        rate_pct(1).alias("delay_pct"),
        on_time_pct(1).alias("on_time_pct"),
    ).orderBy(F.desc("on_time_pct"), "region_name")


def sql_top_products_orders(star: StarSchema, n: int = TOP_N) -> DataFrame:
    return (
        by_product(star)
        .select("product_name", "category", F.col("n_orders").alias("orders"), revenue(0).alias("revenue"))
        .orderBy(F.desc("revenue"), "product_name")
        .limit(n)
    )
