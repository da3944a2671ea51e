"""Inventory analytics: feed snapshot, per-product KPIs, alerts and health view."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import bin_right, pd_round, safe_div, sql_round
from .measures import avg_of, revenue

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

# Demand period (days), safety factor, stock bins, alert horizon.
PERIOD_DAYS = 730
SAFETY_FACTOR = 1.5
STOCK_EDGES = [-1, 100, 300, 99999]
STOCK_LABELS = ["CRITICAL", "LOW", "ADEQUATE"]
DAYS_OF_STOCK_ALERT = 30


def inventory_snapshot(raw_orders: DataFrame, period_days: int = PERIOD_DAYS) -> DataFrame:
    """Per product of the raw feed: mean stock, units, value (the feed's own
    ``total_cost``), mean lead time, reorder point (from the unrounded means) and
    a Low Stock / Adequate flag.  Rows without a product belong to none."""
    per = raw_orders.where(F.col("product_name").isNotNull()).groupBy("product_name").agg(
        F.avg("warehouse_stock").alias("avg_stock"),
        F.sum("quantity_ordered").alias("total_ordered"),
        F.sum(F.col("total_cost").cast("decimal(28,6)")).cast("double").alias("total_cost"),
        F.avg("lead_time_days").alias("avg_lead_time"),
    )
    return reorder_status(
        per.select("product_name", "avg_stock", "total_ordered", "total_cost", "avg_lead_time"),
        period_days,
    ).orderBy("product_name")


def reorder_status(per: DataFrame, period_days: int = PERIOD_DAYS) -> DataFrame:
    """Reorder point from unrounded means and the Low Stock / Adequate flag."""
    reorder = pd_round(F.col("avg_lead_time") * (F.col("total_ordered") / F.lit(period_days)), 0)
    return per.withColumn("reorder_point", reorder).withColumn(
        "stock_status",
        F.when(F.col("avg_stock") < F.col("reorder_point"), F.lit("Low Stock")).otherwise(F.lit("Adequate")),
    )


def product_aggregates(star: StarSchema) -> DataFrame:
    """Fact measures per (product_name, category) (product names are unique)."""
    from .kpis import by_product

    return by_product(star)


def inventory_base(star: StarSchema) -> DataFrame:
    """Rounded per-product aggregates the inventory KPIs are derived from."""
    return product_aggregates(star).select(
        "product_name",
        "category",
        F.col("n_orders").alias("total_orders"),
        F.col("sum_qty").alias("total_units_sold"),
        sql_round(avg_of("stock"), 0).alias("avg_stock"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
        revenue(0).alias("total_revenue"),
    )


def derive_inventory_kpis(
    base: DataFrame, period_days: int = PERIOD_DAYS, safety_factor: float = SAFETY_FACTOR
) -> DataFrame:
    """Daily demand, reorder point, safety stock, turnover, days of stock and
    status, all from the rounded aggregates."""
    add = F.col("avg_daily_demand")
    lead = F.col("avg_lead_time")
    return base.withColumn("avg_daily_demand", pd_round(F.col("total_units_sold") / F.lit(period_days), 2)).withColumns(
        {
            "reorder_point": pd_round(add * lead, 0).cast("long"),
            "safety_stock": pd_round(add * lead * F.lit(float(safety_factor)), 0).cast("long"),
            "inventory_turnover": pd_round(safe_div(F.col("total_units_sold"), F.col("avg_stock")), 2),
            "days_of_stock": pd_round(safe_div(F.col("avg_stock"), add), 1),
            "stock_status": bin_right(F.col("avg_stock"), STOCK_EDGES, STOCK_LABELS),
        }
    )


def inventory_kpis(
    star: StarSchema, period_days: int = PERIOD_DAYS, safety_factor: float = SAFETY_FACTOR
) -> DataFrame:
    """Per-product inventory KPIs, highest revenue first."""
    return derive_inventory_kpis(inventory_base(star), period_days, safety_factor).orderBy(
        F.desc("total_revenue"), "product_name"
    )


def inventory_alerts(star: StarSchema, horizon_days: int = DAYS_OF_STOCK_ALERT) -> DataFrame:
    """Status and the days-of-stock threshold flag per product."""
    return inventory_kpis(star).select(
        "product_name",
        "stock_status",
        "days_of_stock",
        (F.col("days_of_stock") < F.lit(horizon_days)).alias("below_threshold"),
    )


def inventory_health(star: StarSchema) -> DataFrame:
    """Inventory health table as shown in the report."""
    return inventory_kpis(star).select("product_name", "avg_stock", "reorder_point", "days_of_stock", "stock_status")
