"""Registry of named queries: key -> (spark, sf_dir) -> DataFrame.

Each query starts from the star schema built over the driver tables of
``sf_dir`` (built and written once per session, see ``warehouse``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forecast as fc
from ..operators import clean, curve, inventory, kpis, mart, profile, quality, risk, staging, variance
from ..schemas import RAW_ORDERS, column_names
from ..sources import adapter
from . import text_feed as fixture
from .warehouse import StarSchema, warehouse

Query = Callable[[SparkSession, str], DataFrame]

def raw_feed(star: StarSchema) -> DataFrame:
    """The raw order feed without the adapter's tie-break columns."""
    return star.raw_orders.select(*column_names(RAW_ORDERS))


def text_feed(star: StarSchema) -> DataFrame:
    """The feed read back from text cells."""
    return clean.typed_feed(fixture.text_feed(star.raw_orders))


# The slice that the filtered dashboard keys show.
SLICE = {"years": [1996, 1997], "categories": ["Hardware", "Other"]}


def _q(name: str, fn: Callable[[StarSchema], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse(spark, sf_dir))

    run.__name__ = run.__qualname__ = name
    run.__doc__ = getattr(fn, "__doc__", None) or f"Query '{name}' over the star schema of sf_dir."
    return run


_STAR_QUERIES: dict[str, Callable[[StarSchema], DataFrame]] = {
    # feed and cleaning
    "enrich_orders": raw_feed,
    "clean_orders": lambda s: s.orders,
    "profile_orders": lambda s: profile.profile_orders(raw_feed(s)),
    "feed_summary": lambda s: profile.feed_summary(raw_feed(s)),
    "inventory_snapshot": lambda s: inventory.inventory_snapshot(raw_feed(s)),
    # the same feed as text cells with planted faults
    "text_bad_cells": lambda s: clean.bad_cells(fixture.text_feed(s.raw_orders)),
    "text_feed_summary": lambda s: profile.feed_summary(text_feed(s)),
    "text_profile_orders": lambda s: profile.profile_orders(text_feed(s)),
    "text_inventory_snapshot": lambda s: inventory.inventory_snapshot(text_feed(s)),
    "text_clean_orders": lambda s: clean.clean_orders(
        clean.typed_feed(fixture.text_feed(s.raw_orders, keep=adapter.FIRST_BY)), first_by=adapter.FIRST_BY
    ),
    # star schema
    "dim_date": lambda s: s.dim_date,
    "dim_product": lambda s: s.dim_product,
    "dim_supplier": lambda s: s.dim_supplier,
    "dim_region": lambda s: s.dim_region,
    "fact_orders": lambda s: s.fact_orders,
    "export_mart": mart.export_mart,
    # data quality
    "validate_schema": quality.validate_schema,
    "fact_null_cells": quality.fact_null_cells,
    "dq_foreign_keys": quality.dq_foreign_keys,
    "dq_constraints": quality.dq_constraints,
    # analytics modules
    "inventory_kpis": inventory.inventory_kpis,
    "inventory_alerts": inventory.inventory_alerts,
    "inventory_health": inventory.inventory_health,
    "supplier_risk": risk.supplier_risk,
    "supplier_risk_view": risk.supplier_risk_view,
    "cost_variance": variance.cost_variance,
    "monthly_category_spend": variance.monthly_category_spend,
    "monthly_on_time": variance.monthly_on_time,
    "kpi_summary": kpis.kpi_summary,
    "executive_kpis": kpis.executive_kpis,
    "kpi_by_region": kpis.kpi_by_region,
    "kpi_by_product": kpis.kpi_by_product,
    "kpi_monthly_trend": kpis.kpi_monthly_trend,
    # forecasting
    "daily_demand": fc.daily_demand,
    "forecast_rolling": lambda s: fc.forecast_rolling(fc.daily_series(s)).orderBy("date"),
    "forecast_segments": lambda s: fc.forecast_segments(fc.daily_series(s)).orderBy("date"),
    "forecast_seasonal": lambda s: fc.forecast_seasonal(fc.daily_series(s)).orderBy("date"),
    "forecast_tail": lambda s: fc.forecast_tail(fc.forecast_rolling(fc.daily_series(s))),
    "forecast_rolling_by_category": lambda s: fc.forecast_rolling(fc.daily_series(s, ["category"]), ["category"]).orderBy(
        "category", "date"
    ),
    "forecast_seasonal_by_category": lambda s: fc.forecast_seasonal(
        fc.daily_series(s, ["category"]), ["category"]
    ).orderBy("category", "date"),
    "forecast_gram": lambda s: curve.gram(fc.daily_series(s)).withColumn("total", F.col("total").cast("double")),
    "forecast_gram_by_category": lambda s: curve.gram(fc.daily_series(s, ["category"]), ["category"]).withColumn(
        "total", F.col("total").cast("double")
    ),
    # stand-alone SQL reports
    "stg_monthly_volume": staging.stg_monthly_volume,
    "stg_supplier_performance": staging.stg_supplier_performance,
    "stg_product_profitability": staging.stg_product_profitability,
    "stg_region_performance": staging.stg_region_performance,
    "stg_stock_alert": staging.stg_stock_alert,
    "stg_cost_variance": staging.stg_cost_variance,
    "sql_overall_health": staging.sql_overall_health,
    "sql_monthly_revenue": staging.sql_monthly_revenue,
    "sql_top_products": staging.sql_top_products,
    "sql_supplier_leaderboard": staging.sql_supplier_leaderboard,
    "sql_region_sla": staging.sql_region_sla,
    "sql_top_products_orders": staging.sql_top_products_orders,
    # dashboard data sets
    "kpi_sliced": kpis.kpi_sliced,
    "sliced_cards": lambda s: kpis.kpi_sliced(s, **SLICE),
    "sliced_by_region": lambda s: kpis.kpi_by_region(kpis.sliced(s, **SLICE)),
    "sliced_by_product": lambda s: kpis.kpi_by_product(kpis.sliced(s, **SLICE)),
    "sliced_monthly_trend": lambda s: kpis.kpi_monthly_trend(kpis.sliced(s, **SLICE)),
    "sliced_supplier_leaderboard": lambda s: staging.sql_supplier_leaderboard(kpis.sliced(s, **SLICE)),
    "sliced_stock_alert": lambda s: staging.stg_stock_alert(kpis.sliced(s, **SLICE)),
    "revenue_concentration": kpis.revenue_concentration,
    "delay_per_affected": kpis.delay_per_affected,
    "kpi_targets": kpis.kpi_targets,
}


# Queries that solve equations, which SQL cannot express; their tests compare with brute force.
_SOLVED: dict[str, Callable[[StarSchema], DataFrame]] = {
    "forecast_model": lambda s: curve.forecast_model(fc.daily_series(s)).orderBy("date"),
    "forecast_model_by_category": lambda s: curve.forecast_model(fc.daily_series(s, ["category"]), ["category"]).orderBy(
        "category", "date"
    ),
}


def queries() -> dict[str, Query]:
    return {name: _q(name, fn) for name, fn in _STAR_QUERIES.items()}


def solved_queries() -> dict[str, Query]:
    return {name: _q(name, fn) for name, fn in _SOLVED.items()}
