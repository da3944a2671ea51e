"""Flattened mart for BI tools and whole-table exports."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from ..plans.joins import lookup_join

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

MART_COLUMNS = [
    "product_name",
    "category",
    "region_name",
    "supplier_name",
    "reliability",
    "year",
    "month",
    "month_name",
    "quarter",
    "quantity_ordered",
    "total_cost",
    "lead_time_days",
    "actual_delivery_days",
    "delay_days",
    "is_delayed",
    "warehouse_stock",
]


def export_mart(star: StarSchema) -> DataFrame:
    """One row per order with its dimension attributes (four inner joins).

    Dimensions are broadcast when their recorded size allows; otherwise the
    join shuffles and AQE splits skewed keys."""
    f = star.fact_orders
    f = lookup_join(f, star.dim_product.select("product_id", "product_name", "category"), "product_id", "inner", star.dim_rows("dim_product"))
    f = lookup_join(f, star.dim_supplier.select("supplier_id", "supplier_name", "reliability"), "supplier_id", "inner", star.dim_rows("dim_supplier"))
    f = lookup_join(f, star.dim_region.select("region_id", "region_name"), "region_id", "inner", star.dim_rows("dim_region"))
    f = lookup_join(f, star.dim_date.select("date_id", "year", "month", "month_name", "quarter"), "date_id", "inner", star.dim_rows("dim_date"))
    return f.select(*MART_COLUMNS)

