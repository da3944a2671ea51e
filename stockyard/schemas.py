"""Table contracts of the order pipeline (column names, order and types)."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw order feed as written by the order generator, in file column order.
# ``actual_delivery`` is always empty in that feed and is dropped on read.
RAW_CSV_COLUMNS = [
    "order_id",
    "order_date",
    "product_name",
    "supplier_name",
    "region",
    "quantity_ordered",
    "unit_cost",
    "lead_time_days",
    "actual_delivery",
    "is_delayed",
    "warehouse_stock",
    "total_cost",
    "delay_days",
    "actual_delivery_days",
]

# Read every raw column as text; types are enforced by ``clean_orders``
# with ``try_cast`` so that one bad cell does not fail a whole job.
RAW_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_CSV_COLUMNS])

RAW_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType(), True),
        T.StructField("order_date", T.DateType(), True),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("supplier_name", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("quantity_ordered", T.IntegerType(), True),
        T.StructField("unit_cost", T.DoubleType(), True),
        T.StructField("lead_time_days", T.IntegerType(), True),
        T.StructField("warehouse_stock", T.IntegerType(), True),
        T.StructField("delay_days", T.IntegerType(), True),
        T.StructField("total_cost", T.DoubleType(), True),
        T.StructField("actual_delivery_days", T.IntegerType(), True),
        T.StructField("is_delayed", T.BooleanType(), True),
    ]
)

CLEAN_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType(), False),
        T.StructField("order_date", T.DateType(), True),
        T.StructField("product_name", T.StringType(), False),
        T.StructField("supplier_name", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("quantity_ordered", T.IntegerType(), True),
        T.StructField("unit_cost", T.DoubleType(), True),
        T.StructField("total_cost", T.DoubleType(), True),
        T.StructField("lead_time_days", T.IntegerType(), True),
        T.StructField("actual_delivery_days", T.IntegerType(), True),
        T.StructField("delay_days", T.IntegerType(), True),
        T.StructField("is_delayed", T.IntegerType(), True),
        T.StructField("warehouse_stock", T.IntegerType(), True),
    ]
)

DIM_DATE = T.StructType(
    [
        T.StructField("date_id", T.IntegerType(), False),
        T.StructField("full_date", T.DateType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField("quarter", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("month_name", T.StringType(), False),
        T.StructField("week", T.IntegerType(), False),
        T.StructField("day_of_week", T.StringType(), False),
    ]
)

DIM_PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.IntegerType(), False),
        T.StructField("product_name", T.StringType(), False),
        T.StructField("unit_cost", T.DoubleType(), True),
        T.StructField("category", T.StringType(), False),
    ]
)

DIM_SUPPLIER = T.StructType(
    [
        T.StructField("supplier_id", T.IntegerType(), False),
        T.StructField("supplier_name", T.StringType(), False),
        T.StructField("reliability", T.StringType(), True),
        T.StructField("country", T.StringType(), False),
    ]
)

DIM_REGION = T.StructType(
    [
        T.StructField("region_id", T.IntegerType(), False),
        T.StructField("region_name", T.StringType(), False),
        T.StructField("zone", T.StringType(), True),
    ]
)

FACT_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType(), False),
        T.StructField("date_id", T.IntegerType(), True),
        T.StructField("product_id", T.IntegerType(), True),
        T.StructField("supplier_id", T.IntegerType(), True),
        T.StructField("region_id", T.IntegerType(), True),
        T.StructField("quantity_ordered", T.IntegerType(), True),
        T.StructField("unit_cost", T.DoubleType(), True),
        T.StructField("total_cost", T.DoubleType(), True),
        T.StructField("lead_time_days", T.IntegerType(), True),
        T.StructField("actual_delivery_days", T.IntegerType(), True),
        T.StructField("delay_days", T.IntegerType(), True),
        T.StructField("is_delayed", T.IntegerType(), True),
        T.StructField("warehouse_stock", T.IntegerType(), True),
    ]
)

# The written fact is partitioned by the year of its date key (null without a date).
FACT_PARTITION = "order_year"

STAR_TABLES = {
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "dim_supplier": DIM_SUPPLIER,
    "dim_region": DIM_REGION,
    "fact_orders": FACT_ORDERS,
}

# Saved analytics outputs, read back by the reporting notebook.
FORECAST = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("forecast_qty", T.DoubleType(), True),
        T.StructField("lower_bound", T.DoubleType(), True),
        T.StructField("upper_bound", T.DoubleType(), True),
    ]
)


def column_names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
