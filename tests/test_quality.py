"""Data-quality checks find planted violations."""

import datetime as dt

from stockyard.operators.quality import dq_constraints, dq_foreign_keys, fact_null_cells, validate_schema
from stockyard.plans.warehouse import StarSchema


def star(spark):
    fact = spark.createDataFrame(
        [
            ("O1", 20220101, 1, 1, 1, 1, 1.0, 10.0, 5, 5, 0, 0, 10),
            ("O1", 20220101, 2, 1, 1, 1, 1.0, 10.0, 5, 6, 1, 1, 10),   # duplicate PK
            ("O2", 20220102, None, 9, 1, 1, 1.0, 10.0, 5, 5, 0, 0, 10),  # null product, orphan supplier
        ],
        "order_id string, date_id int, product_id int, supplier_id int, region_id int, quantity_ordered int, "
        "unit_cost double, total_cost double, lead_time_days int, actual_delivery_days int, delay_days int, "
        "is_delayed int, warehouse_stock int",
    )
    dd = spark.createDataFrame([(20220101, dt.date(2022, 1, 1), 2022, 1, 1, "January", 0, "Saturday"),
                                (20220102, dt.date(2022, 1, 2), 2022, 1, 1, "January", 0, "Sunday")],
                               "date_id int, full_date date, year int, quarter int, month int, month_name string, week int, day_of_week string")
    dp = spark.createDataFrame([(1, "A", 1.0, "X"), (2, "A", 1.0, "X")], "product_id int, product_name string, unit_cost double, category string")
    ds = spark.createDataFrame([(1, "S", "Low", "India")], "supplier_id int, supplier_name string, reliability string, country string")
    dr = spark.createDataFrame([(1, "R", None)], "region_id int, region_name string, zone string")
    return StarSchema(dd, dp, ds, dr, fact)


def test_foreign_keys(spark):
    got = {r.fk_column: (r.null_refs, r.orphan_refs) for r in dq_foreign_keys(star(spark)).collect()}
    assert got == {"date_id": (0, 0), "product_id": (1, 0), "supplier_id": (0, 1), "region_id": (0, 0)}


def test_constraints(spark):
    got = {(r.table_name, r.constraint_type, r.column_name): r.violations for r in dq_constraints(star(spark)).collect()}
    assert got[("fact_orders", "PRIMARY KEY", "order_id")] == 1
    assert got[("dim_product", "UNIQUE", "product_name")] == 1
    assert got[("dim_product", "PRIMARY KEY", "product_id")] == 0
    assert got[("dim_region", "NOT NULL", "region_name")] == 0


def test_validate_and_null_cells(spark):
    s = star(spark)
    checks = {r.check: r.value for r in validate_schema(s).collect()}
    assert checks["Total orders"] == 3 and checks["Null product_ids"] == 1 and checks["Unique products"] == 2
    assert checks["Total revenue"] == 30.0 and checks["Delayed order %"] == 33.3
    assert fact_null_cells(s).first().null_cells == 1
