"""Edge values: thresholds hit exactly, zero stock / demand / lead time."""

import datetime as dt

from pyspark.sql import functions as F

from stockyard.operators.inventory import derive_inventory_kpis
from stockyard.operators.risk import score_suppliers
from stockyard.operators.staging import stg_stock_alert
from stockyard.plans.warehouse import build_star_schema

COLS = ["order_id", "order_date", "product_name", "supplier_name", "region", "quantity_ordered", "unit_cost",
        "total_cost", "lead_time_days", "actual_delivery_days", "delay_days", "is_delayed", "warehouse_stock"]


def test_risk_labels_at_exact_edges(spark):
    # delay 30 / lead 15 / no spread -> risk 12.0; craft scores so risk hits 30.0 and 60.0 exactly
    base = spark.createDataFrame(
        [
            ("a", "Low", 1, 75.0, 15.0, 15.0, 15.0, 1.0),   # 0.40 * 75 = 30.0
            ("b", "Low", 1, 100.0, 22.5, 22.5, 22.5, 1.0),  # 40 + 0.35 * 50 = 57.5
            ("c", "Low", 1, 100.0, 15.0, 0.0, 12.0, 1.0),   # 40 + 0.25 * 80 = 60.0
            ("z", "Low", 1, 10.0, 0.0, 0.0, 0.0, 1.0),      # zero lead time: variance undefined
        ],
        "supplier_name string, reliability string, total_orders long, delay_rate_pct double, avg_lead_time double, "
        "min_lead_time double, max_lead_time double, total_spend double",
    )
    got = {r.supplier_name: r for r in score_suppliers(base).collect()}
    assert (got["a"].risk_score, got["a"].risk_label) == (30.0, "Low Risk")
    assert (got["b"].risk_score, got["b"].risk_label) == (57.5, "Medium Risk")
    assert (got["c"].risk_score, got["c"].risk_label) == (60.0, "Medium Risk")
    assert got["z"].variance_score is None and got["z"].risk_score is None and got["z"].risk_label is None


def test_inventory_zero_stock_and_zero_demand(spark):
    base = spark.createDataFrame(
        [("p0", "c", 1, 100, 0.0, 10.0, 5.0), ("d0", "c", 1, 0, 50.0, 10.0, 0.0), ("e", "c", 1, 730, 300.0, 0.0, 1.0)],
        "product_name string, category string, total_orders long, total_units_sold long, avg_stock double, "
        "avg_lead_time double, total_revenue double",
    )
    got = {r.product_name: r for r in derive_inventory_kpis(base).collect()}
    assert got["p0"].inventory_turnover is None and got["p0"].stock_status == "CRITICAL"
    assert got["d0"].days_of_stock is None and got["d0"].reorder_point == 0
    assert got["e"].reorder_point == 0 and got["e"].stock_status == "LOW" and got["e"].days_of_stock == 300.0


def test_stock_alert_uses_strict_thresholds(spark):
    rows = []
    for name, stock in (("A", 100), ("B", 250), ("C", 99), ("D", 249)):
        rows.append((f"O-{name}", dt.date(2022, 1, 1), name, "S", "R", 1, 1.0, 1.0, 1, 1, 0, 0, stock))
    star = build_star_schema(spark.createDataFrame(rows, COLS))
    got = {r.product_name: r.stock_status for r in stg_stock_alert(star).collect()}
    assert got == {"A": "LOW", "B": "ADEQUATE", "C": "CRITICAL", "D": "LOW"}


def test_empty_feed_gives_empty_reports(spark):
    from stockyard.operators.kpis import executive_kpis

    star = build_star_schema(spark.createDataFrame([], spark.createDataFrame([("x", dt.date(2022, 1, 1), "p", "s", "r", 1, 1.0, 1.0, 1, 1, 0, 0, 1)], COLS).schema))
    row = executive_kpis(star).first()
    assert row.total_orders == 0 and row.total_revenue is None and row.high_risk_suppliers == 0
    assert stg_stock_alert(star).count() == 0
    assert star.fact_orders.where(F.lit(True)).count() == 0
