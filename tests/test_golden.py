"""Re-derive published outputs of the original pipeline from their own aggregate columns.

The rows below are the original pipeline's committed results (2,000 orders).
Only post-aggregate formulas can be checked this way: the raw orders behind
them were never published.
"""

import pytest
from pyspark.sql import functions as F

from stockyard.operators.inventory import derive_inventory_kpis, reorder_status
from stockyard.operators.risk import score_suppliers
from stockyard.operators.variance import derive_cost_variance

# Golden supplier rows (inputs ..., then expected scores and label).
SUPPLIERS = [
    ("Techcorp India", "Low", 383, 30.55, 23.9, 3.0, 44.0, 99761554.0, 30.55, 59.33333333333333, 100.0, 58.0, "Medium Risk"),
    ("Fastsupply Co", "Medium", 416, 25.96, 24.2, 3.0, 44.0, 100452067.0, 25.96, 61.33333333333333, 100.0, 56.9, "Medium Risk"),
    ("Globalparts Ltd", "Medium", 396, 24.75, 23.3, 3.0, 44.0, 104067559.0, 24.75, 55.333333333333336, 100.0, 54.3, "Medium Risk"),
    ("Reliablegoods", "Medium", 400, 24.0, 23.4, 3.0, 44.0, 112080357.0, 24.0, 55.99999999999999, 100.0, 54.2, "Medium Risk"),
    ("Quickship Asia", "Medium", 405, 23.7, 23.5, 3.0, 44.0, 107503462.0, 23.7, 56.666666666666664, 100.0, 54.3, "Medium Risk"),
]

# Golden inventory KPI rows.
INVENTORY = [
    ("Monitor", "Computing", 212, 57771, 519.0, 23.1, 59409439.0, 79.14, 1828, 2742, 111.31, 6.6, "ADEQUATE"),
    ("Tablet", "Mobile", 205, 49598, 497.0, 23.5, 54862157.0, 67.94, 1597, 2395, 99.79, 7.3, "ADEQUATE"),
    ("Printer", "Imaging", 205, 51617, 525.0, 24.1, 53490729.0, 70.71, 1704, 2556, 98.32, 7.4, "ADEQUATE"),
    ("Mouse", "Accessories", 203, 51711, 486.0, 24.2, 53258701.0, 70.84, 1714, 2571, 106.4, 6.9, "ADEQUATE"),
    ("Laptop", "Computing", 201, 53135, 510.0, 22.0, 52974147.0, 72.79, 1601, 2402, 104.19, 7.0, "ADEQUATE"),
    ("Phone", "Mobile", 192, 47131, 463.0, 25.0, 51134734.0, 64.56, 1614, 2421, 101.79, 7.2, "ADEQUATE"),
    ("Keyboard", "Accessories", 213, 49892, 522.0, 23.6, 50938776.0, 68.35, 1613, 2420, 95.58, 7.6, "ADEQUATE"),
    ("Camera", "Imaging", 203, 50541, 495.0, 23.8, 50712743.0, 69.23, 1648, 2472, 102.1, 7.2, "ADEQUATE"),
    ("Headphones", "Audio", 187, 46186, 480.0, 22.7, 50206800.0, 63.27, 1436, 2154, 96.22, 7.6, "ADEQUATE"),
    ("Speaker", "Audio", 179, 45764, 471.0, 24.7, 46876773.0, 62.69, 1548, 2323, 97.16, 7.5, "ADEQUATE"),
]

# Golden raw inventory snapshot rows.
SNAPSHOT = [
    ("Camera", 494.76354679802955, 50541, 23.783251231527093, 1647.0),
    ("Headphones", 480.4812834224599, 46186, 22.737967914438503, 1439.0),
    ("Keyboard", 521.8826291079812, 49892, 23.6056338028169, 1613.0),
    ("Laptop", 509.7313432835821, 53135, 21.975124378109452, 1600.0),
    ("Monitor", 518.9575471698113, 57771, 23.056603773584907, 1825.0),
    ("Mouse", 485.7142857142857, 51711, 24.15270935960591, 1711.0),
    ("Phone", 462.5520833333333, 47131, 25.03125, 1616.0),
    ("Printer", 525.1560975609756, 51617, 24.12682926829268, 1706.0),
    ("Speaker", 470.9441340782123, 45764, 24.70949720670391, 1549.0),
    ("Tablet", 497.3170731707317, 49598, 23.521951219512196, 1598.0),
]

# Golden cost-variance rows (incl. float noise and half-even cases).
VARIANCE = [
    (2022, 1, "January", 1, "Accessories", 20, 5782603.0, 20.3, 21.3, 1.0, 3, 1.0, 28913.0, 85.0, "2022-Q1"),
    (2022, 2, "February", 1, "Mobile", 17, 4238856.0, 22.6, 23.6, 1.06, 3, 1.0, 22466.0, 82.39999999999999, "2022-Q1"),
    (2022, 5, "May", 2, "Mobile", 16, 4847701.0, 19.6, 20.6, 0.94, 3, 1.0, 22784.0, 81.2, "2022-Q2"),
    (2022, 7, "July", 3, "Mobile", 16, 4136299.0, 20.5, 21.8, 1.31, 3, 1.3, 27093.0, 81.2, "2022-Q3"),
    (2023, 7, "July", 3, "Mobile", 16, 4554753.0, 27.4, 31.8, 4.38, 7, 4.4, 99749.0, 56.2, "2023-Q3"),
]


def test_supplier_scores(spark):
    cols = ["supplier_name", "reliability", "total_orders", "delay_rate_pct", "avg_lead_time", "min_lead_time",
            "max_lead_time", "total_spend"]
    base = spark.createDataFrame([r[:8] for r in SUPPLIERS], cols)
    got = {r.supplier_name: r for r in score_suppliers(base).collect()}
    for r in SUPPLIERS:
        g = got[r[0]]
        assert (g.delay_score, g.lead_time_score, g.variance_score, g.risk_score, g.risk_label) == r[8:]


def test_inventory_kpis(spark):
    cols = ["product_name", "category", "total_orders", "total_units_sold", "avg_stock", "avg_lead_time", "total_revenue"]
    base = spark.createDataFrame([r[:7] for r in INVENTORY], cols)
    got = {r.product_name: r for r in derive_inventory_kpis(base).collect()}
    for r in INVENTORY:
        g = got[r[0]]
        assert (g.avg_daily_demand, g.reorder_point, g.safety_stock, g.inventory_turnover, g.days_of_stock,
                g.stock_status) == r[7:]


def test_snapshot_reorder_points(spark):
    cols = ["product_name", "avg_stock", "total_ordered", "avg_lead_time"]
    per = spark.createDataFrame([r[:4] for r in SNAPSHOT], cols)
    got = {r.product_name: r for r in reorder_status(per).collect()}
    for r in SNAPSHOT:
        assert got[r[0]].reorder_point == r[4]
        assert got[r[0]].stock_status == "Low Stock"


def test_cost_variance_derivation(spark):
    cols = ["year", "month", "month_name", "quarter", "category", "total_orders", "planned_spend", "planned_days",
            "actual_days", "avg_delay", "delayed_orders"]
    base = spark.createDataFrame([r[:11] for r in VARIANCE], cols)
    got = derive_cost_variance(base).orderBy("year", "month").collect()
    for g, r in zip(got, VARIANCE):
        assert (g.day_variance, g.delay_cost, g.on_time_rate, g.period) == r[11:]


def test_golden_invariants():
    # orders and revenue agree between the inventory and supplier tables
    assert sum(r[2] for r in INVENTORY) == 2000 == sum(r[2] for r in SUPPLIERS)
    assert sum(r[6] for r in INVENTORY) == pytest.approx(sum(r[7] for r in SUPPLIERS), abs=3)
