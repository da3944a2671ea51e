"""CSV feed in, tables and CSV out, read back (sources and sinks)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from stockyard.operators.clean import clean_orders
from stockyard.operators.forecast import forecast_rolling, forecast_tail
from stockyard.plans.warehouse import build_star_schema
from stockyard.schemas import FORECAST, RAW_CSV_COLUMNS
from stockyard.sources.files import (
    create_star_tables,
    load_star_schema,
    read_csv,
    read_raw_orders_csv,
    write_csv,
)


def write_feed(path):
    header = ",".join(RAW_CSV_COLUMNS)
    lines = [header]
    # same order_id twice: the first line in the file must win, even though it is later in date
    lines.append("ORD-00002,2022-01-09 00:00:00, camera ,TechCorp India,North,10,99.999,7,,True,5,999.99,3,10")
    lines.append("ORD-00001,2022-01-01 00:00:00,Phone,QuickShip Asia,South,5,10.0,3,,False,0,50.0,0,3")
    lines.append("ORD-00002,2022-01-02 00:00:00,Laptop,TechCorp India,North,1,1.0,3,,False,0,1.0,0,3")
    lines.append("ORD-00003,2022-01-03 00:00:00,,TechCorp India,North,1,1.0,3,,False,0,1.0,0,3")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_feed_first_in_file_order(spark, tmp_dir):
    p = os.path.join(tmp_dir, "orders.csv")
    write_feed(p)
    raw = read_raw_orders_csv(spark, p)
    assert "actual_delivery" not in raw.columns
    out = {r.order_id: r for r in clean_orders(raw).collect()}
    assert sorted(out) == ["ORD-00001", "ORD-00002"]
    o2 = out["ORD-00002"]
    assert o2.product_name == "Camera" and o2.order_date == dt.date(2022, 1, 9)
    assert o2.unit_cost == 100.0 and o2.total_cost == 1000.0 and o2.is_delayed == 1


def test_star_schema_round_trip(spark, tmp_dir):
    p = os.path.join(tmp_dir, "orders.csv")
    write_feed(p)
    star = build_star_schema(clean_orders(read_raw_orders_csv(spark, p)))
    tables = {n: star.table(n) for n in ("dim_date", "dim_product", "dim_supplier", "dim_region", "fact_orders")}
    root = os.path.join(tmp_dir, "warehouse")
    back = load_star_schema(tables, root)
    assert back["fact_orders"].count() == 2 and back["dim_supplier"].count() == 2
    again = load_star_schema(tables, root)  # replace semantics, not append
    assert again["fact_orders"].count() == 2
    names = create_star_tables(spark, root, prefix="t_io_")
    assert spark.table("t_io_fact_orders").count() == 2
    create_star_tables(spark, root, prefix="t_io_")  # idempotent
    assert len(names) == 5


def test_forecast_csv_round_trip(spark, tmp_dir):
    daily = spark.createDataFrame([(dt.date(2023, 1, 1) + dt.timedelta(days=i), float(i % 7)) for i in range(45)],
                                  "ds date, y double")
    fc = forecast_rolling(daily)
    path = write_csv(fc, os.path.join(tmp_dir, "forecast"), single_file=True)
    back = read_csv(spark, path, FORECAST)
    assert back.count() == 135
    assert back.exceptAll(fc).count() == 0
    assert [r.date for r in forecast_tail(back).collect()][-1] == dt.date(2023, 1, 1) + dt.timedelta(days=134)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_build_from_csv_and_write_outputs(spark, tmp_dir):
    from stockyard.plans.runs import build_from_csv, write_outputs

    p = os.path.join(tmp_dir, "orders.csv")
    write_feed(p)
    star = build_from_csv(spark, p, os.path.join(tmp_dir, "wh"))
    assert star.rows["fact_orders"] == 2 and star.rows["dim_supplier"] == 2
    paths = write_outputs(star, os.path.join(tmp_dir, "out"))
    risk = spark.read.option("header", True).csv(paths["supplier_risk"])
    assert risk.count() == 2 and "risk_label" in risk.columns
    assert spark.read.option("header", True).csv(paths["bi_fact_orders"]).count() == 2
    assert spark.read.option("header", True).csv(paths["bi_mart"]).count() == 2
    summary = {r.KPI: float(r.Value) for r in spark.read.option("header", True).csv(paths["kpi_summary"]).collect()}
    assert summary["Total Orders"] == 2.0


def test_bucketed_layer_falls_back_to_plain_parquet(spark, tmp_dir, monkeypatch):
    from pyspark.errors import AnalysisException
    from stockyard.plans import warehouse as W

    def no_catalog(*a, **k):
        raise AnalysisException("catalog is read-only")

    monkeypatch.setattr(W, "_write_bucketed", no_catalog)
    p = os.path.join(tmp_dir, "orders.csv")
    write_feed(p)
    raw = read_raw_orders_csv(spark, p).withColumn("_k", F.lit(1))
    star = W.build_warehouse(spark, raw, os.path.join(tmp_dir, "wh"), colocate_by=["_k"])
    assert star.rows["fact_orders"] == 2
