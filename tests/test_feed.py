"""The CSV feed as a typed input that loses nothing silently."""

import os
import types

import pytest
from pyspark.sql import functions as F

from stockyard import session
from stockyard.operators import inventory, kpis, profile, quality
from stockyard.operators.clean import bad_cells, clean_orders
from stockyard.operators.quantiles import exact_quantiles
from stockyard.plans.warehouse import warehouse
from stockyard.sources import adapter
from stockyard.sources.files import SINGLE_FILE_ROWS, read_raw_orders_csv, read_raw_orders_text, write_csv

HEADER = "order_id,order_date,product_name,supplier_name,region,quantity_ordered,unit_cost,lead_time_days,actual_delivery,is_delayed,warehouse_stock,total_cost,delay_days,actual_delivery_days"
LINES = [
    "ORD-1,2022-01-09 00:00:00,Camera,TechCorp,North,7.0,100.0,7,,True,5,999.99,3,10",
    "ORD-2,2022-01-02 00:00:00,Camera,TechCorp,North,oops,1.0,3,,False,0,1.0,0,3",
    "ORD-3,2022-01-03 00:00:00,,TechCorp,North,2,1.0,3,,False,0,2.0,0,3",
    "ORD-4,2022-01-04 00:00:00,Phone,TechCorp,South,1,2.345,x,,False,0,2.345,0,3",
    "ORD-5,2022-01-05 00:00:00,Phone,TechCorp",
]


@pytest.fixture()
def feed(tmp_dir):
    path = os.path.join(tmp_dir, "orders.csv")
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *LINES]) + "\n")
    return path


def test_feed_reports_run_on_a_csv(spark, feed):
    raw = read_raw_orders_csv(spark, feed)
    s = profile.feed_summary(raw.drop("_file_order")).first()
    assert (s.total_orders, s.n_columns, s.delayed_orders) == (5, 13, 1)
    assert s.total_value == 1005.0  # 999.99 + 1 + 2 + 2.345
    snap = {r.product_name: r for r in inventory.inventory_snapshot(raw).collect()}
    assert sorted(snap) == ["Camera", "Phone"]  # rows without a product belong to none
    assert snap["Camera"].total_cost == 1000.99 and snap["Camera"].total_ordered == 7
    assert snap["Phone"].total_cost == 2.345
    assert {r.column_name for r in profile.profile_orders(raw).collect()} == set(profile.INT_COLUMNS + profile.MONEY_COLUMNS)
    out = {r.order_id: r for r in clean_orders(raw).collect()}
    assert out["ORD-1"].quantity_ordered == 7 and out["ORD-1"].total_cost == 700.0


def test_bad_cells_and_malformed_lines_are_counted(spark, feed):
    faults = {r.column_name: r.bad_cells for r in bad_cells(read_raw_orders_text(spark, feed)).collect()}
    assert faults["quantity_ordered"] == 1 and faults["lead_time_days"] == 1 and faults["*"] == 1
    assert sum(faults.values()) == 3


def test_profile_keeps_a_column_of_nulls(spark, feed):
    raw = read_raw_orders_csv(spark, feed).withColumn("delay_days", F.lit(None).cast("int"))
    row = {r.column_name: r for r in profile.profile_orders(raw).collect()}["delay_days"]
    assert row["count"] == 0 and row["mean"] is None and row["p50"] is None and row["max"] is None


def test_adapter_keeps_lines_whose_part_or_order_is_missing(spark, tmp_dir):
    src = "/root/testdata/sf0.001"
    for t in ("lineitem", "orders", "part", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t == "part":
            df = df.where("p_partkey > 5")
        if t == "orders":
            df = df.where("o_orderkey % 10 != 0")
        df.write.parquet(f"{tmp_dir}/{t}.parquet")
    raw = adapter.raw_orders_from_tables(spark, tmp_dir)
    assert raw.count() == spark.read.parquet(f"{src}/lineitem.parquet").count()
    assert raw.where("product_name is null").count() > 0 and raw.where("order_date is null").count() > 0


def test_no_private_folder_on_a_cluster():
    def fake(master):
        sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d=None: d))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("local-cluster[2,1,1024]"))
    assert session.shared_dir(fake("local[4]"))


def test_quantile_paths_are_equal_to_the_last_bit(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 1013).alias("a"), ((F.col("id") * 31) % 97 - 50).alias("b"))
    cols, probs = {"a": F.col("a"), "b": F.col("b")}, [0.0, 0.1, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    one = sorted(tuple(r) for r in exact_quantiles(df, cols, probs).collect())
    two = sorted(tuple(r) for r in exact_quantiles(df, cols, probs, small_pairs=0).collect())
    assert one == two


def _leaves(df):
    it = df._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().iterator()
    while it.hasNext():
        yield it.next()


def test_reports_scan_the_fact_once(spark):
    star = warehouse(spark, "/root/testdata/sf0.001")
    for report in (quality.validate_schema, kpis.executive_kpis, kpis.kpi_summary):
        leaves = [x.toString() for x in _leaves(report(star))]
        assert sum("lead_time_days#" in x for x in leaves) == 1, report.__name__  # a column of the fact alone


def test_year_slice_reaches_the_scan(spark):
    star = warehouse(spark, "/root/testdata/sf0.001")
    plan = kpis.kpi_by_region(kpis.sliced(star, years=[1996]))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters") and "19960000" in line]
    assert pushed and "GreaterThanOrEqual(date_id,19960000)" in pushed[0]


def test_single_file_only_below_a_size(spark, tmp_dir):
    df = spark.range(0, 1000, 1, 4)
    few = write_csv(df, f"{tmp_dir}/few", single_file=True)
    many = write_csv(df, f"{tmp_dir}/many", single_file=True, rows=SINGLE_FILE_ROWS + 1)
    count = lambda d: len([f for f in os.listdir(d) if f.endswith(".csv")])
    assert (count(few), count(many)) == (1, 4)


def test_unlisted_category_fails(spark):
    from stockyard.operators.variance import monthly_category_spend

    star = warehouse(spark, "/root/testdata/sf0.001")
    with pytest.raises(Exception, match="category without a column"):
        monthly_category_spend(star, ["Hardware"]).collect()
