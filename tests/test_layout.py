"""The written warehouse: year partitions, safe replacement, reopening, loading single years, planner sizes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockyard.operators import kpis
from stockyard.plans import warehouse as W
from stockyard.plans.joins import TableSize, checked_broadcast, measure
from stockyard.sources import versions
from stockyard.sources.files import create_star_tables, load_star_schema, read_table_at, write_table

D = dt.date
RAW = "order_id string, order_date date, product_name string, supplier_name string, region string, quantity_ordered int, unit_cost double, lead_time_days int, warehouse_stock int, delay_days int, total_cost double, actual_delivery_days int, is_delayed boolean"
CLEAN = "order_id string, order_date date, product_name string, supplier_name string, region string, quantity_ordered int, unit_cost double, total_cost double, lead_time_days int, actual_delivery_days int, delay_days int, is_delayed int, warehouse_stock int"


def order(k, date, product="Laptop", supplier="Acme", region="North", cost=10.0, delayed=0):
    return (f"O{k}", date, product, supplier, region, 2, cost, 2 * cost, 5, 5 + delayed, delayed, int(delayed > 0), 50)


def raw(spark, orders):
    rows = [(o[0], o[1], o[2], o[3], o[4], o[5], o[6], o[8], o[12], o[10], o[7], o[9], bool(o[11])) for o in orders]
    return spark.createDataFrame(rows, RAW)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def leaves(df):
    it = df._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().iterator()
    while it.hasNext():
        yield it.next()


def test_year_slice_reads_only_its_partitions(spark):
    star = W.warehouse(spark, SF_SMALL)
    years = {r[0] for r in star.fact_by_year.select("order_year").distinct().collect()}
    assert len(years) > 2
    sliced = kpis.kpi_by_region(kpis.sliced(star, years=[1996]))
    scan = [x.toString() for x in leaves(sliced) if "lead_time_days" in x.toString() or "order_id" in x.toString()][0]
    assert "PartitionFilters" in scan and "order_year" in scan.split("PartitionFilters: [")[1].split("]")[0]
    read = kpis.sliced(star, years=[1996]).fact_orders
    assert read.columns == star.fact_orders.columns
    read.collect()
    metrics = read._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()  # no exchange: no adaptive plan
    assert metrics.apply("numPartitions").value() == 1 and metrics.apply("numFiles").value() > 0
    want = star.fact_orders.where("date_id div 10000 = 1996")
    assert read.exceptAll(want).count() == 0 and read.count() == want.count() > 0


def first_orders():
    out = [order(k, D(2021 + k % 3, 1 + k % 12, 1 + k % 28), ["Laptop", "Phone"][k % 2], ["Acme", "Zeta"][k % 2]) for k in range(60)]
    return out + [order(900, None), order(901, D(2021, 5, 5), supplier=None)]


def test_new_year_replaces_only_its_own_files(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    W.build_warehouse(spark, raw(spark, first_orders()), root)
    before = W.open_warehouse(spark, root)
    fact_path = versions.current(spark, root).tables["fact_orders"]
    old_files = files(fact_path)
    old_ids = {r.product_name: r.product_id for r in before.dim_product.collect()}
    assert before.rows["fact_orders"] == 62 and before.rows["dim_product"] == 2
    # 2022 again, with a new product and supplier that sort before the known ones, and only late deliveries.
    new = [order(5000 + k, D(2022, 2, 1 + k % 20), ["Camera", "Phone"][k % 2], ["Aardvark", "Zeta"][k % 2], "East", 99.0, 3) for k in range(40)]
    star = W.replace_years(spark, root, spark.createDataFrame(new, CLEAN))
    new_files = files(fact_path)
    same = lambda fs: {f: t for f, t in fs.items() if "order_year=2022" not in f}
    assert same(new_files) == same(old_files) and len(same(old_files)) > 2
    assert not set(f for f in new_files if "=2022" in f) & set(old_files)
    again = W.open_warehouse(spark, root)
    for s in (star, again):
        rows = s.fact_orders.collect()
        kept = [o for o in first_orders() if o[1] is None or o[1].year != 2022]
        assert sorted(r.order_id for r in rows) == sorted([o[0] for o in kept] + [o[0] for o in new])
        ids = {r.product_name: r.product_id for r in s.dim_product.collect()}
        assert {n: ids[n] for n in old_ids} == old_ids and ids["Camera"] == 3
        names = {v: k for k, v in ids.items()}
        assert {names[r.product_id] for r in rows if r.order_id >= "O5000" and len(r.order_id) == 5} == {"Camera", "Phone"}
        reliability = {r.supplier_name: r.reliability for r in s.dim_supplier.collect()}
        late = {n: [o[11] for o in kept + new if o[3] == n] for n in ("Acme", "Zeta", "Aardvark")}
        assert reliability == {n: "High" if sum(v) / len(v) <= 0.15 else "Medium" if sum(v) / len(v) <= 0.3 else "Low" for n, v in late.items()}
        phone = [o[6] for o in kept + new if o[2] == "Phone"]
        assert {r.product_name: r.unit_cost for r in s.dim_product.collect()}["Phone"] == round(sum(phone) / len(phone), 2)
        assert {r.full_date for r in s.dim_date.collect()} == {o[1] for o in kept + new if o[1]}
        assert s.rows["fact_orders"] == len(rows) and s.rows["dim_product"] == 3
        assert kpis.executive_kpis(s).first().total_orders == len(rows)
    names = create_star_tables(spark, root, prefix="t_years_")
    assert spark.table("t_years_fact_orders").where("order_year = 2022").count() == 40 and len(names) == 5


def test_failed_replace_leaves_the_old_rows(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    old = write_table(spark.range(100), path)
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        write_table(bad, path)
    assert read_table_at(spark, path).count() == 100 == old.count()
    assert [d for d in os.listdir(path) if d.startswith("v-")] == [os.path.basename(versions.current(spark, path).tables[""])]
    for k in range(4):
        write_table(spark.range(10 + k), path)
    assert read_table_at(spark, path).count() == 13
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) == versions.KEEP  # older versions are cleaned up


def test_failed_star_load_leaves_all_old_tables(spark, tmp_dir):
    root = f"{tmp_dir}/star"
    star = W.build_star_schema(spark.createDataFrame(first_orders(), CLEAN))
    tables = {n: star.table(n) for n in ("dim_date", "dim_product", "dim_supplier", "dim_region", "fact_orders")}
    load_star_schema(tables, root)
    broken = tables | {"fact_orders": tables["fact_orders"].withColumn("order_id", F.raise_error(F.lit("midway")).cast("string"))}
    with pytest.raises(Exception, match="midway"):
        load_star_schema(broken | {"dim_product": tables["dim_product"].limit(0)}, root)
    create_star_tables(spark, root, prefix="t_load_")
    assert spark.table("t_load_dim_product").count() == 2 and spark.table("t_load_fact_orders").count() == 62
    load_star_schema(tables | {"dim_product": tables["dim_product"].limit(1)}, root)
    create_star_tables(spark, root, prefix="t_load_")  # points the tables at the new version
    assert spark.table("t_load_dim_product").count() == 1
    shown = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED t_load_dim_supplier supplier_name").collect()}
    assert shown["distinct_count"] == "2" and shown["max_col_len"] == "4"


def test_failed_build_leaves_the_published_warehouse(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    W.build_warehouse(spark, raw(spark, first_orders()), root)
    bad = raw(spark, first_orders()).withColumn("quantity_ordered", F.raise_error(F.lit("midway")).cast("int"))
    with pytest.raises(Exception, match="midway"):
        W.build_warehouse(spark, bad, root)
    assert W.open_warehouse(spark, root).fact_orders.count() == 62
    with pytest.raises(FileNotFoundError):
        W.open_warehouse(spark, f"{tmp_dir}/nothing")


def test_wide_dimension_is_not_broadcast(spark):
    """The bytes a join brings along decide, not the rows alone."""
    rows = 1_000_000
    narrow = spark.range(rows).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    wide = narrow.withColumn("name", F.repeat(F.lit("wide "), 100))
    hinted = lambda df, n: "Broadcast" in df.join(checked_broadcast(n, measure(n)), "k")._jdf.queryExecution().optimizedPlan().toString() or "broadcast" in df.join(checked_broadcast(n, measure(n)), "k")._jdf.queryExecution().optimizedPlan().toString()
    left = spark.range(10).select(F.col("id").cast("int").alias("k"))
    assert hinted(left, narrow) and not hinted(left, wide)
    assert hinted(left, wide.select("k"))  # only the columns that join count
    size = measure(wide)
    assert size == rows and size.bytes_of(["k"]) == 24 * rows and size.bytes_of(["name"]) == (16 + 8 + 500) * rows
    assert TableSize(5).bytes_of(["k"]) is None
