"""Scalar helpers: both rounding rules, clip, safe division, bins, calendar, text."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.functions import calendar as cal
from stockyard.functions.numeric import bin_right, clip, pd_round, safe_div, sql_round, whole_number
from stockyard.functions.text import clean_name, label_from_key, strip_ws, title_case
from stockyard.plans.text_feed import text_feed
from stockyard.schemas import RAW_ORDERS


def one(spark, expr, value=None, dtype="double"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_sql_round_half_away_from_zero(spark):
    assert one(spark, lambda c: sql_round(c, 2), 1.005) == 1.01
    assert one(spark, lambda c: sql_round(c, 0), 2.5) == 3.0
    assert one(spark, lambda c: sql_round(c, 0), -2.5) == -3.0
    assert one(spark, lambda c: sql_round(c, 1), None) is None


def test_pd_round_matches_numpy(spark):
    rng = np.random.default_rng(7)
    xs = list(rng.uniform(-1000, 1000, 3000).round(4)) + [i / 16 for i in range(-40, 40)] + [2.675, 0.125, 1.005]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.select("x", pd_round(F.col("x"), 0).alias("r0"), pd_round(F.col("x"), 2).alias("r2"),
                    pd_round(F.col("x"), 3).alias("r3")).collect()
    for r in got:
        assert r.r0 == np.round(r.x, 0)
        assert r.r2 == np.round(r.x, 2)
        assert r.r3 == np.round(r.x, 3)


def test_on_time_rate_half_even_cases(spark):
    # 13/16 delayed-free share -> 81.2 (half to even), 9/16 -> 56.2
    df = spark.createDataFrame([(3, 16), (7, 16), (3, 17)], "d long, t long")
    got = [r.v for r in df.select((pd_round(F.lit(1) - F.col("d") / F.col("t"), 3) * 100).alias("v")).collect()]
    assert got[0] == 81.2 and got[1] == 56.2
    assert got[2] == np.round(1 - 3 / 17, 3) * 100


def test_clip_keeps_null(spark):
    assert one(spark, lambda c: clip(c, 0, 100), 120.0) == 100.0
    assert one(spark, lambda c: clip(c, 0, 100), -3.0) == 0.0
    assert one(spark, lambda c: clip(c, 0, 100), None) is None


def test_safe_div_zero_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0)], "a double, b double")
    assert [r.v for r in df.select(safe_div(F.col("a"), F.col("b")).alias("v")).collect()] == [None, 2.5]


@pytest.mark.parametrize(
    "x,label",
    [(100.0, "CRITICAL"), (100.5, "LOW"), (300.0, "LOW"), (300.01, "ADEQUATE"), (-1.0, None), (0.0, "CRITICAL"), (100000.0, None)],
)
def test_bins_are_right_closed(spark, x, label):
    edges, labels = [-1, 100, 300, 99999], ["CRITICAL", "LOW", "ADEQUATE"]
    assert one(spark, lambda c: bin_right(c, edges, labels), x) == label


def test_week_is_monday_based(spark):
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(0, 800, 3)] + [dt.date(2021, 1, 3), dt.date(2024, 12, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", cal.week_monday(F.col("d")).alias("w"), cal.date_key(F.col("d")).alias("k"),
                    cal.month_name(F.col("d")).alias("m"), cal.weekday_name(F.col("d")).alias("a"),
                    cal.quarter(F.col("d")).alias("q")).collect()
    for r in got:
        assert r.w == int(r.d.strftime("%W"))
        assert r.k == int(r.d.strftime("%Y%m%d"))
        assert r.m == r.d.strftime("%B") and r.a == r.d.strftime("%A")
        assert r.q == (r.d.month - 1) // 3 + 1
    iso = df.select(cal.iso_text(F.col("d")).alias("t"), "d").first()
    assert iso.t == iso.d.strftime("%Y-%m-%d")


@pytest.mark.parametrize(
    "raw",
    ["  laptop ", "\tTechCorp India\n", "o'neil 3m-x", "MIDDLE EAST", "Supplier#000000001", "a\tb", "x-ray  unit",
     "école été", "\xa0nbsp　", "", "123abc"],
)
def test_names_follow_python_strip_title(spark, raw):
    assert one(spark, clean_name, raw, "string") == raw.strip().title()


def test_strip_and_title_separately(spark):
    assert one(spark, strip_ws, "\x1c a  ", "string") == "a"
    assert one(spark, title_case, "hELLO wORLD", "string") == "Hello World"


def test_metric_labels(spark):
    assert one(spark, label_from_key, "on_time_rate_pct", "string") == "On Time Rate Pct"


def test_exact_quantiles_match_numpy(spark):
    from stockyard.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(3)
    a = rng.integers(0, 50, 5001)
    b = rng.integers(-10**9, 10**9, 777)  # nearly all distinct
    rows = [(int(x), int(b[i % len(b)]) if i < len(b) else None) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    for small_pairs in (1_000_000, 0):  # one aggregation, and the distributed ranking
        cols = {"a": F.col("a"), "b": F.col("b")}
        got = {r.column_name: r for r in exact_quantiles(df, cols, probs, small_pairs=small_pairs).collect()}
        for name, arr in (("a", a), ("b", b)):
            for i, p in enumerate(probs):
                assert got[name][f"q{i}"] == pytest.approx(float(np.quantile(arr, p)), rel=1e-12, abs=1e-9)


def test_whole_numbers_of_all_types_as_by_decimals(spark):
    texts = ["7", " 7 ", "7.0", "7.9", "-7", "+7", "7\x7f", "\x1f7", "1e2", "2147483648", "-2147483648", "99999999999", "", "oops", "\u0667", "7.", "0x1", "00012", None]
    cells = spark.createDataFrame([(t, 6.9999999, 5, 2**40, True) for t in texts] + [(None,) * 5], "t string, d double, i int, l long, b boolean")
    for c in cells.columns:
        by_decimals = F.col(c).try_cast("decimal(38,6)").try_cast("int")
        rows = cells.select(by_decimals.alias("want"), whole_number(F.col(c)).alias("got")).collect()
        assert [r.got for r in rows] == [r.want for r in rows]
    plan = cells.select(whole_number(F.col("i")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan.lower() and "CASE" not in plan  # no decimals where the type holds whole numbers


def test_text_feed_writes_money_as_decimals_do(spark):
    values = [0.0, 0.05, -0.05, 1.0, -1.0, 12.34, -12.345, 99999.999, None, 1e12]
    rows = [(k, v) for k in (1, 4, 35, None) for v in values]
    given = spark.createDataFrame(rows, "_orderkey long, total_cost double")
    raw = given.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_ORDERS.fields if f.name != "total_cost"], "total_cost", "_orderkey")
    cost = F.rint(F.col("given") * 100).cast("long").cast("decimal(20,0)") / 100
    plus = F.when(F.col("_orderkey") % 31 == 4, F.lit(1)).otherwise(F.lit(0))
    got = text_feed(raw.withColumn("given", F.col("total_cost")), keep=["given", "_orderkey"])
    got = got.select("total_cost", (cost + plus).cast("decimal(18,2)").cast("string").alias("want")).collect()
    assert len(got) == len(rows) and [r.total_cost for r in got] == [r.want for r in got]
    plan = text_feed(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan.lower()
