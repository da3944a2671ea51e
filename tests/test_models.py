"""Model forecast, rank refinement, observed feed faults, grouping sets, found categories."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockyard.operators import clean, curve, kpis, profile, variance
from stockyard.operators.forecast import daily_series, forecast_seasonal
from stockyard.operators.quantiles import exact_quantiles
from stockyard.operators.refine import bucket_counts, quantiles
from stockyard.plans import runs
from stockyard.plans import warehouse as W
from stockyard.plans.warehouse import warehouse

START = dt.date(2020, 1, 1)


def shape(day, grow=True):
    """A slope that changes after two years, a yearly and a weekly curve whose heights grow with the trend."""
    trend = 200 + 0.3 * day - max(0, day - 730) * 0.5
    season = 0.25 * math.sin(2 * math.pi * day / 365.25) + 0.1 * math.cos(4 * math.pi * day / 365.25) + 0.15 * math.sin(2 * math.pi * day / 7)
    return trend * (1 + season) if grow else trend + 100 * season


def demand(days, seed=0, grow=True):
    rng = np.random.default_rng(seed)
    return [(START + dt.timedelta(days=d), float(round(shape(d, grow) + rng.normal(0, 5)))) for d in range(days) if d % 11]


@pytest.mark.parametrize("grow", [True, False])
def test_model_beats_the_seasonal_form_on_days_it_has_not_seen(spark, grow):
    days = 1300
    daily = spark.createDataFrame(demand(days, grow=grow), "ds date, y double")
    errors = {}
    for name, fn in (("model", curve.forecast_model), ("seasonal", forecast_seasonal)):
        rows = {r.date: r for r in fn(daily).collect()}
        ahead = [START + dt.timedelta(days=days + k) for k in range(90)]
        assert all(d in rows for d in ahead) and len(rows) == daily.count() + 90
        errors[name] = float(np.mean([abs(rows[d].forecast_qty - shape((d - START).days, grow)) for d in ahead]))
    assert errors["model"] < 0.5 * errors["seasonal"]
    assert errors["model"] < 0.12 * np.mean([shape(d, grow) for d in range(days, days + 90)])


def features(day, first, last, height=None, c=curve.Curve()):
    unit = curve.FEATURE_UNIT
    whole = lambda v: math.floor(v * unit + 0.5)
    x, t = float((day - dt.date(1970, 1, 1)).days), float((day - first).days) / max((last - first).days, 1)
    ends = [(k + 1) / (c.knots + 1) * c.knot_share for k in range(c.knots)]
    waves = [fn(x * a) for a in curve.wave_angles(c) for fn in (math.sin, math.cos)]
    return [unit, whole(t), *[whole(max(t - e, 0.0)) for e in ends], *map(whole, waves), *[whole(w * (t if height is None else height)) for w in waves]]


def test_gram_and_fit_against_numpy(spark):
    """Two series of unlike length, with gaps and null values: Gram matrices exact, forecasts equal to a whole solve."""
    series = {"a": demand(700, 1), "b": demand(40, 2), None: demand(1, 3) + [(START, 7.0)], "z": [(START + dt.timedelta(days=k), 0.0) for k in range(20)]}
    rows = [(k, d, y) for k, days in series.items() for d, y in days] + [("a", START + dt.timedelta(days=5000), None), ("n", START, None)]
    daily = spark.createDataFrame(rows, "k string, ds date, y double").repartition(3)
    c = curve.Curve()
    cells = {(r.k, r.held, r.i, r.j): int(r.total) for r in curve.gram(daily, ["k"]).collect()}
    got = {}
    for r in curve.forecast_model(daily, ["k"]).collect():
        got.setdefault(r.k, {})[r.date] = r
    assert set(got) == set(series)
    for key, days in series.items():
        first, last = min(d for d, _ in days), max(d for d, _ in days)
        long = (last - first).days >= 3 * c.horizon

        def fit(height):
            folds = {False: [], True: []}
            for d, y in days:
                folds[long and (last - d).days < c.horizon].append((*features(d, first, last, height(d)), math.floor(y * curve.VALUE_UNIT + 0.5)))
            whole, grams = {}, []
            for held in (False, True):
                m = np.array(folds[held], object).reshape(-1, c.size + 1)
                whole[held] = m.T.dot(m) if len(m) else None
                scale = np.array([curve.FEATURE_UNIT] * c.size + [curve.VALUE_UNIT], float)
                grams.append((whole[held] if len(m) else np.zeros((c.size + 1, c.size + 1))).astype(float) / np.outer(scale, scale))
            return whole, *curve.solve(*grams, c)

        whole, b, _ = fit(lambda d: None)
        for held, g in whole.items():
            if g is not None:
                assert all(cells[key, held, i, j] == g[i, j] for i in range(c.size + 1) for j in range(i, c.size + 1))
        assert long == any(k == key and held for k, held, *_ in cells)
        trend = lambda d: float(np.dot(np.array(features(d, first, last)[: c.trend_size], float) / curve.FEATURE_UNIT, b[: c.trend_size]))
        mean = float(np.mean([trend(d) for d, _ in days]))
        height = lambda d: min(max(trend(d) / mean, -curve.MOST_HEIGHT), curve.MOST_HEIGHT) if mean > 0 else 0.0
        _, b2, sd = fit(height)
        ahead = [last + dt.timedelta(days=k) for k in range(1, c.horizon + 1)]
        assert sorted(got[key]) == sorted({d for d, _ in days} | set(ahead))
        for d in ahead[::17] + [first, last]:
            want = float(np.dot(np.array(features(d, first, last, height(d)), float) / curve.FEATURE_UNIT, b2))
            assert abs(got[key][d].forecast_qty - max(want, 0)) <= 0.51
            assert abs(got[key][d].upper_bound - (want + c.z * sd)) <= 0.51
            assert got[key][d].lower_bound >= 0


def test_ridge_solves_the_normal_equations():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3
    m = np.column_stack([np.ones(200), x, y])
    b = curve._ridge(m.T @ m, np.zeros(4))
    assert np.allclose(b, [3, 1, -2, 0.5]) and curve._error(m.T @ m, b) < 1e-9
    assert np.abs(curve._ridge(m.T @ m, np.array([0, 1e3, 1e3, 1e3]))[1:]).max() < 0.01


# Rank refinement.


def test_refined_quantiles_equal_both_other_ways_to_the_last_bit(spark):
    rng = np.random.default_rng(0)
    n = 5000
    cols = {
        "few": rng.integers(-3, 4, n), "wide": rng.integers(-(2**62), 2**62, n), "skew": (rng.pareto(0.6, n) * 100).astype(np.int64),
        "one": np.full(n, 7), "ends": np.where(np.arange(n) % 2, 2**63 - 1, -(2**63)),
    }
    df = spark.createDataFrame([tuple(int(v[k]) for v in cols.values()) for k in range(n)], ", ".join(f"{c} long" for c in cols)).repartition(5)
    named, probs = {c: F.col(c) for c in cols if c != "ends"}, [0.0, 0.1, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    want = {r[0]: list(r[1:]) for r in exact_quantiles(df, named, probs).collect()}
    for bits in (1, 5, 12):
        assert quantiles(df, named, probs, bits=bits) == want
    ends = quantiles(df, {"ends": F.col("ends")}, [0.0, 0.2, 0.9, 1.0])["ends"]
    assert ends == [-float(2**63), -float(2**63), float(2**63), float(2**63)]


def test_refinement_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (None, 3)], "a long, b long")
    assert quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.5]) == {"a": [None], "b": [2.0]}
    assert quantiles(df.where("false"), {"a": F.col("a")}, [0.5]) == {"a": [None]}


def test_refinement_shuffles_counts_only(spark):
    """However many distinct values: at most buckets x tasks rows enter the exchange."""
    df = spark.range(0, 400_000, 1, 4).select((F.col("id") * 7919 % 400_009).alias("v"))
    counted = bucket_counts(df, {"v": F.col("v")}, {"v": 9}, {})
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(column_index")
    counted.collect()
    stages, todo = [], [counted._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(k) for k in range(node.children().size())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName() == "Exchange":
            stages.append(node.metrics().apply("shuffleRecordsWritten").value())
    assert stages and 0 < max(stages) <= 4 * 1000


def test_profile_reads_three_times_at_most(spark, monkeypatch):
    calls = []
    real = profile.quantiles
    monkeypatch.setattr(profile, "quantiles", lambda *a, **k: calls.append(a[3]) or real(*a, **k))
    star = warehouse(spark, SF_SMALL)
    out = {r.column_name: r for r in profile.profile_orders(star.raw_orders).collect()}
    assert len(calls) == 1 and calls[0]["total_cost"].n == out["total_cost"]["count"]


# Feed faults.

HEADER = "order_id,order_date,product_name,supplier_name,region,quantity_ordered,unit_cost,lead_time_days,actual_delivery,is_delayed,warehouse_stock,total_cost,delay_days,actual_delivery_days"
LINES = [
    "ORD-1,2022-01-09 00:00:00,Camera,TechCorp,North,7.0,100.0,7,,True,5,999.99,3,10",
    "ORD-2,2022-01-02 00:00:00,Camera,TechCorp,North,oops,1.0,3,,False,0,1.0,0,3",
    "ORD-4,not a date,Phone,TechCorp,South,1,2.345,x,,False,0,2.345,0,3",
    "ORD-5,2022-01-05 00:00:00,Phone,TechCorp",
]


def test_build_counts_the_faults_of_its_feed(spark, tmp_dir, monkeypatch):
    path, root = f"{tmp_dir}/orders.csv", f"{tmp_dir}/wh"
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *LINES]) + "\n")
    real = W.clean_orders

    def and_then_no_feed(raw, **kw):  # a second scan of the feed would fail
        os.rename(path, path + ".gone")
        return real(raw, **kw)

    monkeypatch.setattr(W, "clean_orders", and_then_no_feed)
    star = runs.build_from_csv(spark, path, root)
    assert {c: n for c, n in star.faults.items() if n} == {"quantity_ordered": 1, "lead_time_days": 1, "order_date": 1, "*": 1}
    assert W.open_warehouse(spark, root).faults == star.faults
    os.rename(path + ".gone", path)
    from stockyard.sources.files import read_raw_orders_text

    assert star.faults == {r.column_name: r.bad_cells for r in clean.bad_cells(read_raw_orders_text(spark, path)).collect()}


# One scan, found categories.


def leaves(df):
    it = df._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().iterator()
    while it.hasNext():
        yield it.next().toString()


def test_targets_scan_the_fact_once(spark):
    scans = [x for x in leaves(kpis.kpi_targets(warehouse(spark, SF_SMALL))) if "lead_time_days#" in x]
    assert len(scans) == 1


def test_targets_leave_out_facts_without_a_product_or_supplier(spark):
    from dataclasses import replace

    star = warehouse(spark, SF_SMALL)
    lost = star.fact_orders.withColumn("product_id", F.when(F.col("product_id") != 1, F.col("product_id")))
    lost = lost.withColumn("supplier_id", F.when(F.col("supplier_id") > 2, F.col("supplier_id")))
    star = replace(star, fact_orders=lost)
    from stockyard.operators import inventory, risk

    got = {r.metric: r.value for r in kpis.kpi_targets(star).collect()}
    assert got["max_supplier_risk_score"] == risk.supplier_risk(star).agg(F.max("risk_score")).first()[0]
    turnover = inventory.inventory_kpis(star).agg(F.avg("inventory_turnover")).first()[0]
    assert abs(got["avg_inventory_turnover"] - turnover) <= 0.005
    whole = kpis.executive_kpis(star).first()
    assert (got["on_time_rate_pct"], got["avg_lead_time_days"], got["critical_stock_items"]) == (
        whole.on_time_rate_pct, whole.avg_lead_time_days, whole.critical_stock_items)


def test_pivot_finds_new_categories(spark):
    from dataclasses import replace

    star = warehouse(spark, SF_SMALL)
    changed = F.when(F.col("product_id") == 1, F.lit("Brand new")).when(F.col("product_id") == 2, F.lit(None)).otherwise(F.col("category"))
    star = replace(star, dim_product=star.dim_product.withColumn("category", changed))
    wide = variance.monthly_category_spend(star)
    assert "Brand new" in wide.columns and wide.columns[-1] == variance.NO_CATEGORY
    long = variance.cost_variance(star).groupBy("month", "category").agg(F.sum("planned_spend").alias("s")).collect()
    got = {r.month: r for r in wide.collect()}
    for r in long:
        assert got[r.month][r.category or variance.NO_CATEGORY] == r.s
    with pytest.raises(ValueError, match="more than 2"):
        variance.found_categories(star, most=2)


def test_series_of_the_warehouse_are_forecast(spark):
    star = warehouse(spark, SF_SMALL)
    rows = curve.forecast_model(daily_series(star, ["region_name"]), ["region_name"])
    assert rows.select("region_name").distinct().count() == 5
    assert rows.where("forecast_qty is null or lower_bound < 0").count() == 0
