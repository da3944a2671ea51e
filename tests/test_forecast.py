"""Forecast operators on literal daily series (29 observations, date gaps, several series)."""

import datetime as dt

from pyspark.sql import functions as F

from stockyard.operators.forecast import forecast_rolling, forecast_seasonal, forecast_segments, forecast_tail

D = dt.date


def series(spark, n, gap=1, key=None, start=D(2023, 1, 1)):
    rows = [((key,) if key else ()) + (start + dt.timedelta(days=i * gap), float(100 + (i * 37) % 50)) for i in range(n)]
    schema = ("k string, " if key else "") + "ds date, y double"
    return spark.createDataFrame(rows, schema)


def test_rolling_uses_last_30_rows_not_days(spark):
    s = series(spark, 60, gap=2)  # gaps: 30 rows span 60 days
    out = forecast_rolling(s).collect()
    ys = [100 + (i * 37) % 50 for i in range(60)]
    mean = sum(ys[-30:]) / 30
    fut = [r for r in out if r.date > D(2023, 1, 1) + dt.timedelta(days=118)]
    assert len(out) == 150 and len(fut) == 90
    assert all(r.forecast_qty == mean for r in fut)
    assert fut[0].date == D(2023, 1, 1) + dt.timedelta(days=119)
    assert fut[0].lower_bound == mean * 0.85 and fut[0].upper_bound == mean * 1.15
    hist = [r for r in out if r.date <= D(2023, 1, 1) + dt.timedelta(days=118)]
    assert hist[0].lower_bound == ys[0] * 0.85


def test_rolling_with_29_observations_is_null(spark):
    out = forecast_rolling(series(spark, 29)).where(F.col("date") > D(2023, 1, 29)).collect()
    assert len(out) == 90 and all(r.forecast_qty is None for r in out)
    # the chart view drops them
    assert forecast_segments(series(spark, 29)).where("segment = 'forecast'").count() == 0


def test_rolling_per_series(spark):
    s = series(spark, 40, key="a").unionByName(series(spark, 10, key="b"))
    out = forecast_rolling(s, ["k"]).where(F.col("date") > D(2023, 2, 9)).groupBy("k").agg(
        F.count("*").alias("n"), F.max("forecast_qty").alias("m")).collect()
    got = {r.k: r for r in out}
    assert got["a"].n == 90 and got["b"].m is None


def test_seasonal_shape_and_bounds(spark):
    out = forecast_seasonal(series(spark, 400)).collect()
    assert len(out) == 490
    for r in out:
        assert r.forecast_qty >= 0 and r.lower_bound >= 0
        assert r.lower_bound <= r.forecast_qty <= r.upper_bound
        assert r.forecast_qty == round(r.forecast_qty)


def test_tail_last_ten(spark):
    fc = forecast_rolling(series(spark, 40))
    out = forecast_tail(fc).collect()
    assert len(out) == 10 and out[-1].date == D(2023, 1, 1) + dt.timedelta(days=129)


def test_daily_series_by_any_dimension_attribute(spark):
    from conftest import SF_SMALL
    from stockyard.operators.forecast import daily_series
    from stockyard.plans.warehouse import warehouse

    star = warehouse(spark, SF_SMALL)
    total = {r.ds: r.y for r in daily_series(star).collect()}
    by = daily_series(star, ["region_name", "reliability"])
    assert set(by.columns) == {"region_name", "reliability", "ds", "y"}
    sums = {r.ds: r.s for r in by.groupBy("ds").agg(F.sum("y").alias("s")).collect()}
    assert sums == total
    per_zone = forecast_rolling(daily_series(star, ["zone"]), ["zone"])
    assert per_zone.select("zone").distinct().count() == 5  # four zones and the unmapped region (null)
