"""Daily demand and 90-day forecasts, for one series or many at once.

Daily series are aggregates: at most one row per calendar day per series,
so a series never grows with the order volume.  Windows are partitioned by
the series keys; with no keys the one series spans the days of the date
dimension (a bound known from the calendar, not from the data volume).
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip, pd_round
from ..plans.joins import lookup_join
from ..session import broadcast_max_rows
from .measures import partial_measures

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

# Horizon (days), rolling window (observations), band (+-15 %),
# and the normal quantile of an 80 % band for the seasonal model.
HORIZON = 90
WINDOW = 30
BAND = 0.15
Z80 = 1.2816


def daily_demand(star: StarSchema, keys: Sequence[str] = ()) -> DataFrame:
    """(ds, y) per calendar day, in date order (the report)."""
    return daily_series(star, keys).orderBy(*keys, "ds")


# Series keys a daily series can be split by: attribute -> (foreign key, dimension).
SERIES_ATTRIBUTES = {
    "product_name": ("product_id", "dim_product"),
    "category": ("product_id", "dim_product"),
    "supplier_name": ("supplier_id", "dim_supplier"),
    "reliability": ("supplier_id", "dim_supplier"),
    "region_name": ("region_id", "dim_region"),
    "zone": ("region_id", "dim_region"),
}


def daily_series(star: StarSchema, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., ds, y): units ordered per calendar day, optionally per series
    key (any attribute in ``SERIES_ATTRIBUTES``).

    Attributes of a dimension that is proven small enough to broadcast are
    attached first, so the fact is aggregated by (day, attributes); a larger
    dimension joins after the fact is aggregated by its foreign key.  Both give
    the same series.  Unordered: the forecasts impose their own order."""
    keys = list(keys)
    unknown = [k for k in keys if k not in SERIES_ATTRIBUTES]
    if unknown:
        raise ValueError(f"unknown series keys {unknown}; choose from {sorted(SERIES_ATTRIBUTES)}")
    dims: dict[str, tuple[str, list[str]]] = {}
    for k in keys:
        fk, dim = SERIES_ATTRIBUTES[k]
        dims.setdefault(dim, (fk, []))[1].append(k)
    fact, group, late = star.fact_orders, ["date_id"], []
    limit = broadcast_max_rows(fact.sparkSession)
    for dim, (fk, attrs) in dims.items():
        if (star.dim_rows(dim) or limit + 1) <= limit:
            fact = fact.join(F.broadcast(star.table(dim).select(fk, *attrs)), fk)
            group += attrs
        else:
            group.append(fk)
            late.append((dim, fk, attrs))
    j = partial_measures(fact, group).select(*group, "sum_qty")
    j = lookup_join(j, star.dim_date.select("date_id", "full_date"), "date_id", "inner", star.dim_rows("dim_date"))
    for dim, fk, attrs in late:
        j = lookup_join(j, star.table(dim).select(fk, *attrs), fk, "inner", star.dim_rows(dim))
    return (
        j.groupBy(*keys, "full_date")
        .agg(F.sum("sum_qty").cast("double").alias("y"))
        .select(*keys, F.col("full_date").alias("ds"), "y")
    )


def _future_dates(last_col: str, horizon: int):
    return F.explode(F.sequence(F.date_add(F.col(last_col), 1), F.date_add(F.col(last_col), horizon)))


def forecast_rolling(
    daily: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = HORIZON,
    window: int = WINDOW,
    band: float = BAND,
    with_segment: bool = False,
) -> DataFrame:
    """History with a +-band, then ``horizon`` days at the mean of the last
    ``window`` observations (rows, not days; null if fewer exist).

    The last observations come from a top-k (one series) or a per-series
    ``row_number`` filter that Spark turns into a partial window-group limit,
    so no task sorts a whole series."""
    keys = list(keys)
    lo, hi = F.lit(1.0 - band), F.lit(1.0 + band)
    hist = daily.select(
        *keys,
        F.col("ds").alias("date"),
        F.col("y").alias("forecast_qty"),
        (F.col("y") * lo).alias("lower_bound"),
        (F.col("y") * hi).alias("upper_bound"),
    )
    if keys:
        recent = Window.partitionBy(*keys).orderBy(F.desc("ds"))
        last = daily.withColumn("_rn", F.row_number().over(recent)).where(F.col("_rn") <= window)
    else:
        last = daily.orderBy(F.desc("ds")).limit(window)
    stats = last.groupBy(*keys).agg(
        F.max("ds").alias("_last"), F.count("y").alias("_n"), F.avg("y").alias("_mean")
    )
    mean = F.when(F.col("_n") == window, F.col("_mean"))
    fut = stats.select(*keys, _future_dates("_last", horizon).alias("date"), mean.alias("forecast_qty")).select(
        *keys,
        "date",
        "forecast_qty",
        (F.col("forecast_qty") * lo).alias("lower_bound"),
        (F.col("forecast_qty") * hi).alias("upper_bound"),
    )
    if with_segment:
        hist = hist.withColumn("segment", F.lit("actual"))
        fut = fut.withColumn("segment", F.lit("forecast"))
    return hist.unionByName(fut)


def forecast_segments(daily: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """Forecast split at the last observed date into actual / forecast rows,
    rows with any missing value dropped (what the chart draws)."""
    return forecast_rolling(daily, keys, with_segment=True, **kw).na.drop()


def forecast_seasonal(
    daily: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = HORIZON,
    z: float = Z80,
) -> DataFrame:
    """Trend x weekday index x month index, fitted on history and projected.

    Per series: least-squares line of y on the day number; ratio = y / trend
    (trend <= 0 -> null); weekday index = mean ratio per weekday; month index
    = mean of ratio / weekday index per calendar month; a missing index is 1.
    Band = +- z * sample sd of the residuals.  forecast and lower bound are
    clipped at 0; all three rounded to whole units.  Future rows are unioned
    in before the windows so they pick up their weekday and month indices.
    """
    keys = list(keys)
    series = Window.partitionBy(*keys)
    ends = daily.groupBy(*keys).agg(F.max("ds").alias("_last"))
    future = ends.select(*keys, _future_dates("_last", horizon).alias("ds"), F.lit(None).cast("double").alias("y"))
    rows = daily.select(*keys, "ds", "y").unionByName(future)
    x = F.datediff(F.col("ds"), F.lit("1970-01-01").cast("date")).cast("double")
    rows = rows.withColumns({"_x": x, "_dow": F.dayofweek("ds"), "_month": F.month("ds")})
    trend = F.regr_intercept("y", "_x").over(series) + F.regr_slope("y", "_x").over(series) * F.col("_x")
    rows = rows.withColumn("_trend", trend)
    rows = rows.withColumn("_ratio", F.col("y") / F.when(F.col("_trend") > 0, F.col("_trend")))
    rows = rows.withColumn("_wi", F.avg("_ratio").over(Window.partitionBy(*keys, "_dow")))
    rows = rows.withColumn(
        "_mi", F.avg(F.col("_ratio") / F.nullif(F.col("_wi"), F.lit(0.0))).over(Window.partitionBy(*keys, "_month"))
    )
    yhat = F.col("_trend") * F.coalesce(F.col("_wi"), F.lit(1.0)) * F.coalesce(F.col("_mi"), F.lit(1.0))
    rows = rows.withColumn("_yhat", yhat)
    rows = rows.withColumn("_sd", F.stddev_samp(F.col("y") - F.col("_yhat")).over(series))
    band = F.lit(float(z)) * F.col("_sd")
    return rows.select(
        *keys,
        F.col("ds").alias("date"),
        pd_round(clip(F.col("_yhat"), 0), 0).alias("forecast_qty"),
        pd_round(clip(F.col("_yhat") - band, 0), 0).alias("lower_bound"),
        pd_round(F.col("_yhat") + band, 0).alias("upper_bound"),
    )


def forecast_tail(forecast: DataFrame, days: int = HORIZON, n: int = 10) -> DataFrame:
    """Last ``n`` rows of a saved forecast within ``days`` of its last date.

    A top-k by date bounds the rows before the window that finds the last date."""
    top = forecast.orderBy(F.desc("date")).limit(n)
    last = F.max("date").over(Window.partitionBy())
    return (
        top.withColumn("_last", last)
        .where(F.col("date") > F.date_sub(F.col("_last"), days))
        .select("date", "forecast_qty", "lower_bound", "upper_bound")
        .orderBy("date")
    )
