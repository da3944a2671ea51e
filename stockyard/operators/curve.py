"""Model forecast: a piecewise-linear trend with yearly and weekly curves, for one series or many.

Every day of a series is a row of whole-number features (see ``_with_features``).  Spark sums the Gram matrix
of these rows, exactly, as one row per series, fold and pair of features; a series then needs one
small ridge solve over its Gram matrix (numpy in a task, no larger than the feature count squared).
The penalties are chosen from the same sums: the last ``horizon`` days of history are a fold of their own, and
a penalty's error on them follows from their Gram matrix.  The chosen penalty is refitted on all days.

Seasons may be constant or grow with the trend (multiplicative).  A first fit, whose curves may change along a
straight line over time, gives the trend; in the second the curves stand twice, plain and times that trend.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip, pd_round
from ..session import shared_dir
from .forecast import HORIZON, Z80

#: Features and series values are taken to these fractions of one, so that their products sum exactly.
FEATURE_UNIT = 1 << 20
VALUE_UNIT = 1 << 10
#: The trend relative to its mean, as the waves' height, stops here.
MOST_HEIGHT = 8.0


@dataclass(frozen=True)
class Curve:
    """Shape of the model.  Periods are in days; knots lie evenly over the first ``knot_share`` of history."""

    knots: int = 10
    knot_share: float = 0.8
    year: float = 365.25
    year_order: int = 5
    week: float = 7.0
    week_order: int = 3
    horizon: int = HORIZON
    z: float = Z80
    #: Ridge penalties tried, relative to the number of days: of knots, and of curves.
    knot_penalties: tuple[float, ...] = (1e-3, 1e-2, 1e-1, 1.0)
    curve_penalties: tuple[float, ...] = (1e-4, 1e-2, 1.0)

    @property
    def waves(self) -> int:
        return 2 * (self.year_order + self.week_order)

    @property
    def size(self) -> int:
        """Features: one, time, knots, waves, waves times their height."""
        return self.trend_size + 2 * self.waves

    @property
    def trend_size(self) -> int:
        return 2 + self.knots


def _whole(c: Column, unit: int) -> Column:
    return F.floor(c * F.lit(float(unit)) + F.lit(0.5)).cast("long")


def wave_angles(curve: Curve) -> list[float]:
    """Radians a day of each sine and cosine pair: the year's, then the week's."""
    return [2 * math.pi * k / curve.year for k in range(1, curve.year_order + 1)] + [
        2 * math.pi * k / curve.week for k in range(1, curve.week_order + 1)
    ]


def _with_features(rows: DataFrame, keys: Sequence[str], curve: Curve) -> DataFrame:
    """``rows`` (keys, ds, y; y null in days to come) plus _f, the features as whole numbers, and _held.

    The height of the second set of waves is ``_height`` where rows have it, else time (0 to 1 over history).

    _held tells the last ``horizon`` days of a history that is at least three times as long."""
    series = Window.partitionBy(*keys)
    seen = F.when(F.col("y").isNotNull(), F.col("ds"))
    rows = rows.withColumn("_first", F.min(seen).over(series)).withColumn("_last", F.max(seen).over(series))
    span = F.greatest(F.datediff("_last", "_first"), F.lit(1)).cast("double")
    t = F.datediff("ds", "_first").cast("double") / span
    x = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
    ends = F.array(*[F.lit((k + 1) / (curve.knots + 1) * curve.knot_share) for k in range(curve.knots)])
    angles = F.array(*[F.lit(a) for a in wave_angles(curve)])
    height = F.col("_height") if "_height" in rows.columns else F.col("_t")
    rows = rows.withColumn("_t", t).withColumn("_x", x)
    whole = lambda c: _whole(c, FEATURE_UNIT)
    hinges = F.transform(ends, lambda e: whole(F.greatest(F.col("_t") - e, F.lit(0.0))))
    waves = F.flatten(F.transform(angles, lambda a: F.array(F.sin(F.col("_x") * a), F.cos(F.col("_x") * a))))
    growing = F.transform(waves, lambda w: whole(w * height))
    line = F.array(F.lit(FEATURE_UNIT).cast("long"), whole(F.col("_t")))
    long = F.datediff("_last", "_first") >= 3 * curve.horizon
    held = long & (F.datediff("_last", "ds") < curve.horizon)
    return rows.withColumn("_f", F.concat(line, hinges, F.transform(waves, whole), growing)).withColumn("_held", held)


def gram(daily: DataFrame, keys: Sequence[str] = (), curve: Curve = Curve()) -> DataFrame:
    """(keys..., held, i, j, total): the summed products of features i <= j over a series' days, by fold.

    Feature ``curve.size`` is the series value itself; total is in units of FEATURE_UNIT and VALUE_UNIT and is
    exact: it does not depend on the order of the rows.  Null values are skipped."""
    keys = list(keys)
    given = [c for c in ("_height",) if c in daily.columns]
    rows = _with_features(daily.where(F.col("y").isNotNull()).select(*keys, "ds", "y", *given), keys, curve)
    cells = F.concat("_f", F.array(_whole(F.col("y"), VALUE_UNIT)))
    # The windows leave a series in one task; its days are dealt out again before they multiply to pairs.
    parts = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*keys, "ds", F.col("_held").alias("held"), cells.alias("_c")).repartition(parts, *keys, "ds")
    wide = dealt.select(*keys, "held", "_c", F.posexplode("_c").alias("i", "_a"))
    right = F.slice("_c", F.col("i") + 1, F.lit(curve.size + 1))
    pairs = wide.select(*keys, "held", "i", "_a", F.posexplode(right).alias("_k", "_b"))
    pairs = pairs.select(*keys, "held", "i", (F.col("i") + F.col("_k")).alias("j"), "_a", "_b")
    # Features are small enough for whole-number sums; products with the value may not be.
    plain = F.sum(F.when(F.col("j") < curve.size, F.col("_a") * F.col("_b")))
    large = F.sum(F.when(F.col("j") == curve.size, F.col("_a").cast("decimal(19,0)") * F.col("_b").cast("decimal(19,0)")))
    return pairs.groupBy(*keys, "held", "i", "j").agg(F.coalesce(plain.cast("decimal(38,0)"), large).alias("total"))


def _matrices(cells: Sequence, size: int) -> np.ndarray:
    """Two Gram matrices (all days but the held ones, the held ones) from their cells, in plain units."""
    unit = np.full(size + 1, float(FEATURE_UNIT))
    unit[size] = VALUE_UNIT
    out = np.zeros((2, size + 1, size + 1))
    for cell in cells:
        i, j = cell["i"], cell["j"]
        out[int(cell["held"]), i, j] = out[int(cell["held"]), j, i] = float(cell["total"])
    return out / np.outer(unit, unit)


def _ridge(g: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    size = len(penalty)
    return np.linalg.lstsq(g[:size, :size] + np.diag(penalty * g[0, 0]), g[:size, size], rcond=None)[0]


def _error(g: np.ndarray, b: np.ndarray) -> float:
    """Sum of squared residuals of coefficients ``b`` over the days of Gram matrix ``g``."""
    whole = np.append(b, -1.0)
    return max(float(whole @ g @ whole), 0.0)


def solve(fitted: np.ndarray, held: np.ndarray, curve: Curve) -> tuple[np.ndarray, float]:
    """(coefficients, standard deviation of the residuals) of one series from its two Gram matrices."""
    size = curve.size

    def penalty(knot: float, wave: float) -> np.ndarray:
        out = np.full(size, wave)
        out[:2] = 1e-9  # the line itself is free
        out[2 : 2 + curve.knots] = knot
        return out

    grid = [penalty(k, w) for k in curve.knot_penalties for w in curve.curve_penalties]
    best = grid[len(grid) // 2]
    if held[0, 0] > 0 and fitted[0, 0] > 0:
        best = min(grid, key=lambda p: _error(held, _ridge(fitted, p)))
    whole = fitted + held
    b = _ridge(whole, best)
    days = whole[0, 0]
    return b, math.sqrt(_error(whole, b) / (days - 1)) if days > 1 else 0.0


def _solved(days: DataFrame, keys: list[str], curve: Curve) -> DataFrame:
    """(keys..., _b, _sd): coefficients and residual deviation of every series."""
    size = curve.size
    cells = gram(days, keys, curve).select(*keys, F.struct("held", "i", "j", F.col("total").cast("double").alias("total")).alias("_cell"))
    # At most (size + 1) * (size + 2) cells in a series, whatever its length.
    systems = cells.groupBy(*keys).agg(F.collect_list("_cell").alias("_cells"))
    kinds = dict(days.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys) + "_b array<double>, _sd double"

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            solved = [solve(*_matrices(c, size), curve) for c in frame["_cells"]]
            out = frame[keys].copy()
            out["_b"] = [list(map(float, b)) for b, _ in solved]
            out["_sd"] = [sd for _, sd in solved]
            yield out

    return systems.mapInPandas(fit, schema)


def _with_fit(rows: DataFrame, fits: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with their series' _b and _sd, through a window over the series (one fit each, else nulls)."""
    series = Window.partitionBy(*keys)
    both = rows.unionByName(fits, allowMissingColumns=True)
    both = both.withColumn("_b", F.max("_b").over(series)).withColumn("_sd", F.max("_sd").over(series))
    return both.where(F.col("ds").isNotNull())


def _dot(features: Column, coefficients: Column) -> Column:
    cells = F.zip_with(features, coefficients, lambda f, b: f.cast("double") / F.lit(float(FEATURE_UNIT)) * b)
    return F.aggregate(cells, F.lit(0.0), lambda a, v: a + v)


def forecast_model(daily: DataFrame, keys: Sequence[str] = (), curve: Curve = Curve()) -> DataFrame:
    """(keys..., date, forecast_qty, lower_bound, upper_bound): the fitted history and ``horizon`` days after it.

    Band = +- z * standard deviation of the residuals.  Forecast and lower bound are clipped at 0; all
    three are rounded to whole units.  A series has at most one row for each calendar day.  The daily series
    is read several times and is checkpointed first."""
    keys = list(keys)
    shared_dir(daily.sparkSession)
    history = daily.where(F.col("y").isNotNull()).select(*keys, "ds", "y").checkpoint(eager=True)
    ends = history.groupBy(*keys).agg(F.max("ds").alias("_end"))
    after = F.explode(F.sequence(F.date_add("_end", 1), F.date_add("_end", curve.horizon)))
    days = history.unionByName(ends.select(*keys, after.alias("ds"), F.lit(None).cast("double").alias("y")))

    # The trend of the first fit, relative to its mean over history, is the height of the second fit's waves.
    rows = _with_fit(_with_features(days, keys, curve).select(*keys, "ds", "y", "_f"), _solved(history, keys, curve), keys)
    trend = _dot(F.slice("_f", 1, curve.trend_size), F.slice("_b", 1, curve.trend_size))
    rows = rows.select(*keys, "ds", "y", trend.alias("_trend"))
    mean = F.avg(F.when(F.col("y").isNotNull(), F.col("_trend"))).over(Window.partitionBy(*keys))
    height = F.least(F.greatest(F.col("_trend") / F.when(mean > 0, mean), F.lit(-MOST_HEIGHT)), F.lit(MOST_HEIGHT))
    rows = rows.select(*keys, "ds", "y", F.coalesce(height, F.lit(0.0)).alias("_height"))

    fits = _solved(rows, keys, curve)
    both = _with_fit(_with_features(rows, keys, curve).select(*keys, "ds", "_f"), fits, keys)
    band = F.lit(float(curve.z)) * F.col("_sd")
    return both.withColumn("_yhat", _dot(F.col("_f"), F.col("_b"))).select(
        *keys,
        F.col("ds").alias("date"),
        pd_round(clip(F.col("_yhat"), 0), 0).alias("forecast_qty"),
        pd_round(clip(F.col("_yhat") - band, 0), 0).alias("lower_bound"),
        pd_round(F.col("_yhat") + band, 0).alias("upper_bound"),
    )
