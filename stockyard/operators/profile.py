"""Feed profile: headline figures and per-column descriptive statistics.

Moments are taken over exact integers (values, or cents for money) so mean
and standard deviation do not depend on row order (the standard deviation is
reported to 6 decimals); quartiles are exact with linear interpolation and
computed without gathering a column's values in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cents, sql_round
from .refine import Range, quantiles

# Numeric columns of the raw feed; money columns carry two decimals.
INT_COLUMNS = ["quantity_ordered", "lead_time_days", "warehouse_stock", "delay_days", "actual_delivery_days"]
MONEY_COLUMNS = ["unit_cost", "total_cost"]
QUANTILES = (0.25, 0.5, 0.75)


def feed_summary(raw_orders: DataFrame) -> DataFrame:
    """Rows, columns (count and names), total value, delayed count and share,
    first and last order date."""
    delayed = F.col("is_delayed").cast("int")
    return raw_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.lit(len(raw_orders.columns)).cast("long").alias("n_columns"),
        F.lit(",".join(raw_orders.columns)).alias("column_list"),
        F.round(F.sum(F.col("total_cost").cast("decimal(28,6)")), 0).cast("double").alias("total_value"),
        F.sum(delayed).alias("delayed_orders"),
        sql_round(F.avg(delayed) * 100, 1).alias("delayed_pct"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def profile_orders(
    raw_orders: DataFrame,
    int_columns: Sequence[str] = INT_COLUMNS,
    money_columns: Sequence[str] = MONEY_COLUMNS,
) -> DataFrame:
    """``describe()``: count, mean, std, min, quartiles, max per numeric column.

    One aggregate over the feed computes the moments and extremes of every
    column (the wide row is then turned into one row per column); quartiles
    come from rank refinement between the extremes, one or two counting passes over the same
    columns.  These jobs run while the plan is built; the result holds one row per column.
    A column of nulls only has count 0 and null statistics.  Money is taken to whole cents."""
    ints = {c: F.col(c).cast("long") for c in int_columns}
    money = {c: cents(F.col(c)) for c in money_columns}
    scaled = {**ints, **money}
    aggs = []
    for i, v in enumerate(scaled.values()):
        big = v.cast("decimal(38,0)")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.sum(big).alias(f"s{i}"),
            F.sum(big * big).alias(f"q{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
        ]
    wide = raw_orders.agg(*aggs)
    found = wide.first()
    known = {c: Range(found[f"n{i}"], found[f"lo{i}"], found[f"hi{i}"]) for i, c in enumerate(scaled)}
    quart = quantiles(raw_orders, scaled, QUANTILES, known)
    wide = raw_orders.sparkSession.createDataFrame([found], wide.schema)
    rows = []
    for i, c in enumerate(scaled):
        unit = F.lit(100.0 if c in money else 1.0)
        n, s, q = F.col(f"n{i}"), F.col(f"s{i}"), F.col(f"q{i}")
        var = (n.cast("decimal(38,0)") * q - s * s).cast("double") / (n.cast("double") * (n - 1).cast("double"))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                n.alias("count"),
                (s.cast("double") / n.cast("double") / unit).alias("mean"),
                sql_round(F.sqrt(F.when(n > 1, var)) / unit, 6).alias("std"),
                (F.col(f"lo{i}").cast("double") / unit).alias("min"),
                *[(F.lit(q).cast("double") / unit).alias(p) for p, q in zip(("p25", "p50", "p75"), quart[c], strict=True)],
                (F.col(f"hi{i}").cast("double") / unit).alias("max"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))
