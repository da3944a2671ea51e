"""Aggregate-then-join building blocks shared by the KPI operators.

Every KPI groups the fact by a dimension attribute.  Instead of joining the
fact to the dimension and grouping the wide result, the fact is first
aggregated by the foreign key (partial + final hash aggregate: a skewed key
collapses map-side), the small aggregate is joined to the dimension, and a
second, cheap roll-up regroups by the attribute.  Sums, counts, minima and
maxima compose exactly; averages are carried as (sum, count) pairs.  Money is
carried as integer cents so totals do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, cents, round_amount, sql_round


def _parts() -> list[tuple[str, Column, str]]:
    """(output name, aggregate over fact rows, how partial values combine)."""
    return [
        ("n_orders", F.count("order_id"), "sum"),
        ("n_rows", F.count(F.lit(1)), "sum"),
        ("sum_qty", F.sum("quantity_ordered"), "sum"),
        ("cost_c", F.sum(cents(F.col("total_cost"))), "money"),
        ("n_cost", F.count("total_cost"), "sum"),
        ("unit_c", F.sum(cents(F.col("unit_cost"))), "money"),
        ("n_unit", F.count("unit_cost"), "sum"),
        ("sum_lead", F.sum("lead_time_days"), "sum"),
        ("n_lead", F.count("lead_time_days"), "sum"),
        ("min_lead", F.min("lead_time_days"), "min"),
        ("max_lead", F.max("lead_time_days"), "max"),
        ("sum_actual", F.sum("actual_delivery_days"), "sum"),
        ("n_actual", F.count("actual_delivery_days"), "sum"),
        ("sum_delay", F.sum("delay_days"), "sum"),
        ("n_delay", F.count("delay_days"), "sum"),
        ("sum_delayed", F.sum("is_delayed"), "sum"),
        ("n_delayed", F.count("is_delayed"), "sum"),
        ("sum_stock", F.sum("warehouse_stock"), "sum"),
        ("n_stock", F.count("warehouse_stock"), "sum"),
        ("n_affected", F.count(F.when(F.col("delay_days") > 0, F.col("delay_days"))), "sum"),
        ("sum_affected", F.sum(F.when(F.col("delay_days") > 0, F.col("delay_days"))), "sum"),
    ]


# Money totals are rolled up as decimals: cents of a very large fact do not fit 64 bits.
_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max, "money": lambda c: F.sum(F.col(c).cast("decimal(38,0)"))}


def measures() -> list[Column]:
    """All measures as aggregates over fact rows."""
    return [agg.alias(name) for name, agg, _ in _parts()]


def partial_measures(fact: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Fact aggregated by ``keys``.  Unused measures are pruned by Catalyst."""
    return fact.groupBy(*keys).agg(*measures())


def rollup(parts: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Regroup partial measures by coarser ``keys`` (exact for all measures)."""
    return parts.groupBy(*keys).agg(*[_COMBINE[how](name).alias(name) for name, _, how in _parts()])


def total(parts: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """Global roll-up of partial measures (one row), with ``more`` aggregates beside them."""
    return parts.agg(*[_COMBINE[how](name).alias(name) for name, _, how in _parts()], *more)


def avg_of(measure: str) -> Column:
    """``AVG(column)`` from its (sum, count) pair."""
    return F.col(f"sum_{measure}").cast("double") / F.col(f"n_{measure}").cast("double")


def rate_pct(n: int) -> Column:
    """``ROUND(AVG(is_delayed) * 100, n)``."""
    return sql_round(avg_of("delayed") * 100, n)


def on_time_pct(n: int) -> Column:
    """``ROUND((1 - AVG(is_delayed)) * 100, n)``."""
    return sql_round((F.lit(1) - avg_of("delayed")) * 100, n)


def revenue(n: int = 0) -> Column:
    """``ROUND(SUM(total_cost), n)`` (exact)."""
    return round_amount(F.col("cost_c"), n)


def avg_cost() -> Column:
    """``AVG(total_cost)`` from exact cents."""
    return amount(F.col("cost_c")) / F.col("n_cost").cast("double")


def avg_unit_cost() -> Column:
    """``AVG(unit_cost)`` from exact cents."""
    return amount(F.col("unit_c")) / F.col("n_unit").cast("double")
