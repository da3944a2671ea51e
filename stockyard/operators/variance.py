"""Planned vs actual delivery by month and category; spend pivot; on-time trend."""

from __future__ import annotations

from typing import TYPE_CHECKING

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pd_round, sql_round
from ..plans.joins import lookup_join
from .measures import avg_of, partial_measures, revenue, rollup

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

# Cost of one delay day as a share of order value, SLA target (%).
DELAY_COST_RATE = 0.005
SLA_TARGET = 80


def month_category_aggregates(star: StarSchema) -> DataFrame:
    """Fact measures per (year, month, month_name, quarter, category).

    The fact is aggregated by (month of the date key, product_id) first and rolled
    up to categories; the month's names join that small result.
    """
    month_key = F.floor(F.col("date_id") / 100).cast("int").alias("month_key")
    parts = partial_measures(star.fact_orders, [month_key, "product_id"])
    products = star.dim_product.select("product_id", "category")
    joined = lookup_join(parts, products, "product_id", "inner", star.dim_rows("dim_product"))
    rolled = rollup(joined, ["month_key", "category"])
    months = star.dim_date.select(month_key, "year", "month", "month_name", "quarter").distinct()
    return lookup_join(rolled, months, "month_key", "inner", star.dim_rows("dim_date")).drop("month_key")


def cost_variance_base(star: StarSchema) -> DataFrame:
    """Rounded per (year, month, category) aggregates."""
    return month_category_aggregates(star).select(
        "year",
        "month",
        "month_name",
        "quarter",
        "category",
        F.col("n_orders").alias("total_orders"),
        revenue(0).alias("planned_spend"),
        sql_round(avg_of("lead"), 1).alias("planned_days"),
        sql_round(avg_of("actual"), 1).alias("actual_days"),
        sql_round(avg_of("delay"), 2).alias("avg_delay"),
        F.col("sum_delayed").alias("delayed_orders"),
    )


def derive_cost_variance(base: DataFrame, delay_cost_rate: float = DELAY_COST_RATE) -> DataFrame:
    """Day variance, delay cost (product of rounded group aggregates, not a sum
    of per-order costs), on-time rate and period label."""
    return base.withColumns(
        {
            "day_variance": pd_round(F.col("actual_days") - F.col("planned_days"), 2),
            "delay_cost": pd_round(F.col("planned_spend") * F.col("avg_delay") * F.lit(delay_cost_rate), 0),
            "on_time_rate": pd_round(F.lit(1) - F.col("delayed_orders") / F.col("total_orders"), 3) * 100,
            "period": F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string")),
        }
    )


def cost_variance(star: StarSchema, delay_cost_rate: float = DELAY_COST_RATE) -> DataFrame:
    """Planned vs actual delivery per (year, month, category), in period order."""
    return derive_cost_variance(cost_variance_base(star), delay_cost_rate).orderBy("year", "month", "category")


def cost_variance_rows(star: StarSchema) -> DataFrame:
    """``cost_variance`` without the presentation sort (input of further aggregation)."""
    return derive_cost_variance(cost_variance_base(star))


#: Categories a pivot finds by itself at most: each becomes a column.
MAX_CATEGORIES = 1000
NO_CATEGORY = "(none)"


def found_categories(star: StarSchema, most: int = MAX_CATEGORIES) -> list[str]:
    """The categories of the product dimension in name order (products without one: ``(none)``, last).

    Fails beyond ``most``: a wide pivot is a long table."""
    distinct = star.dim_product.select("category").distinct().limit(most + 1).collect()
    if len(distinct) > most:
        raise ValueError(f"more than {most} categories; use cost_variance, one row for each")
    names = [r["category"] for r in distinct]
    return sorted(n for n in names if n is not None) + [NO_CATEGORY] * (None in names)


def monthly_category_spend(star: StarSchema, categories: Sequence[str] | None = None) -> DataFrame:
    """Planned spend by calendar month (years merged) with one column per category, 0 if none.

    Without ``categories`` the columns are those found in the product dimension.  With them, a
    category that is not listed fails the query: its spend would have no column."""
    categories = found_categories(star) if categories is None else list(categories)
    category = F.coalesce("category", F.lit(NO_CATEGORY))
    unlisted = F.raise_error(F.concat(F.lit("category without a column: "), category)).cast("string")
    cv = cost_variance_rows(star).withColumn("category", F.when(category.isin(categories), category).otherwise(unlisted))
    wide = cv.groupBy("month").pivot("category", categories).agg(F.sum("planned_spend"))
    return wide.na.fill(0.0, subset=categories).orderBy("month")


def monthly_on_time(star: StarSchema, sla_target: float = SLA_TARGET) -> DataFrame:
    """Unweighted mean of the (year, category) on-time rates per calendar month,
    against the SLA target.  Rates are multiples of 0.1, so they are summed as
    integer tenths: the mean does not depend on row order."""
    cv = cost_variance_rows(star).where(F.col("on_time_rate").isNotNull())
    tenths = F.rint(F.col("on_time_rate") * 10).cast("long")
    per_month = cv.groupBy("month").agg(F.sum(tenths).alias("_t"), F.count(F.lit(1)).alias("_n"))
    rate = F.col("_t").cast("double") / F.col("_n").cast("double") / F.lit(10.0)
    target = F.lit(float(sla_target))
    return (
        per_month.select("month", rate.alias("on_time_rate"))
        .withColumns(
            {
                "sla_target": target,
                "below_sla": F.col("on_time_rate") < target,
                "sla_gap": F.greatest(target - F.col("on_time_rate"), F.lit(0.0)),
            }
        )
        .orderBy("month")
    )
