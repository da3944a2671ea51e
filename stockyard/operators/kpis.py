"""Executive KPIs, breakdowns by region/product/month and dashboard data sets.

Metrics that come from different tables (fact, products, suppliers) are
combined by a union of one-row aggregates in long form - never a cross join -
and pivoted back to one wide row where the contract asks for it.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import amount, sql_round
from ..functions.text import label_from_key
from ..plans.joins import lookup_join
from ..schemas import FACT_PARTITION
from .inventory import derive_inventory_kpis
from .measures import (
    avg_cost,
    avg_of,
    measures,
    on_time_pct,
    partial_measures,
    rate_pct,
    revenue,
    rollup,
    total,
)
from .risk import score_suppliers

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

# Metric order of the two summaries, stock threshold, targets.
EXECUTIVE_METRICS = [
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "on_time_rate_pct",
    "avg_lead_time_days",
    "avg_delay_days",
    "total_delayed_orders",
    "high_risk_suppliers",
    "critical_stock_items",
]
SUMMARY_METRICS = [
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "on_time_rate_pct",
    "avg_lead_time_days",
    "avg_delay_days",
    "critical_stock_items",
    "high_risk_suppliers",
]
COUNT_METRICS = {"total_orders", "total_delayed_orders", "high_risk_suppliers", "critical_stock_items"}
CRITICAL_STOCK_BELOW = 100
HIGH_RISK_RELIABILITY = "Low"
TOP_SHARE_N = 3


def _long(one_row: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One-row frame of metrics -> (metric, value double)."""
    cast = one_row.select(*[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot([], list(metrics), "metric", "value")


def kpi_metrics(star: StarSchema) -> DataFrame:
    """All executive metrics in long form (metric, value)."""
    # One scan of the fact: measures per product (rows without one included) give the totals and the
    # products short of stock.
    short = F.count_if(avg_of("stock") < CRITICAL_STOCK_BELOW).alias("critical_stock_items")
    f = total(partial_measures(star.fact_orders, ["product_id"]), [short]).select(
        F.coalesce("n_rows", F.lit(0)).alias("total_orders"),
        revenue(0).alias("total_revenue"),
        sql_round(avg_cost(), 0).alias("avg_order_value"),
        on_time_pct(1).alias("on_time_rate_pct"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time_days"),
        sql_round(avg_of("delay"), 2).alias("avg_delay_days"),
        F.col("sum_delayed").alias("total_delayed_orders"),
        "critical_stock_items",
    )
    risky = star.dim_supplier.where(F.col("reliability") == HIGH_RISK_RELIABILITY).agg(
        F.count(F.lit(1)).alias("high_risk_suppliers")
    )
    return _long(f, [*EXECUTIVE_METRICS[:7], "critical_stock_items"]).unionByName(_long(risky, ["high_risk_suppliers"]))


def executive_kpis(star: StarSchema) -> DataFrame:
    """Nine headline metrics as one wide row."""
    wide = kpi_metrics(star).groupBy().pivot("metric", EXECUTIVE_METRICS).agg(F.first("value"))
    return wide.select(
        *[F.col(m).cast("long" if m in COUNT_METRICS else "double").alias(m) for m in EXECUTIVE_METRICS]
    )


def kpi_summary(star: StarSchema) -> DataFrame:
    """Eight metrics as a (KPI, Value) table, labels from the metric keys."""
    order = F.array_position(F.array(*[F.lit(m) for m in SUMMARY_METRICS]), F.col("metric"))
    return (
        kpi_metrics(star)
        .where(F.col("metric").isin(SUMMARY_METRICS))
        .withColumn("_ord", order)
        .orderBy("_ord")
        .select(label_from_key(F.col("metric")).alias("KPI"), F.col("value").alias("Value"))
    )


# Natural keys of the dimensions: unique by construction (built with groupBy).
NATURAL_KEYS = {"dim_product": "product_name", "dim_supplier": "supplier_name", "dim_region": "region_name"}


def _by(star: StarSchema, fk: str, dim_name: str, attrs: Sequence[str]) -> DataFrame:
    """Fact measures per dimension attributes: aggregate by the foreign key,
    then join.  When the attributes contain the dimension's unique natural
    key, each foreign key maps to one attribute row and no second
    aggregation (and shuffle) is needed."""
    parts = partial_measures(star.fact_orders, [fk])
    dim = star.table(dim_name).select(fk, *attrs)
    joined = lookup_join(parts, dim, fk, "inner", star.dim_rows(dim_name))
    if NATURAL_KEYS.get(dim_name) in attrs:
        return joined.drop(fk)
    return rollup(joined, list(attrs))


def by_region(star: StarSchema) -> DataFrame:
    return _by(star, "region_id", "dim_region", ["region_name"])


def by_product(star: StarSchema) -> DataFrame:
    return _by(star, "product_id", "dim_product", ["product_name", "category"])


def by_supplier(star: StarSchema) -> DataFrame:
    return _by(star, "supplier_id", "dim_supplier", ["supplier_name", "reliability"])


def by_month(star: StarSchema) -> DataFrame:
    return _by(star, "date_id", "dim_date", ["year", "month", "month_name"])


def kpi_by_region(star: StarSchema) -> DataFrame:
    return by_region(star).select(
        "region_name",
        F.col("n_orders").alias("total_orders"),
        revenue(0).alias("total_revenue"),
        rate_pct(1).alias("delay_rate_pct"),
    ).orderBy(F.desc("total_revenue"), "region_name")


def kpi_by_product(star: StarSchema) -> DataFrame:
    return by_product(star).select(
        "product_name",
        "category",
        F.col("sum_qty").alias("total_qty"),
        revenue(0).alias("total_revenue"),
        sql_round(avg_of("stock"), 0).alias("avg_stock"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
    ).orderBy(F.desc("total_revenue"), "product_name")


def kpi_monthly_trend(star: StarSchema) -> DataFrame:
    return by_month(star).select(
        "year",
        "month",
        "month_name",
        F.col("n_orders").alias("total_orders"),
        revenue(0).alias("total_revenue"),
        rate_pct(1).alias("delay_rate_pct"),
    ).orderBy("year", "month")


def sliced(star: StarSchema, years: Sequence[int] | None = None, categories: Sequence[str] | None = None) -> StarSchema:
    """The star schema with its fact restricted to years and categories: the slicers of every report.

    Years become a filter on the fact's partition column, so that the scan lists only their folders (and
    date-key ranges, pushed to the row groups, where the fact is not partitioned).  Categories keep the
    fact rows of their products, a semi-join with a size-checked dimension."""
    fact = star.fact_orders
    if years is not None:
        if star.fact_by_year is not None:
            fact = star.fact_by_year.where(F.col(FACT_PARTITION).isin(list(years))).select(*fact.columns)
        cond = F.lit(False)
        for y in years:
            cond = cond | ((F.col("date_id") >= y * 10000) & (F.col("date_id") < (y + 1) * 10000))
        fact = fact.where(cond)
    if categories is not None:
        wanted = star.dim_product.where(F.col("category").isin(list(categories))).select("product_id")
        fact = lookup_join(fact, wanted, "product_id", "left_semi", star.dim_rows("dim_product"))
    return replace(star, fact_orders=fact)


def kpi_sliced(star: StarSchema, years: Sequence[int] | None = None, categories: Sequence[str] | None = None) -> DataFrame:
    """Dashboard cards for every (year, category) slice, optionally restricted.

    The fact is reduced by (year of the date key, product) before its join."""
    year = F.floor(F.col("date_id") / 10000).cast("int").alias("year")
    parts = partial_measures(sliced(star, years).fact_orders.where(F.col("date_id").isNotNull()), [year, "product_id"])
    joined = lookup_join(
        parts, star.dim_product.select("product_id", "category"), "product_id", "inner", star.dim_rows("dim_product")
    )
    if categories is not None:
        joined = joined.where(F.col("category").isin(list(categories)))
    return rollup(joined, ["year", "category"]).select(
        "year",
        "category",
        revenue(0).alias("total_revenue"),
        on_time_pct(1).alias("on_time_rate_pct"),
        F.col("n_orders").alias("total_orders"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
    ).orderBy("year", "category")


def revenue_concentration(star: StarSchema, top_n: int = TOP_SHARE_N) -> DataFrame:
    """Share of total revenue of the top-N products (rank, share, cumulative share).

    Top-N by a distributed top-k; the grand total rides along as one extra
    row of a union, so the window below spans N+1 rows."""
    per = by_product(star).select("product_name", F.col("cost_c"))
    top = per.orderBy(F.desc("cost_c"), "product_name").limit(top_n)
    grand = per.agg(F.sum("cost_c").alias("_total_c"))
    both = top.withColumn("_total_c", F.lit(None).cast("long")).unionByName(
        grand.select(F.lit(None).cast("string").alias("product_name"), F.lit(None).cast("long").alias("cost_c"), "_total_c")
    )
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.desc("cost_c"), "product_name")
    cum = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    withtot = both.withColumn("_t", F.max("_total_c").over(everything)).where(F.col("product_name").isNotNull())
    return (
        withtot.select(
            F.row_number().over(ranked).alias("revenue_rank"),
            "product_name",
            sql_round(amount(F.col("cost_c")), 0).alias("total_revenue"),
            sql_round(F.col("cost_c").cast("double") / F.col("_t").cast("double") * 100, 2).alias("revenue_share_pct"),
            sql_round(F.sum("cost_c").over(cum).cast("double") / F.col("_t").cast("double") * 100, 2).alias(
                "cumulative_share_pct"
            ),
        )
        .orderBy("revenue_rank")
    )


def delay_per_affected(star: StarSchema) -> DataFrame:
    """Delayed orders, their share, and the mean delay per delayed order."""
    return total(partial_measures(star.fact_orders, [])).select(
        F.col("sum_delayed").alias("delayed_orders"),
        rate_pct(1).alias("delayed_pct"),
        sql_round(F.col("sum_affected").cast("double") / F.col("n_affected").cast("double"), 1).alias(
            "avg_delay_per_affected"
        ),
    )


# KPI targets (metric, comparator, target), in report order.
TARGETS = [
    ("on_time_rate_pct", ">=", 80.0),
    ("avg_lead_time_days", "<=", 20.0),
    ("avg_inventory_turnover", ">=", 6.0),
    ("max_supplier_risk_score", "<=", 30.0),
    ("critical_stock_items", "<=", 0.0),
]


def kpi_targets(star: StarSchema) -> DataFrame:
    """Headline KPIs against their targets, with MET / NOT MET.

    Mean inventory turnover stands for the per-product turnover target and the highest supplier risk
    score for the risk target.  One scan of the fact: grouping sets by product and by supplier, whose rows
    meet their dimension (products and suppliers without one have no turnover and no score) and then
    collapse to one row of metrics."""
    sets = star.fact_orders.groupingSets([["product_id"], ["supplier_id"]], "product_id", "supplier_id")
    parts = sets.agg(*measures(), F.grouping("supplier_id").alias("_by_product"))
    named = lookup_join(parts, star.dim_product.select("product_id", "product_name"), "product_id", "left", star.dim_rows("dim_product"))
    named = lookup_join(named, star.dim_supplier.select("supplier_id", "supplier_name"), "supplier_id", "left", star.dim_rows("dim_supplier"))
    product, supplier = F.col("_by_product") == 1, F.col("_by_product") == 0
    base = named.select(
        "*",
        F.col("sum_qty").alias("total_units_sold"),
        sql_round(avg_of("stock"), 0).alias("avg_stock"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
        rate_pct(2).alias("delay_rate_pct"),
        sql_round(F.col("min_lead"), 0).alias("min_lead_time"),
        sql_round(F.col("max_lead"), 0).alias("max_lead_time"),
    )
    scored = score_suppliers(derive_inventory_kpis(base))
    turnover = F.when(product & F.col("product_name").isNotNull(), F.col("inventory_turnover"))
    worst = F.when(supplier & F.col("supplier_name").isNotNull(), F.col("risk_score"))
    own = lambda c: F.sum(F.when(product, F.col(c)))  # noqa: E731  every fact row is in one product group
    one = scored.agg(
        sql_round((F.lit(1) - own("sum_delayed").cast("double") / own("n_delayed").cast("double")) * 100, 1).alias("on_time_rate_pct"),
        sql_round(own("sum_lead").cast("double") / own("n_lead").cast("double"), 1).alias("avg_lead_time_days"),
        sql_round(F.avg(turnover), 2).alias("avg_inventory_turnover"),
        F.max(worst).alias("max_supplier_risk_score"),
        F.count_if(product & (avg_of("stock") < CRITICAL_STOCK_BELOW)).alias("critical_stock_items"),
    )
    metrics = _long(one, [name for name, _, _ in TARGETS])

    def lookup(values) -> Column:
        pairs = [x for (name, _, _), v in zip(TARGETS, values) for x in (F.lit(name), F.lit(v))]
        return F.element_at(F.create_map(*pairs), F.col("metric"))

    comparator = lookup([t[1] for t in TARGETS])
    target = lookup([t[2] for t in TARGETS])
    order = lookup(list(range(len(TARGETS))))
    met = F.when(comparator == ">=", F.col("value") >= target).otherwise(F.col("value") <= target)
    return (
        metrics.select(
            "metric",
            "value",
            comparator.alias("comparator"),
            target.alias("target"),
            F.when(met, F.lit("MET")).otherwise(F.lit("NOT MET")).alias("status"),
            order.alias("_o"),
        )
        .orderBy("_o")
        .drop("_o")
    )
