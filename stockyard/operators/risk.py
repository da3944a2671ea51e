"""Supplier risk scoring: delay rate, lead time against a benchmark, lead-time spread."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import bin_right, clip, pd_round, safe_div, sql_round
from .measures import avg_of, rate_pct, revenue

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

# Benchmark lead time (days), component weights, label bins.
BENCHMARK_LEAD_TIME = 15
WEIGHTS = (0.40, 0.35, 0.25)
RISK_EDGES = [-1, 30, 60, 101]
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]


def supplier_aggregates(star: StarSchema) -> DataFrame:
    """Per supplier (and its reliability): order count, delay rate, lead-time stats, spend."""
    from .kpis import by_supplier

    return by_supplier(star)


def supplier_base(star: StarSchema) -> DataFrame:
    """Rounded per-supplier aggregates the scores are derived from."""
    return supplier_aggregates(star).select(
        "supplier_name",
        "reliability",
        F.col("n_orders").alias("total_orders"),
        rate_pct(2).alias("delay_rate_pct"),
        sql_round(avg_of("lead"), 1).alias("avg_lead_time"),
        sql_round(F.col("min_lead"), 0).alias("min_lead_time"),
        sql_round(F.col("max_lead"), 0).alias("max_lead_time"),
        revenue(0).alias("total_spend"),
    )


def score_suppliers(
    base: DataFrame,
    benchmark_lead_time: float = BENCHMARK_LEAD_TIME,
    weights: tuple[float, float, float] = WEIGHTS,
) -> DataFrame:
    """Add delay / lead-time / variance scores, the weighted risk score and its label.

    Derived from the already-rounded aggregates.  "Variance" is the lead-time
    range over its mean: without bound, so 100, when only the mean is 0, and null
    when both are."""
    spread = F.col("max_lead_time") - F.col("min_lead_time")
    bench = F.lit(float(benchmark_lead_time))
    scored = base.withColumns(
        {
            "delay_score": clip(F.col("delay_rate_pct") / 100 * 100, 0, 100),
            "lead_time_score": clip((F.col("avg_lead_time") - bench) / bench * 100, 0, 100),
            "variance_score": F.when((F.col("avg_lead_time") == 0) & (spread > 0), F.lit(100.0)).otherwise(
                clip(safe_div(spread, F.col("avg_lead_time")) * 100, 0, 100)
            ),
        }
    )
    wd, wl, wv = (F.lit(float(w)) for w in weights)
    risk = pd_round(F.col("delay_score") * wd + F.col("lead_time_score") * wl + F.col("variance_score") * wv, 1)
    return scored.withColumn("risk_score", risk).withColumn(
        "risk_label", bin_right(F.col("risk_score"), RISK_EDGES, RISK_LABELS)
    )


def supplier_risk(
    star: StarSchema,
    benchmark_lead_time: float = BENCHMARK_LEAD_TIME,
    weights: tuple[float, float, float] = WEIGHTS,
) -> DataFrame:
    """0-100 risk index per supplier, highest delay rate first."""
    return score_suppliers(supplier_base(star), benchmark_lead_time, weights).orderBy(
        F.desc("delay_rate_pct"), "supplier_name"
    )


def supplier_risk_view(star: StarSchema) -> DataFrame:
    """Risk table as shown in the report: name, delay rate, lead time, score, label."""
    return supplier_risk(star).select("supplier_name", "delay_rate_pct", "avg_lead_time", "risk_score", "risk_label")
