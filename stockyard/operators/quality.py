"""Data-quality checks of the star schema: summary checks, foreign keys, constraints.

Declared keys are never enforced by the storage, so they are checked here.
Each check aggregates first (a skewed key collapses map-side) and anti-joins
only the small distinct-key sets.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import sql_round
from .measures import avg_of, partial_measures, revenue, total

if TYPE_CHECKING:
    from ..plans.warehouse import StarSchema

FOREIGN_KEYS = {
    "date_id": "dim_date",
    "product_id": "dim_product",
    "supplier_id": "dim_supplier",
    "region_id": "dim_region",
}
PRIMARY_KEYS = {
    "dim_date": "date_id",
    "dim_product": "product_id",
    "dim_supplier": "supplier_id",
    "dim_region": "region_id",
    "fact_orders": "order_id",
}
UNIQUE_NAMES = {"dim_product": "product_name", "dim_supplier": "supplier_name", "dim_region": "region_name"}
NOT_NULL = {
    "dim_date": ["full_date"],
    "dim_product": ["product_name"],
    "dim_supplier": ["supplier_name"],
    "dim_region": ["region_name"],
}


def _rows(df: DataFrame, checks: list) -> DataFrame:
    """One-row ``df`` as one (_o, check, value) row for each (order, label, value)."""
    rows = [F.struct(F.lit(o).alias("_o"), F.lit(label).alias("check"), v.cast("double").alias("value")) for o, label, v in checks]
    return df.select(F.inline(F.array(*rows)))


def validate_schema(star: StarSchema) -> DataFrame:
    """Seven (check, value) rows: counts, delay %, lead time, revenue, null product ids.

    One scan of the fact: it is grouped by whether a row has a product, and the
    two rows that gives are rolled up."""
    parts = partial_measures(star.fact_orders, [F.col("product_id").isNull().alias("no_product")])
    nulls = F.coalesce(F.sum(F.when(F.col("no_product"), F.col("n_rows"))), F.lit(0)).alias("nulls")
    facts = _rows(
        total(parts, [nulls]),
        [
            (1, "Total orders", F.coalesce("n_rows", F.lit(0))),
            (4, "Delayed order %", sql_round(avg_of("delayed") * 100, 1)),
            (5, "Avg lead time (days)", sql_round(avg_of("lead"), 1)),
            (6, "Total revenue", revenue(0)),
            (7, "Null product_ids", F.col("nulls")),
        ],
    )
    count = F.count(F.lit(1)).alias("n")
    products = _rows(star.dim_product.agg(count), [(2, "Unique products", F.col("n"))])
    suppliers = _rows(star.dim_supplier.agg(count), [(3, "Unique suppliers", F.col("n"))])
    return facts.unionByName(products).unionByName(suppliers).orderBy("_o").drop("_o")


def fact_null_cells(star: StarSchema) -> DataFrame:
    """Null count over all cells of the fact (one scan)."""
    fact = star.fact_orders
    return fact.agg(sum(F.count_if(F.col(c).isNull()) for c in fact.columns).alias("null_cells"))


def dq_foreign_keys(star: StarSchema) -> DataFrame:
    """Per foreign key: null references and references with no dimension row."""
    out = None
    for order, (fk, dim) in enumerate(FOREIGN_KEYS.items()):
        refs = star.fact_orders.groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
        keys = star.table(dim).select(fk)
        missing = refs.join(keys, fk, "left_anti")
        row = missing.agg(
            F.coalesce(F.sum(F.when(F.col(fk).isNull(), F.col("_n"))), F.lit(0)).alias("null_refs"),
            F.coalesce(F.sum(F.when(F.col(fk).isNotNull(), F.col("_n"))), F.lit(0)).alias("orphan_refs"),
        ).select(F.lit(order).alias("_o"), F.lit(fk).alias("fk_column"), F.lit(dim).alias("dim_table"), "null_refs", "orphan_refs")
        out = row if out is None else out.unionByName(row)
    return out.orderBy("_o").drop("_o")


def dq_constraints(star: StarSchema) -> DataFrame:
    """Declared PRIMARY KEY / UNIQUE / NOT NULL constraints: violating rows per constraint.

    One aggregate per table: key violations are surplus rows
    (``count - count_distinct``; duplicated keys collapse map-side), NOT NULL
    violations are ``count_if(is null)``.  The one-row results are unpivoted
    and unioned."""
    out = None
    order = 0
    for table, pk in PRIMARY_KEYS.items():
        checks = [("PRIMARY KEY", pk, F.count(pk) - F.count_distinct(pk)), ("NOT NULL", pk, F.count_if(F.col(pk).isNull()))]
        if table in UNIQUE_NAMES:
            name = UNIQUE_NAMES[table]
            checks.append(("UNIQUE", name, F.count(name) - F.count_distinct(name)))
        checks += [("NOT NULL", c, F.count_if(F.col(c).isNull())) for c in NOT_NULL.get(table, [])]
        wide = star.table(table).agg(*[expr.cast("long").alias(f"v{i}") for i, (_, _, expr) in enumerate(checks)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(order + i).alias("_o"),
                    F.lit(table).alias("table_name"),
                    F.lit(kind).alias("constraint_type"),
                    F.lit(col).alias("column_name"),
                    F.col(f"v{i}").alias("violations"),
                )
                for i, (kind, col, _) in enumerate(checks)
            ]
        )
        order += len(checks)
        part = wide.select(F.inline(rows))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("_o").drop("_o")
