"""Star schema: date, product, supplier and region dimensions and the order fact.

Dimensions are aggregates of the cleaned orders (map-side partial
aggregation, so a hot product or supplier never lands whole in one task).
Surrogate keys are dense 1..n in natural-key order.  A dimension whose
counted size is small is numbered by one ordered window; a large one is
range-partitioned by the key, numbered inside each partition, and shifted by
the row counts of the partitions before it (no single-task window).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.numeric import amount, bin_right, cents, pd_round
from ..plans.joins import lookup_join
from ..session import shared_dir

# The pipeline's own lookup maps and thresholds.
PRODUCT_CATEGORY = {
    "Laptop": "Computing",
    "Monitor": "Computing",
    "Phone": "Mobile",
    "Tablet": "Mobile",
    "Keyboard": "Accessories",
    "Mouse": "Accessories",
    "Headphones": "Audio",
    "Speaker": "Audio",
    "Camera": "Imaging",
    "Printer": "Imaging",
}
REGION_ZONE = {
    "North": "North Zone",
    "South": "South Zone",
    "East": "East Zone",
    "West": "West Zone",
    "Central": "Central Zone",
}
DEFAULT_CATEGORY = "Other"
DEFAULT_COUNTRY = "India"
# Supplier reliability from the delay rate, right-closed bins.
RELIABILITY_EDGES = [-0.01, 0.15, 0.30, 1.0]
RELIABILITY_LABELS = ["High", "Medium", "Low"]

_ROW_BITS = 33  # monotonically_increasing_id: partition id above bit 33


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A literal map column (no join needed for a fixed dictionary)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# Dimensions up to this many rows get their keys from one ordered window
# (a single task, but over a size proven by the count); larger ones use the
# distributed numbering below.
SMALL_DIM_ROWS = 1_000_000


def with_dense_ids(
    dim: DataFrame, order_cols: Sequence[str], id_col: str, small_rows: int = SMALL_DIM_ROWS
) -> DataFrame:
    """Prepend ``id_col`` = 1..n following ``order_cols`` (which must be unique).

    The dimension is checkpointed first (computed once, then fixed) and
    counted.  A small one is numbered by a global ``row_number``.  A large one
    is range-partitioned by the key and sorted inside partitions; each row is
    tagged with ``monotonically_increasing_id`` (partition index in the high
    bits, row position in the low bits) and checkpointed again so the tags
    survive task re-runs; the per-partition row counts (one row per partition,
    bounded by the partition count) give each partition's offset.
    """
    order_cols = list(order_cols)
    cols = [F.col(f"`{c}`") for c in dim.columns]
    shared_dir(dim.sparkSession)  # checkpoint() needs the shared folder
    staged = dim.checkpoint(eager=True)
    if staged.count() <= small_rows:
        rank = F.row_number().over(Window.orderBy(*order_cols))
        return staged.select(rank.cast("int").alias(id_col), *cols)
    tagged = (
        staged.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_tag", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("_tag"), _ROW_BITS)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    row_in_part = F.col("_tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return tagged.join(F.broadcast(offsets), part == F.col("_part")).select(
        (F.col("_offset") + row_in_part + 1).cast("int").alias(id_col), *cols
    )


def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per distinct order date, with calendar attributes."""
    d = F.col("full_date")
    days = orders.select(cal.day_start(F.col("order_date")).alias("full_date")).where(d.isNotNull()).distinct()
    return days.select(
        cal.date_key(d).alias("date_id"),
        d,
        F.year(d).alias("year"),
        cal.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        cal.month_name(d).alias("month_name"),
        cal.week_monday(d).alias("week"),
        cal.weekday_name(d).alias("day_of_week"),
    )


def product_attributes(
    orders: DataFrame,
    category_map: Mapping[str, str] = PRODUCT_CATEGORY,
    category_key: Callable[[Column], Column] | None = None,
    default_category: str = DEFAULT_CATEGORY,
) -> DataFrame:
    """Products with mean unit cost (2 dp) and a category from ``category_map``.

    ``category_key`` derives the lookup key from the product name (identity by
    default).  The mean is taken over exact cents, so it does not depend on
    the order rows arrive in.
    """
    name = F.col("product_name")
    per_product = (
        orders.where(name.isNotNull())
        .groupBy("product_name")
        .agg(F.sum(cents(F.col("unit_cost"))).alias("_c"), F.count("unit_cost").alias("_n"))
    )
    key = category_key(name) if category_key else name
    return per_product.select(
        name,
        pd_round(amount(F.col("_c")) / F.col("_n").cast("double"), 2).alias("unit_cost"),
        F.coalesce(F.element_at(literal_map(category_map), key), F.lit(default_category)).alias("category"),
    )


def build_dim_product(orders: DataFrame, *args, **maps) -> DataFrame:
    """``product_attributes`` with dense ids in name order."""
    return with_dense_ids(product_attributes(orders, *args, **maps), ["product_name"], "product_id")


def supplier_attributes(orders: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Suppliers with a reliability class of their (unrounded) delay rate."""
    name = F.col("supplier_name")
    rates = orders.where(name.isNotNull()).groupBy("supplier_name").agg(F.avg("is_delayed").alias("_rate"))
    return rates.select(
        name,
        bin_right(F.col("_rate"), RELIABILITY_EDGES, RELIABILITY_LABELS).alias("reliability"),
        F.lit(country).alias("country"),
    )


def build_dim_supplier(orders: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """``supplier_attributes`` with dense ids in name order."""
    return with_dense_ids(supplier_attributes(orders, country), ["supplier_name"], "supplier_id")


def region_attributes(orders: DataFrame, zone_map: Mapping[str, str] = REGION_ZONE) -> DataFrame:
    """Distinct regions with a zone (no default: unmapped regions get null)."""
    name = F.col("region")
    regions = orders.where(name.isNotNull()).select(name.alias("region_name")).distinct()
    return regions.select("region_name", F.element_at(literal_map(zone_map), F.col("region_name")).alias("zone"))


def build_dim_region(orders: DataFrame, zone_map: Mapping[str, str] = REGION_ZONE) -> DataFrame:
    """``region_attributes`` with dense ids in name order."""
    return with_dense_ids(region_attributes(orders, zone_map), ["region_name"], "region_id")


def extended_ids(known: DataFrame, names: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(id_col, name_col): the known ids as they are, and ids after the largest for names not among them."""
    known = known.select(id_col, name_col)
    fresh = with_dense_ids(names.select(name_col).distinct().join(known, name_col, "left_anti"), [name_col], "_place")
    last = known.agg(F.max(id_col).alias("n")).first()["n"] or 0
    return known.unionByName(fresh.select((F.col("_place") + last).cast("int").alias(id_col), name_col))


def build_fact_orders(
    orders: DataFrame,
    dim_product: DataFrame,
    dim_supplier: DataFrame,
    dim_region: DataFrame,
    dim_rows: Mapping[str, int] | None = None,
) -> DataFrame:
    """Order fact: date key plus three left lookups, projected to 13 columns.

    ``dim_rows`` carries the row counts recorded when the dimensions were
    materialised; a dimension is broadcast only when that count is small.
    """
    rows = dim_rows or {}
    fact = orders.withColumn("date_id", cal.date_key(F.col("order_date")))
    fact = lookup_join(fact, dim_product.select("product_id", "product_name"), "product_name", "left", rows.get("dim_product"))
    fact = lookup_join(fact, dim_supplier.select("supplier_id", "supplier_name"), "supplier_name", "left", rows.get("dim_supplier"))
    regions = dim_region.select("region_id", F.col("region_name").alias("region"))
    fact = lookup_join(fact, regions, "region", "left", rows.get("dim_region"))
    return fact.select(
        "order_id",
        "date_id",
        "product_id",
        "supplier_id",
        "region_id",
        "quantity_ordered",
        "unit_cost",
        "total_cost",
        "lead_time_days",
        "actual_delivery_days",
        "delay_days",
        "is_delayed",
        "warehouse_stock",
    )
