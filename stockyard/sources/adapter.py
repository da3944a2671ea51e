"""Raw order feed derived from the TPC-H-style input tables.

The inputs carry no lead time, delay or stock, so those are derived by
integer arithmetic from the keys (the same expressions the SQL oracle uses).
``order_id`` is built from (order key, line number) and is *not* unique
across the join fan-out, which exercises de-duplication.

Line items meet orders while they are narrow, then part and supplier, which are
broadcast as long as their measured size allows.  Else, and for orders always,
Catalyst and AQE pick broadcast or sort-merge, and AQE
splits a skewed join key (one order, part or supplier with a third of all
lines).  No explicit repartition is added, since a user-requested exchange
would opt that join out of AQE's skew handling.  nation and region are
broadcast after their size is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import enrich_orders
from ..plans.joins import checked_broadcast
from .tables import read_table

# Tie-break columns that make "first copy of an order_id" deterministic:
# earliest order date, then the line's part, supplier, quantity, price and
# ship date (free of ties at every supplied scale factor).
FIRST_BY = ["order_date", "_partkey", "_suppkey", "_quantity", "_extendedprice", "_shipdate"]
# Lookup maps for this data set.  Category by the noun of the
# part name (gizmo deliberately unmapped -> 'Other'); zone by region name
# (Middle East deliberately unmapped -> null).
PART_NOUN_CATEGORY = {
    "Gear": "Hardware",
    "Bolt": "Hardware",
    "Ring": "Accessories",
    "Rod": "Accessories",
    "Plate": "Metalwork",
    "Anvil": "Metalwork",
    "Widget": "Devices",
}
REGION_ZONE = {
    "Africa": "Africa Zone",
    "America": "America Zone",
    "Asia": "Asia Zone",
    "Europe": "Europe Zone",
}


def part_noun(name):
    """Lookup key for ``PART_NOUN_CATEGORY``: the last word of the product name."""
    return F.element_at(F.split(name, " "), -1)


def raw_orders_from_tables(spark: SparkSession, base_dir: str) -> DataFrame:
    """Raw order feed (plus ``_``-prefixed tie-break columns), enriched."""
    li = read_table(
        spark,
        base_dir,
        "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"],
    )
    od = read_table(spark, base_dir, "orders", ["o_orderkey", "o_orderdate"])
    pt = read_table(spark, base_dir, "part", ["p_partkey", "p_name", "p_retailprice"])
    sp = read_table(spark, base_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    nation = read_table(spark, base_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, base_dir, "region", ["r_regionkey", "r_name"])

    geo = nation.join(checked_broadcast(region), nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", "r_name"
    )
    sup = sp.join(checked_broadcast(geo), sp.s_nationkey == geo.n_nationkey, "left").select("s_suppkey", "s_name", "r_name")

    # Left joins: a line whose part, supplier or order is missing stays, with nulls that the checks report.
    # Orders come first: they are the most, and lines are narrow as long as they hold numbers only.
    lines = li.join(od, li.l_orderkey == od.o_orderkey, "left")
    lines = lines.join(checked_broadcast(pt), F.col("l_partkey") == pt.p_partkey, "left")
    j = lines.join(checked_broadcast(sup), F.col("l_suppkey") == sup.s_suppkey, "left")

    ok, ln, pk, sk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    pname = F.col("p_name")
    lead = F.lit(10) + (ok * 7 + ln * 13 + pk * 5) % (F.lit(5) + (sk % 4) * 12)
    delay = F.when(
        (ok * 31 + ln * 17) % 100 >= F.lit(95) - (sk % 3) * 15,
        F.lit(1) + (ok + pk) % 14,
    ).otherwise(F.lit(0))
    stock = (ok * 11) % 100 + (
        F.ascii(pname) * 37 + F.ascii(F.split_part(pname, F.lit(" "), F.lit(2))) * 53 + F.length(pname) * 11
    ) % 700

    raw = j.select(
        F.concat(F.lit("ORD-"), ok.cast("string"), F.lit("-"), ln.cast("string")).alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        pname.alias("product_name"),
        F.col("s_name").alias("supplier_name"),
        F.col("r_name").alias("region"),
        F.col("l_quantity").cast("int").alias("quantity_ordered"),
        F.col("p_retailprice").alias("unit_cost"),
        lead.cast("int").alias("lead_time_days"),
        stock.cast("int").alias("warehouse_stock"),
        delay.cast("int").alias("delay_days"),
        ok.alias("_orderkey"),
        pk.alias("_partkey"),
        sk.alias("_suppkey"),
        F.col("l_quantity").alias("_quantity"),
        F.col("l_extendedprice").alias("_extendedprice"),
        F.col("l_shipdate").alias("_shipdate"),
    )
    return enrich_orders(raw)
