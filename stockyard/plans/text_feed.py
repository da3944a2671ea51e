"""Stand-in input of the ``text_*`` queries: the order feed as a CSV would hold it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_ORDERS, column_names


def text_feed(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The feed as a CSV holds it: text cells, some with faults planted by order key.

    Quantities written as ``7.0`` or as no number, rows without a product, totals that
    are not quantity x cost, and a column with no value at all.  ``keep`` names columns that stay."""
    key = F.col("_orderkey")
    text = {c: F.col(c).cast("string") for c in column_names(RAW_ORDERS)}
    quantity = F.when(key % 50 == 7, F.lit("oops")).when(key % 50 == 8, F.concat(text["quantity_ordered"], F.lit(".0")))
    text["quantity_ordered"] = quantity.otherwise(text["quantity_ordered"])
    text["product_name"] = F.when(key % 97 != 3, F.col("product_name"))
    # Written from whole cents: decimals would take most of the time of a scan.
    total = F.rint(F.col("total_cost") * 100).cast("long") + F.when(key % 31 == 4, F.lit(100)).otherwise(F.lit(0))
    units = F.call_function("div", F.abs(total), F.lit(100)).cast("string")
    text["total_cost"] = F.concat(F.when(total < 0, F.lit("-")).otherwise(F.lit("")), units, F.lit("."), F.lpad((F.abs(total) % 100).cast("string"), 2, "0"))
    text["actual_delivery_days"] = F.lit(None).cast("string")
    text["is_delayed"] = F.when(F.col("is_delayed"), F.lit("True")).otherwise(F.lit("False"))
    return raw.select(*[c.alias(name) for name, c in text.items()], *[c for c in keep if c not in text])
