"""Numeric column helpers.

Two rounding rules are in use by the pipeline we mirror:

* SQL ``ROUND(x, n)`` - half away from zero on the decimal value.  Evaluated
  through ``decimal(28,10)`` so that Spark and any SQL oracle agree.
* pandas ``Series.round(n)`` - NumPy's ``rint(x * 10**n) / 10**n`` (half to
  even on the scaled binary value).  Written with the same IEEE operations.

Money is summed exactly: values with two decimals are summed as integer
cents (order-independent, stays in whole-stage codegen) and turned back into
a ``decimal(38,2)`` amount.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(col: Column) -> Column:
    """Integer of a cell the way a data frame casts it: ``7``, ``7.0`` and ``7.9`` (cut) give 7.

    What is no number gives null; ``bad_cells`` counts those.  Whole numbers (most cells) take no decimal:
    the type is known when the plan is made, and a text that parses as ``int`` is the same by both ways
    unless it holds a DEL, which ``int`` takes for white space."""
    kind, exact = F.typeof(col), col.try_cast("decimal(38,6)").try_cast("int")
    plain = (kind == "string") & ~col.cast("string").contains("\x7f")
    return F.when(kind.isin("int", "smallint", "tinyint"), col.try_cast("int")).when(plain, F.coalesce(col.try_cast("int"), exact)).otherwise(exact)


def sql_round(col: Column, n: int) -> Column:
    """SQL ``ROUND(x, n)``: half away from zero, returned as double."""
    return F.round(col.cast("decimal(28,10)"), n).cast("double")


def pd_round(col: Column, n: int) -> Column:
    """pandas ``.round(n)`` on a double: ``rint(x * 10**n) / 10**n``."""
    if n == 0:
        return F.rint(col)
    scale = float(10**n)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def clip(col: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """pandas ``clip``; a null stays null (``greatest``/``least`` skip nulls)."""
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(col.isNotNull(), out)


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with a zero divisor giving null (pandas ``replace(0, nan)``)."""
    return num / F.nullif(den, F.lit(0))


def bin_right(col: Column, edges: list[float], labels: list[str]) -> Column:
    """``pd.cut(x, edges, labels)``: right-closed bins, out of range -> null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (col > F.lit(float(lo))) & (col <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def cents(col: Column) -> Column:
    """Integer cents of an amount that carries at most two decimals."""
    return F.rint(col * F.lit(100.0)).cast("long")


def cents_to_amount(col: Column) -> Column:
    """Exact ``decimal(38,2)`` amount from summed cents."""
    return col.cast("decimal(38,0)") * F.lit(Decimal("0.01"))


def round_amount(sum_cents: Column, n: int = 0) -> Column:
    """SQL ``ROUND(SUM(money), n)`` from exact cents, as double."""
    return F.round(cents_to_amount(sum_cents), n).cast("double")


def amount(sum_cents: Column) -> Column:
    """Exact sum of money as double (correctly rounded once)."""
    return cents_to_amount(sum_cents).cast("double")

