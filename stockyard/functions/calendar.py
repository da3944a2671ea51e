"""Calendar attributes of a date column (the date dimension's columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Smart key ``yyyymmdd`` as int (``strftime('%Y%m%d')``)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_text(d: Column) -> Column:
    """``yyyy-MM-dd`` text."""
    return F.date_format(d, "yyyy-MM-dd")


def quarter(d: Column) -> Column:
    """``(month - 1) // 3 + 1``."""
    return F.quarter(d).cast("int")


def month_name(d: Column) -> Column:
    """Full English month name (``%B``)."""
    return F.date_format(d, "MMMM")


def weekday_name(d: Column) -> Column:
    """Full English weekday name (``%A``)."""
    return F.date_format(d, "EEEE")


def week_monday(d: Column) -> Column:
    """``%W``: Monday-based week of year, 0 before the first Monday.

    Not ISO ``weekofyear`` (2022-01-01 is ISO week 52 but ``%W`` week 0).
    ``weekday`` is 0 for Monday.
    """
    return F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")


def day_start(ts: Column) -> Column:
    """Truncate a timestamp to its date (``normalize``)."""
    return F.to_date(ts)
