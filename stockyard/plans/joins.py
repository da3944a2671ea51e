"""Join helpers with an explicit size check before any broadcast.

A side is broadcast only when its row count is known to be at most
``stockyard.broadcast.maxRows`` and the bytes of the columns it brings at most
``stockyard.broadcast.maxBytes``; otherwise the join is left to Catalyst and
AQE (sort-merge, runtime broadcast conversion, skew-join splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_max_bytes, broadcast_max_rows

#: Bytes a value of a fixed type, and a row, take in a broadcast table.
FIXED_BYTES, ROW_BYTES = 8, 16


class TableSize(int):
    """Rows of a written table; ``columns`` holds the bytes of each of its columns."""

    columns: dict[str, int]

    def __new__(cls, rows: int, columns: dict[str, int] | None = None) -> TableSize:
        size = super().__new__(cls, rows)
        size.columns = columns or {}
        return size

    def bytes_of(self, names: list[str]) -> int | None:
        """Bytes of some columns in a broadcast, or None where one of them was not measured."""
        if not all(n in self.columns for n in names):
            return None
        return ROW_BYTES * int(self) + sum(self.columns[n] for n in names)


def measure(df: DataFrame) -> TableSize:
    """Rows and bytes by column of ``df``, in one scan."""
    kinds = dict(df.dtypes)
    texts = [c for c, kind in kinds.items() if kind in ("string", "binary")]
    sums = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)).alias(f"b{i}") for i, c in enumerate(texts)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    fixed = {c: FIXED_BYTES * row["n"] for c, kind in kinds.items() if "<" not in kind}
    return TableSize(row["n"], fixed | {c: fixed[c] + row[f"b{i}"] for i, c in enumerate(texts)})


def bounded_rows(df: DataFrame, max_rows: int) -> int | None:
    """Row count if it is at most ``max_rows``, else None.  One distributed count."""
    n = df.count()
    return n if n <= max_rows else None


def checked_broadcast(df: DataFrame, known_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if its size is proven small, else ``df`` unchanged.

    ``known_rows`` is the size recorded when the table was materialised (a plain
    count has no bytes); when it is missing the side is measured here.
    """
    spark = df.sparkSession
    rows = known_rows if known_rows is not None else measure(df)
    if rows > broadcast_max_rows(spark):
        return df
    size = rows.bytes_of(df.columns) if isinstance(rows, TableSize) else None
    return df if size is not None and size > broadcast_max_bytes(spark) else F.broadcast(df)


def _skew_join_on(spark) -> bool:
    conf = spark.conf
    return (
        conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
        and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true"
    )


def hot_key_join(left: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Equi-join on ``key`` that keeps hot keys out of the shuffle.

    A key is hot when it has more left rows than an average shuffle partition,
    so there are at most as many hot keys as partitions (a proven bound).  Rows
    of hot keys join a broadcast of just those keys' dimension rows; all other
    rows take the ordinary shuffle join.  The result equals
    ``left.join(dim, key, how)`` for ``how`` in {"inner", "left"}."""
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    threshold = max(1, left.count() // parts)
    hot = left.groupBy(key).count().where((F.col("count") > threshold) & F.col(key).isNotNull()).select(key)
    if bounded_rows(hot, parts) in (None, 0):
        return left.join(dim, key, how)
    hot = F.broadcast(hot)
    hot_part = left.join(hot, key, "left_semi").join(F.broadcast(dim.join(hot, key, "left_semi")), key, how)
    cold_part = left.join(hot, key, "left_anti").join(dim, key, how)
    return cold_part.unionByName(hot_part)


def lookup_join(
    left: DataFrame,
    dim: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    dim_rows: int | None = None,
    check: bool = True,
) -> DataFrame:
    """Join a (possibly huge) left side to a dimension.

    With ``check`` the dimension is broadcast only after its size is proven;
    without it Catalyst decides from statistics.  A dimension too large to
    broadcast is joined by shuffle; hot keys are then split by AQE's skew-join
    handling, or, where that is switched off, isolated by ``hot_key_join``.
    """
    right = checked_broadcast(dim, dim_rows) if check else dim
    if right is not dim or not isinstance(on, str) or how not in ("left", "inner") or _skew_join_on(left.sparkSession):
        return left.join(right, on, how)
    return hot_key_join(left, dim, on, how)
