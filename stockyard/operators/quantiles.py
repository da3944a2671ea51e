"""Exact quantiles (linear interpolation) without collecting a column in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer; for a global quantile that is one task holding the whole
value domain.  Here the work is distributed:

1. count each distinct (column, value) pair (partial aggregation);
2. range-partition the pairs, sort inside partitions, tag rows with
   ``monotonically_increasing_id`` and checkpoint (tags stay fixed on retries);
3. per-partition totals (one row per partition and column: a proven bound)
   give each partition's offset; a running sum inside the partition gives
   each value's first global rank;
4. keep only the values whose rank range covers a target rank
   (``floor``/``ceil`` of ``(n - 1) * p``) and interpolate.

When the distinct (column, value) pairs are few (counted, at most
``small_pairs``), one running sum per column gives the first ranks instead of
steps 2 and 3; picking and interpolating are the same for both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_ROW_BITS = 33
SMALL_PAIRS = 1_000_000


def exact_quantiles(
    df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], small_pairs: int = SMALL_PAIRS
) -> DataFrame:
    """One row per column name: ``q0, q1, ...`` = exact quantiles for ``probs``.

    Values must be integral (``long``); scale decimals to integers first so
    the interpolation is exact."""
    probs = list(probs)
    shared_dir(df.sparkSession)  # checkpoint() needs the shared folder
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), c.cast("long").alias("v")) for n, c in columns.items()])
    long = df.select(F.inline(pairs)).where(F.col("v").isNotNull())
    counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)
    if counts.count() <= small_pairs:
        by_value = Window.partitionBy("column_name").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.select(
            "column_name",
            "v",
            "c",
            F.coalesce(F.sum("c").over(by_value), F.lit(0)).alias("_start"),
            F.sum("c").over(Window.partitionBy("column_name")).alias("_n"),
        )
    else:
        ranked = _ranked_by_partition(counts)
    return _interpolate(ranked, probs)


def _ranked_by_partition(counts: DataFrame) -> DataFrame:
    """(column_name, v, c, _start, _n): first rank of every value and its column's row count."""
    tagged = (
        counts.repartitionByRange("column_name", "v")
        .sortWithinPartitions("column_name", "v")
        .withColumn("_tag", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("_tag"), _ROW_BITS)
    per_part = tagged.groupBy(part.alias("_part"), "column_name").agg(F.sum("c").alias("_pc"))
    col_order = Window.partitionBy("column_name").orderBy("_part")
    offsets = per_part.select(
        "_part",
        F.col("column_name").alias("_cn"),
        F.coalesce(F.sum("_pc").over(col_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_pc").over(Window.partitionBy("column_name")).alias("_n"),
    )
    inside = Window.partitionBy(part, "column_name").orderBy("_tag").rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.withColumn("_before", F.coalesce(F.sum("c").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), (part == F.col("_part")) & (F.col("column_name") == F.col("_cn")))
        .withColumn("_start", F.col("_off") + F.col("_before"))
    )


def _interpolate(ranked: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The values at the target ranks, joined by straight lines."""

    def pos(p: float) -> Column:
        return (F.col("_n") - 1).cast("double") * F.lit(float(p))

    def covers(rank: Column) -> Column:
        return (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("c"))

    lo = [F.floor(pos(p)) for p in probs]
    hi = [F.ceil(pos(p)) for p in probs]
    hit = F.lit(False)
    for r in lo + hi:
        hit = hit | covers(r)
    picks = ranked.where(hit)

    aggs = []
    for i, p in enumerate(probs):
        aggs += [
            F.max(F.when(covers(lo[i]), F.col("v"))).alias(f"_lo{i}"),
            F.max(F.when(covers(hi[i]), F.col("v"))).alias(f"_hi{i}"),
            F.max(pos(p) - lo[i]).alias(f"_fr{i}"),
        ]
    got = picks.groupBy("column_name").agg(*aggs)
    out = [
        (
            F.col(f"_lo{i}").cast("double")
            + (F.col(f"_hi{i}") - F.col(f"_lo{i}")).cast("double") * F.col(f"_fr{i}")
        ).alias(f"q{i}")
        for i in range(len(probs))
    ]
    return got.select("column_name", *out)
