"""Exact quantiles by rank refinement: a few counting passes, no sort and no shuffle of values.

Values are whole numbers.  A pass counts, in every column, how many values fall in each bucket of
2**shift consecutive numbers; the bucket that holds a target rank becomes that rank's interval, and the next
pass counts only inside it, with buckets 2**bits times narrower, until a bucket is one number.  A pass
shuffles at most one count for each column, interval, bucket and task, so its shuffle depends on neither
the number of rows nor that of distinct values.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of an interval: 2**BUCKET_BITS.
BUCKET_BITS = 12


@dataclass(frozen=True)
class Range:
    """Non-null values of a column, and the least and the largest of them (null if none)."""

    n: int
    low: int | None
    high: int | None


def ranges(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, Range]:
    """Counts and extremes of all columns in one scan."""
    aggs = []
    for k, c in enumerate(columns.values()):
        v = c.cast("long")
        aggs += [F.count(v).alias(f"n{k}"), F.min(v).alias(f"lo{k}"), F.max(v).alias(f"hi{k}")]
    row = df.agg(*aggs).first()
    return {name: Range(row[f"n{k}"], row[f"lo{k}"], row[f"hi{k}"]) for k, name in enumerate(columns)}


def bucket_counts(df: DataFrame, columns: Mapping[str, Column], shifts: Mapping[str, int], inside: Mapping[str, tuple[int, set[int]]]) -> DataFrame:
    """(column_index, bucket, c): rows by bucket (value >> shift) of each named column.

    Where ``inside`` names a column, only values whose wider bucket (value >> its shift) is one of its set count."""
    cells = []
    for k, (name, shift) in enumerate(shifts.items()):
        v = columns[name].cast("long")
        bucket = F.shiftright(v, shift)
        if name in inside:
            wide, kept = inside[name]
            bucket = F.when(F.shiftright(v, wide).isin(sorted(kept)), bucket)
        cells.append(F.struct(F.lit(k).alias("column_index"), bucket.alias("bucket")))
    long = df.select(F.inline(F.array(*cells))).where(F.col("bucket").isNotNull())
    return long.groupBy("column_index", "bucket").agg(F.count(F.lit(1)).alias("c"))


def values_at(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks: Mapping[str, set[int]],
    known: Mapping[str, Range],
    bits: int = BUCKET_BITS,
) -> dict[str, dict[int, int]]:
    """The values at the given ranks (from 0) of each column, by refinement."""
    found: dict[str, dict[int, int]] = {name: {} for name in ranks}
    # By column: the shift of the last pass, and for every open rank its bucket and the rows before the bucket.
    shift: dict[str, int] = {}
    place: dict[str, dict[int, tuple[int, int]]] = {}
    for name, wanted in ranks.items():
        r = known[name]
        if not r.n or not wanted:
            continue
        shift[name] = 63  # the buckets -1 and 0
        while shift[name] > 0 and (r.high >> shift[name] - 1) - (r.low >> shift[name] - 1) < 1 << bits:
            shift[name] -= 1
        place[name] = {rank: (0, 0) for rank in wanted}
    first = True
    while place:
        inside = {}
        if not first:
            for name, at in place.items():
                inside[name] = (shift[name], {b for b, _ in at.values()})
                shift[name] = max(shift[name] - bits, 0)
        names = {name: shift[name] for name in place}
        counts = defaultdict(list)
        for row in bucket_counts(df, columns, names, inside).collect():
            counts[list(names)[row["column_index"]]].append((row["bucket"], row["c"]))
        for name in list(place):
            at = {}
            for rank, (wide, before) in place[name].items():
                for bucket, c in sorted(counts[name]):
                    if not first and bucket >> (inside[name][0] - shift[name]) != wide:
                        continue
                    if rank < before + c:
                        at[rank] = (bucket, before)
                        break
                    before += c
            if shift[name] == 0:
                found[name] = {rank: bucket for rank, (bucket, _) in at.items()}
                del place[name]
            else:
                place[name] = at
        first = False
    return found


def quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probs: Sequence[float],
    known: Mapping[str, Range] | None = None,
    bits: int = BUCKET_BITS,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation for each column; nulls for a column without values.

    ``known`` saves the pass for counts and extremes.  The driver receives the counts of one pass: at most
    2**bits for each column and open interval (two for each probability)."""
    known = known or ranges(df, columns)
    ranks = {}
    for name, r in known.items():
        at = [float(r.n - 1) * float(p) for p in probs] if r.n else []
        ranks[name] = {math.floor(x) for x in at} | {math.ceil(x) for x in at}
    values = values_at(df, columns, ranks, known, bits)
    out: dict[str, list[float | None]] = {}
    for name, r in known.items():
        out[name] = []
        for p in probs:
            if not r.n:
                out[name].append(None)
                continue
            x = float(r.n - 1) * float(p)
            low, high = values[name][math.floor(x)], values[name][math.ceil(x)]
            out[name].append(float(low) + float(high - low) * (x - math.floor(x)))
    return out
