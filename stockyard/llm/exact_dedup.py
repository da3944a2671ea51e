"""Exact de-duplication by two passes over a Bloom filter, in DataFrame operations only.

Pass one sets two bits of a 64-bit word for every text and keeps the bits that at least two
rows set, packed in bitmaps.  Pass two probes them: a row whose bits are not all kept is alone
with its text and passes straight through; only possibly repeated rows are shuffled and grouped.
The filter is broadcast, a large one slice by slice, so this holds at every size.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .store import col, materialise

#: Filter bits per row; a unique text is then taken for repeated about once in fifty.
BITS_PER_ROW = 16
#: Bits of one bitmap of the filter (Spark's own bitmap size, 4 KB).
BITMAP = 32768
#: Bitmaps of one slice of the filter: 128 MB are broadcast at most, whatever the filter's size.
SLICE = 32768


def normalised(text: Column) -> Column:
    """A null text as empty, A-Z lower-cased and nothing else."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only: lower() touches A-Z alone
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def digest(text: Column) -> Column:
    """Hex SHA-256 of the normalised text."""
    return F.sha2(normalised(text).cast("binary"), 256)


def probe_key(text: Column) -> Column:
    """A 64-bit hash that equal texts share.  Lower-casing all letters merges at most more texts."""
    return F.xxhash64(F.lower(F.coalesce(text, F.lit(""))))


def _spots(h: Column, words: int) -> tuple[Column, Column]:
    """The two bits of the filter that a hash sets, both in one 64-bit word."""
    base = F.pmod(F.shiftrightunsigned(h, 12), F.lit(words)) * 64
    return base + h.bitwiseAND(F.lit(63)), base + F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(63))


def _bitmap(at: Column) -> Column:
    return F.floor(at / BITMAP)


def repeated_filter(keys: DataFrame, words: int) -> DataFrame:
    """(bitmap, bits): the filter bits that two rows of ``keys`` (column h) set, packed by Spark's bitmaps."""
    at = keys.select(F.explode(F.array_distinct(F.array(*_spots(F.col("h"), words)))).alias("at"))
    twice = at.groupBy("at").agg(F.count("at").alias("n")).where("n > 1")
    return twice.groupBy(_bitmap(F.col("at")).alias("bitmap")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(BITMAP))).alias("bits"))


def _set(bits: Column, at: Column) -> Column:
    """Whether a bit of a bitmap is set: its byte as a Latin-1 character's number, shifted."""
    byte = F.ascii(F.decode(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return F.call_function("shiftright", byte, at.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def flag_repeated(rows: DataFrame, seen: DataFrame, words: int) -> DataFrame:
    """``rows`` (with a column h) plus ``maybe``: whether the filter may hold another row with its text.

    ``seen`` is broadcast: the whole filter, or the slice of it that holds the rows' bitmaps."""
    a, b = (F.pmod(at, F.lit(BITMAP)) for at in _spots(F.col("h"), words))
    named = seen.select(F.col("bitmap").alias("_bitmap"), F.col("bits").alias("_bits"))
    joined = rows.join(F.broadcast(named), _bitmap(_spots(F.col("h"), words)[0]) == F.col("_bitmap"), "left")
    maybe = F.coalesce(_set(F.col("_bits"), a) & _set(F.col("_bits"), b), F.lit(False))
    return joined.withColumn("maybe", maybe).drop("_bitmap", "_bits")


def _by_slice(rows: DataFrame, seen: DataFrame, words: int, each: Callable[[DataFrame, DataFrame], DataFrame], name: str) -> DataFrame:
    """``each`` of the flagged ``rows`` (with a column h) and the rows as they were.

    A filter of more than one slice is broadcast slice by slice.  The rows are first written by slice
    without an exchange (a task writes one file for each slice); equal texts share a slice, so ``each``
    is right on every slice alone, and its results are written one after the other."""
    slices = -(-words * 64 // (BITMAP * SLICE))
    if slices <= 1:
        return each(flag_repeated(rows, seen, words), rows)
    spark = rows.sparkSession
    of = F.floor(_bitmap(_spots(F.col("h"), words)[0]) / SLICE).cast("int")
    path = scratch_path(spark, "llm", f"{name}-by-slice")
    rows.withColumn("slice", of).write.partitionBy("slice").parquet(path)
    sliced = spark.read.schema(rows.withColumn("slice", of).schema).parquet(path)
    done = []
    for k in range(slices):
        some = sliced.where(F.col("slice") == k).drop("slice")
        part = seen.where(F.col("bitmap").between(k * SLICE, (k + 1) * SLICE - 1))
        done.append(scratch_path(spark, "llm", f"{name}-slice"))
        out = each(flag_repeated(some, part, words), some)
        out.write.parquet(done[-1])
    return spark.read.schema(out.schema).parquet(*done)


def _filter_words(rows: int) -> int:
    return max(1024, 1 << max(0, (rows * BITS_PER_ROW // 64 - 1).bit_length()))


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the largest id among the rows with an equal text (ids that are null come after
    all others; null if the group has no id) and kept tells whether the row bears it.  Rows
    that repeat both id and text are one document to this view and share ``kept``;
    ``deduplicate`` returns one of them.  Other columns are not read.
    """
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"), probe_key(col(text_col)).alias("h"), digest(col(text_col)).alias("sha")
    )
    rows = materialise(rows, "digests")
    words = _filter_words(rows.count())
    seen = materialise(repeated_filter(rows, words), "filter")
    return _by_slice(rows, seen, words, _annotated, "digests")


def _annotated(flagged: DataFrame, rows: DataFrame) -> DataFrame:
    maybe = flagged.where("maybe").select("doc_id", "sha")
    # A group's rows meet only as partial aggregates; its summary is joined back.  Summaries of hot
    # groups (each at least a thousandth of all rows, so at most a thousand) are broadcast.
    groups = materialise(maybe.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("sha").alias("group_size")), "groups")
    hot = F.broadcast(groups.where(F.col("group_size") >= max(2, rows.count() // 1000)))
    is_hot = maybe.join(hot, "sha")
    cold = maybe.join(hot.select("sha"), "sha", "left_anti").join(groups, "sha")
    alone = flagged.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"
    )
    order = ["doc_id", "keep_id", "group_size", "sha"]
    out = alone.unionByName(is_hot.select(order)).unionByName(cold.select(order))
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one with the largest id.

    Rows that pass the filter are not shuffled, at any size of the filter.  The others are aggregated
    to one whole row per text, map-side first, so a hot group costs one row per task.  Of rows that
    repeat the id the one whose other columns, then text, come last stays; a null id comes after all
    others.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[col(c) for c in names]).alias("row"), probe_key(col(text_col)).alias("h"))
    words = _filter_words(docs.count())
    seen = materialise(repeated_filter(packed.select("h"), words), "filter")
    text, key = F.col("row").getField(text_col), F.col("row").getField(id_col)
    ordered = [c for c, kind in docs.dtypes if c not in (id_col, text_col) and "map<" not in kind and "variant" not in kind]
    last = F.struct(key.isNotNull(), key, *[F.col("row").getField(c) for c in ordered], text)

    def stay(flagged: DataFrame, _: DataFrame) -> DataFrame:
        one = flagged.where("maybe").groupBy(digest(text).alias("sha")).agg(F.max_by("row", last).alias("row"))
        return flagged.where("not maybe").select("row").unionByName(one.select("row"))

    return _by_slice(packed, seen, words, stay, "rows").select("row.*")
