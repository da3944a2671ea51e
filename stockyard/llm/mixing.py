"""Mixing sources to target weights, in DataFrame operations only.

Words are summed per source, each source gets a target and a repetition rate
(target / size), and a document is emitted floor(rate) times plus one more time when its
hash-seeded coin falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.star import with_dense_ids
from .store import bounded, col, materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source is repeated at most so often.
MAX_RATE = 3
#: Sources up to this count are broadcast to the documents (counted); more are joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the seed and the key: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target, rate) from rows of (source, size).

    Sources in code point order, null last, weigh WEIGHTS in turn and share all words; a target
    above MAX_RATE times its source's size stops there and its excess is shared by the
    others by weight, until none is above.  A source without words has target 0 and rate 1:
    there is nothing to weigh, its documents are emitted once.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_dense_ids(totals.withColumn("missing", F.col("source").isNull()), ["missing", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1)
    ranked = materialise(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    # The level rises with every pass and stops when no further source is capped.
    level, capped = None, -1
    cap = MAX_RATE * F.col("source_size")
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        zero = F.lit(0).cast("long")
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, cap).otherwise(zero)).alias("held"),
            F.sum(F.when(over, zero).otherwise(F.col("weight"))).alias("open"),
            F.sum(over.cast("long")).alias("n"),
        ).first()
        if not row["open"] or row["n"] == capped:
            break
        level, capped = float(row["all"] - row["held"]) / float(row["open"]), row["n"]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level if level is not None else 0.0))
    size = F.col("source_size").cast("double")
    return ranked.withColumn("target", target).withColumn("rate", F.when(size > 0, F.col("target") / size).otherwise(F.lit(1.0)))


def with_copies(rows: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``rows`` (with _source, _key) plus the columns of their source and ``copies``."""
    named = targets.select(F.col("source").alias("_s"), "source_size", "target", "rate")
    joined = rows.join(bounded(named, BROADCAST_SOURCES), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    whole = F.floor("rate")
    return joined.withColumn("copies", whole + (coin(F.col("_key"), seed) < F.col("rate") - whole).cast("long"))


def coin_key(id_col: Column, text: Column) -> Column:
    """A document's coin hangs on its id; without one, on its text.  Repeated rows share a coin."""
    return F.coalesce(id_col.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def plan(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken): what the mix takes of every row of ``docs``.

    A null text has size 0, null sources are a source of their own.  No row is lost; taken is 0
    where the coin leaves a document out.  An empty table gives no rows.
    """
    rows = docs.select(
        col(id_col).alias("doc_id"),
        word_count(col(text_col)).alias("size"),
        col(source_col).cast("string").alias("_source"),
        coin_key(col(id_col), col(text_col)).alias("_key"),
    )
    rows = materialise(rows, "sizes")
    targets = source_targets(rows.select(F.col("_source").alias("source"), "size"))
    return with_copies(rows, targets, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, columns unchanged."""
    sized = docs.select(col(source_col).cast("string").alias("source"), word_count(col(text_col)).alias("size"))
    targets = source_targets(sized)
    packed = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"),
        col(source_col).cast("string").alias("_source"),
        coin_key(col(id_col), col(text_col)).alias("_key"),
    )
    copies = with_copies(packed, targets, seed)
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return copies.select("row", F.explode(times)).select("row.*")
