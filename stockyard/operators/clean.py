"""Order feed enrichment and cleaning (derived columns, de-duplication, types, names)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numeric import pd_round, whole_number
from ..functions.text import clean_name
from ..schemas import CLEAN_ORDERS, RAW_ORDERS, column_names
from ..session import broadcast_max_rows, shared_dir

# Bytes of names up to which the name map is broadcast.
MAP_MAX_BYTES = 64 << 20
NAME_COLUMNS = ("product_name", "supplier_name", "region")

# Hidden column added by the CSV reader: (file, block start, position) so that
# "first in file order" is well defined after Spark has split the file.
FILE_ORDER = "_file_order"
# Position of a row in the written raw layer: the task that wrote it, and its number there.
SLICE, ROW = "_slice", "_row"
# Holds the whole line of a CSV row with too few or too many cells.
MALFORMED = "_malformed"
# De-duplication: rows a task sorts in memory, hash slots in which hot keys are sought, least rows of a hot
# slot, and the tasks up to which Spark writes a shuffle without buffering rows (bypassMergeThreshold).
TASK_ROWS, SLOTS, HOT_ROWS, PLAIN_TASKS = 1_250_000, 1 << 16, 100_000, 200


def enrich_orders(raw: DataFrame) -> DataFrame:
    """Derived columns of the raw feed: order value, delivery days, delay flag."""
    return raw.withColumns(
        {
            "total_cost": F.col("quantity_ordered") * F.col("unit_cost"),
            "actual_delivery_days": F.col("lead_time_days") + F.col("delay_days"),
            "is_delayed": F.col("delay_days") > 0,
        }
    )


def _typed(name: str, kind: str):
    c = F.col(name)
    return c if kind == "string" else whole_number(c) if kind == "int" else c.try_cast(kind)


def typed_feed(text: DataFrame) -> DataFrame:
    """A feed of text cells with the types of ``RAW_ORDERS``; further columns stay.

    Cells that do not parse become null; ``bad_cells`` tells how many."""
    types = {f.name: f.dataType.simpleString() for f in RAW_ORDERS.fields}
    rest = [c for c in text.columns if c not in types]
    return text.select(*[_typed(c, t).alias(c) for c, t in types.items()], *[F.col(f"`{c}`") for c in rest])


def _fault_counts(text: DataFrame) -> list[tuple[str, Column]]:
    types = [(f.name, f.dataType.simpleString()) for f in RAW_ORDERS.fields if f.dataType.simpleString() != "string"]
    counts = [(c, F.count_if(F.col(c).isNotNull() & _typed(c, t).isNull())) for c, t in types]
    return [*counts, ("*", F.count(MALFORMED))] if MALFORMED in text.columns else counts


def observed_feed(text: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The typed feed, and a function that tells its faults as ``bad_cells`` counts them.

    They are counted while the feed is first written or otherwise read to its end: no scan of its own.
    Ask for them after that; before it the function waits."""
    counts = _fault_counts(text)
    seen = Observation()
    feed = typed_feed(text.observe(seen, *[n.alias(f"n{i}") for i, (_, n) in enumerate(counts)]))
    return feed.drop(MALFORMED), lambda: {c: seen.get[f"n{i}"] for i, (c, _) in enumerate(counts)}


def bad_cells(text: DataFrame) -> DataFrame:
    """(column_name, bad_cells): non-null cells of each typed column that do not parse, in one scan.

    A feed read with ``read_raw_orders_text`` also reports its malformed lines, as column ``*``."""
    counts = _fault_counts(text)
    wide = text.agg(*[n.alias(f"n{i}") for i, (_, n) in enumerate(counts)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("bad_cells")) for i, (c, _) in enumerate(counts)]
    return wide.select(F.inline(F.array(*rows)))


def sort_orders(orders: DataFrame) -> DataFrame:
    """Presentation order of the feed (by order date).  A global sort: use only for output."""
    return orders.orderBy("order_date", "order_id")


def dedupe_first(
    df: DataFrame, key: str, first_by: Sequence[str], colocate_by: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per ``key``: the first by ``first_by`` (rest of the row breaks ties).

    Written as an aggregate (``min`` of a struct led by the ordering columns):
    each map task collapses its copies of a key before the shuffle, so a key
    holding a third of all rows costs one row per task.  (A ``row_number() = 1``
    filter limits groups before its shuffle too, but sorts every task's rows.)  ``colocate_by`` names
    columns that ``key`` determines; grouping by them too lets an input that
    is already partitioned (bucketed) by them skip the shuffle.
    """
    first_by = list(first_by)
    group = [key, *colocate_by]
    rest = [c for c in df.columns if c not in group and c not in first_by]
    packed = F.struct(*[F.col(f"`{c}`") for c in first_by + rest])
    return df.groupBy(*group).agg(F.min(packed).alias("_first")).select(
        *[F.col(f"`{c}`") if c in group else F.col(f"_first.`{c}`").alias(c) for c in df.columns]
    )


def dedupe_spread(df: DataFrame, key: str, first_by: Sequence[str]) -> DataFrame:
    """The rows of ``dedupe_first``, with one shuffle of the feed and no sort that leaves memory.

    Where copies are few, sorting every map task's rows to combine them moves as many rows as without and
    spills once a task's share of a file no longer fits.  Here rows go to their key's task as they are read;
    there are as many tasks as keep ``TASK_ROWS`` rows each.  One scan of the key column (started while the
    plan is built) counts rows and finds the hash slots that hold hot keys; their rows alone are combined
    before the shuffle, as in ``dedupe_first``, so that no hot key lands whole in one task."""
    spark = df.sparkSession
    slot = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(SLOTS))
    sizes = df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    # At most rows / HOT_ROWS slots, and never more than SLOTS, come to the driver.
    large = F.collect_list(F.when(F.col("n") > HOT_ROWS, F.struct("slot", "n")))
    rows, large = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), large).first()
    hot = [s.slot for s in large if s.n > 4 * rows / SLOTS]
    tasks = max(-(-rows // TASK_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), PLAIN_TASKS))
    cold = df.where(~slot.isin(hot)) if hot else df
    out = dedupe_first(cold.repartition(tasks, F.col(f"`{key}`")), key, first_by)
    return out.unionByName(dedupe_first(df.where(slot.isin(hot)), key, first_by)) if hot else out


def dedupe_late(layer: DataFrame, key: str, first_by: Sequence[str]) -> DataFrame:
    """``dedupe_first`` over a written layer with positions, without moving its wide rows.

    ``layer`` is bucketed by ``SLICE`` (the task that wrote a row) and numbers the rows of a slice in ``ROW``.
    Only keys, ordering columns and positions are shuffled, copies of a key collapsing map-side.  The
    positions of the rows that stay go back as one bitmap for each slice, 64 rows to a word, and each
    bucket's rows are filtered where they are read.  Copies that ``first_by`` does not tell apart are
    ordered by a hash of the rest of the row."""
    rest = [F.col(f"`{c}`") for c in layer.columns if c not in (key, *first_by, SLICE, ROW)]
    order = F.struct(*[F.col(f"`{c}`") for c in first_by], F.hash(*rest).alias("_rest"), SLICE, ROW)
    first = layer.groupBy(key).agg(F.min(order).alias("_first")).select(f"_first.{SLICE}", f"_first.{ROW}")
    word, bit = F.shiftright(ROW, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col(ROW).bitwiseAND(F.lit(63)).cast("int"))
    marked = first.select(SLICE, word, bit.alias("_mask"))
    # Every word of a slice, so that a row's word is found by its place.
    ends = layer.groupBy(SLICE).agg(F.max(ROW).alias("_end"))
    blank = ends.select(SLICE, F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright("_end", 6))).alias("_word"), F.lit(0).cast("long").alias("_mask"))
    masks = marked.unionByName(blank).groupBy(SLICE, "_word").agg(F.bit_or("_mask").alias("_mask"))
    bits = masks.groupBy(SLICE).agg(F.sort_array(F.collect_list(F.struct("_word", "_mask"))).alias("_words"))
    bits = bits.select(F.col(SLICE).alias("_s"), F.col("_words._mask").alias("_bits"))
    set_ = F.getbit(F.get("_bits", F.shiftright(ROW, 6).cast("int")), F.col(ROW).bitwiseAND(F.lit(63)).cast("int")) == 1
    return layer.join(bits.hint("shuffle_hash"), (F.col(SLICE) == F.col("_s")) & set_, "left_semi").drop(SLICE, ROW)


def tidy_names(df: DataFrame, cols: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """``clean_name`` on ``cols``, evaluated once per distinct name when possible.

    Names have few distinct values.  The distinct names of ``source`` (a
    superset of those in ``df``, by default ``df``) are cleaned once and
    checkpointed (one scan of the name columns, started while the plan is
    built); if their count and bytes fit the broadcast limits they are looked
    up with broadcast joins, otherwise every row is cleaned in place."""
    src = source if source is not None else df
    shared_dir(df.sparkSession)  # checkpoint() needs the shared folder
    mapping = (
        src.select(F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias("_raw"))
        .where(F.col("_raw").isNotNull())
        .distinct()
        .select("_raw", clean_name(F.col("_raw")).alias("_clean"))
        .checkpoint(eager=True)
    )
    size = F.sum(F.octet_length("_raw") + F.octet_length("_clean"))
    rows, size = mapping.agg(F.count("_raw"), size).first()
    if rows > broadcast_max_rows(df.sparkSession) or (size or 0) > MAP_MAX_BYTES:
        return df.withColumns({c: clean_name(F.col(c)) for c in cols})
    out = df
    for c in cols:
        m = F.broadcast(mapping.select(F.col("_raw").alias(f"_r_{c}"), F.col("_clean").alias(f"_c_{c}")))
        out = out.join(m, out[c] == m[f"_r_{c}"], "left").withColumn(c, F.col(f"_c_{c}")).drop(f"_r_{c}", f"_c_{c}")
    return out


def clean_orders(
    raw: DataFrame, first_by: Sequence[str] | None = None, colocate_by: Sequence[str] = ()
) -> DataFrame:
    """Cleaned orders: de-duplicate on order_id, drop rows without id/product,
    enforce types, recompute ``total_cost``, 0/1 delay flag, tidy names.

    ``first_by`` orders the copies of an order_id; the first is kept.  By
    default the file order recorded by the CSV reader, else order date and
    the remaining columns.  The null-drop happens after de-duplication, so an
    order whose first copy lacks a product is dropped entirely.
    """
    if first_by is None:
        first_by = [FILE_ORDER] if FILE_ORDER in raw.columns else ["order_date"]
    if SLICE in raw.columns:
        deduped = dedupe_late(raw, "order_id", first_by)
    elif colocate_by:
        deduped = dedupe_first(raw, "order_id", first_by, colocate_by)
    else:
        deduped = dedupe_spread(raw, "order_id", first_by)
    deduped = deduped.na.drop(subset=["order_id", "product_name"])

    qty = whole_number(F.col("quantity_ordered"))
    cost = pd_round(F.col("unit_cost").try_cast("double"), 2)
    typed = deduped.withColumns(
        {
            "order_date": F.col("order_date").try_cast("date"),
            "quantity_ordered": qty,
            "unit_cost": cost,
            "total_cost": pd_round(qty * cost, 2),
            "is_delayed": F.col("is_delayed").try_cast("boolean").cast("int"),
            "lead_time_days": whole_number(F.col("lead_time_days")),
            "actual_delivery_days": whole_number(F.col("actual_delivery_days")),
            "delay_days": whole_number(F.col("delay_days")),
            "warehouse_stock": whole_number(F.col("warehouse_stock")),
        }
    )
    return tidy_names(typed, NAME_COLUMNS, source=raw).select(*column_names(CLEAN_ORDERS))
