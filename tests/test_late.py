"""De-duplication by positions: same rows as the whole-row form, narrow shuffles, a hot order."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockyard.operators import clean as C
from stockyard.operators.clean import ROW, SLICE, clean_orders, dedupe_first, dedupe_late, dedupe_spread
from stockyard.plans import warehouse as W
from stockyard.sources import adapter


def layer(spark, rows, tmp_dir, buckets=8):
    df = spark.createDataFrame(rows, "order_id string, at int, wide string").repartition(5)
    return W._write_bucketed(W.with_positions(df), tmp_dir + "/raw", SLICE, buckets)


def test_same_rows_as_the_whole_row_form(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(f"O{rng.randrange(300)}" if rng.random() > 0.05 else None, k, f"text {k} " * 5) for k in range(2000)]
    rows += [("HOT", 10_000 + k, "hot") for k in range(3000)]  # long runs of rows that go: words without a bit
    t = layer(spark, rows, tmp_dir)
    late = dedupe_late(t, "order_id", ["at"])
    assert late.columns == ["order_id", "at", "wide"]
    want = dedupe_first(t.drop(SLICE, ROW), "order_id", ["at"])
    assert sorted(late.collect(), key=str) == sorted(want.collect(), key=str)
    assert late.where("order_id = 'HOT'").first().at == 10_000
    assert dedupe_late(t.where("false"), "order_id", ["at"]).collect() == []


def test_ties_are_told_apart_by_the_rest_of_the_row(spark, tmp_dir):
    rows = [("A", 1, w) for w in "xyzxyz"] * 50
    one = dedupe_late(layer(spark, rows, tmp_dir + "/1"), "order_id", ["at"]).collect()
    two = dedupe_late(layer(spark, rows[::-1], tmp_dir + "/2", 3), "order_id", ["at"]).collect()
    assert len(one) == 1 and one == two


def exchanges(df):
    """(name of the first column group, bytes written) of every exchange of the plan that ran."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name == "Exchange":
                out.append((node.output().mkString(","), node.metrics().apply("shuffleBytesWritten").value()))
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return out


def test_wide_rows_do_not_move(spark, tmp_dir):
    source = W.warehouse(spark, SF_SMALL).raw_orders
    note = F.concat_ws(" ", *[F.sha2(F.concat("order_id", F.lit(str(k))), 256) for k in range(4)])  # a free text in each row
    args = {"first_by": adapter.FIRST_BY, "category_map": adapter.PART_NOUN_CATEGORY, "category_key": adapter.part_noun, "zone_map": adapter.REGION_ZONE}
    star = W.build_warehouse(spark, source.withColumn("note", note), tmp_dir + "/wh", wide_feed=True, **args)
    raw = star.raw_orders
    late, whole = dedupe_late(raw, "order_id", adapter.FIRST_BY), dedupe_first(raw.drop(SLICE, ROW), "order_id", adapter.FIRST_BY)
    late.collect()
    whole.collect()
    moved = exchanges(late)
    assert moved and not any("note" in names or "supplier_name" in names for names, _ in moved)
    assert 0 < sum(b for _, b in moved) < 0.5 * sum(b for _, b in exchanges(whole))
    assert late.exceptAll(whole.select(late.columns)).count() == 0 and late.count() == whole.count()
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "partial_min" in plan
    # The same warehouse as from whole rows.
    default = W.build_warehouse(spark, source, tmp_dir + "/wh2", **args)
    assert star.orders.exceptAll(default.orders).count() == 0 and star.rows == default.rows
    assert star.fact_orders.exceptAll(default.fact_orders).count() == 0


def orders_feed(spark, n=20_000):
    """One key in a third of the rows, null keys, pairs of copies, ties by every column but the last."""
    k = F.col("id")
    key = F.when(k % 3 == 0, F.lit("HOT")).when(k % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("K"), F.floor(k / 4).cast("string")))
    return spark.range(n).select(key.alias("order_id"), ((k * 7919) % 101).cast("int").alias("at"), k.alias("v")).repartition(8)


def nodes(df):
    """The names of the nodes of the plan that ran, top-down."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            out.append(name)
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_cleaning_neither_sorts_nor_combines_before_the_shuffle(spark):
    raw = W.warehouse(spark, SF_SMALL).raw_orders
    out = clean_orders(raw, first_by=adapter.FIRST_BY)
    out.collect()
    names = nodes(out)
    below = names[names.index("Exchange") :]
    assert "Sort" not in below and not any("Aggregate" in n for n in below)
    whole, spread = dedupe_first(raw, "order_id", adapter.FIRST_BY), dedupe_spread(raw, "order_id", adapter.FIRST_BY)
    assert spread.columns == whole.columns
    assert spread.exceptAll(whole).count() == 0 and spread.count() == whole.count()


def test_spread_rows_keep_hot_keys_out_of_one_task(spark, monkeypatch):
    df = orders_feed(spark)
    want = sorted(dedupe_first(df, "order_id", ["at"]).collect(), key=str)
    assert sorted(dedupe_spread(df, "order_id", ["at"]).collect(), key=str) == want
    monkeypatch.setattr(C, "HOT_ROWS", 500)
    monkeypatch.setattr(C, "TASK_ROWS", 1000)
    out = dedupe_spread(df, "order_id", ["at"])
    assert sorted(out.collect(), key=str) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "REPARTITION_BY_NUM" in plan
    # Shuffled as read: the rows of all keys but the hot one.
    assert ", 20), REPARTITION_BY_NUM" in plan
    assert dedupe_spread(df.where("false"), "order_id", ["at"]).collect() == []


def test_cleaned_orders_come_in_files_of_some_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(W, "ORDER_FILE_ROWS", 100)
    star = W.build_warehouse(spark, W.warehouse(spark, SF_SMALL).raw_orders, tmp_dir + "/wh", first_by=adapter.FIRST_BY)
    per_file = star.orders.groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 100 and star.orders.count() == W.warehouse(spark, SF_SMALL).orders.count()
