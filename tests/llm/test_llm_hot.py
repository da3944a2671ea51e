"""Hot vertices and buckets: their rows are split over tasks, not gathered in one."""

import pytest
from pyspark.sql import functions as F

from stockyard.llm import graph, near_dedup

SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def low_thresholds(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_by_task(df):
    read = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))  # all columns are read
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), read).collect())


def test_star_of_many_edges_is_split(spark, low_thresholds):
    star = spark.range(1, 400_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    tasks = rows_by_task(graph._large_star(star.union(spark.range(500_000, 500_100).selectExpr("id AS u", "id + 1000 AS v"))))
    assert sum(tasks) == 400_100 and tasks[-1] < 100_000
    tasks = rows_by_task(graph._small_star(star.selectExpr("v AS u", "u AS v")))
    assert sum(tasks) == 400_000
    hot = spark.range(0, 400_000).select(F.lit(10**6).cast("long").alias("u"), F.col("id").alias("v"))
    tasks = rows_by_task(graph._small_star(hot))
    assert sum(tasks) == 400_000 and tasks[-1] < 100_000
    got = graph.components(star.where("v <= 50000"))
    assert got.where("component != 0").count() == 0 and got.count() == 50_001


def test_hot_bucket_is_split(spark, low_thresholds):
    members = spark.range(300_000).select(F.when(F.col("id") < 100_000, F.lit(1)).otherwise(F.col("id")).cast("long").alias("key"), F.col("id"), F.lit(1).cast("long").alias("n"))
    labels = spark.range(10).select("id", F.col("id").alias("component"))
    tasks = rows_by_task(near_dedup._blocks(members, labels, near_dedup.Params(block=1000)).select("key", "id"))
    assert tasks[-1] <= 10 * tasks[len(tasks) // 2]
