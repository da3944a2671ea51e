"""``corpus_pipeline.run`` on tables without rows and with extra columns."""

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def written(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_run_without_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.run(spark, written(spark, tmp_path, docs.limit(0))).count() == 0


def test_run_with_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = corpus_pipeline.run(spark, SF)
    more = docs.withColumns({c: F.lit(7) for c in ("h", "row", "slice", "sha", "score", "size", "bucket", "maybe")})
    wide = corpus_pipeline.run(spark, written(spark, tmp_path, more))
    assert sorted(map(tuple, wide.select(plain.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
