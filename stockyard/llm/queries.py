"""Registered queries over the given tables, one for each operator."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bpe, conversations, exact_dedup, fingerprint, language, licenses, line_dedup, mixing, near_dedup, ngram_lm
from . import pii, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]

RANK_FILE = "byte_bpe_50k.tiktoken"
#: The registered pseudonym query's key; a user passes a secret one.
DEMO_KEY = b"stockyard demonstration key"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parents[2]
    sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/stockyard", "zip", root, "stockyard"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return read_table(spark, sf_dir, "documents")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_neighbours(documents(spark, sf_dir))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), near_dedup.Params(width=2))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(documents(spark, sf_dir), DEMO_KEY)
    return out.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    out = bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, keep_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.predict(docs, language.fit(docs))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(documents(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ngram_lm.score(docs, ngram_lm.fit(docs))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    told = read_table(spark, sf_dir, "conversations")
    return conversations.audit(told, conversations.damaged(told))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate(documents(spark, sf_dir))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_lines", "n_dropped", kept)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    ship(spark)
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_fingerprint": op1_fingerprint,
        "op2_near_dedup": op2_near_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_license_scan": op4_license_scan,
        "op5_mixing": op5_mixing,
        "op6_pseudonyms": op6_pseudonyms,
        "op7_bpe": op7_bpe,
        "op8_language": op8_language,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_line_dedup": op12_line_dedup,
        "op13_whitening": op13_whitening,
        "pipeline": pipeline,
    }
