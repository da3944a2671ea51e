"""The corpus pipeline: toxicity, exact de-duplication, near de-duplication, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs.  All but the last return the columns of ``documents``.
Every stage works on all that the stage before it kept:

- toxicity: fits on the labelled rows of ``sf_dir`` that are in docs; drops rows predicted toxic.
- exact_dedup: of equal texts (A-Z lower-cased, null as empty) the largest doc_id stays.
- near_dedup: of each component of five-word-shingle links (Jaccard 0.8 or more) the smallest
  doc_id stays; rows without words or without doc_id are linked with nothing and stay.
- mixing: rows are repeated as the mix of sources takes them (0 to 3 times).
- bpe: (doc_id, source, n_tokens, ids) of every row.

Empty docs give an empty result of the same columns.  Extra columns of docs pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from stockyard.llm.store import materialise
from stockyard.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, carry=["source"]).select("doc_id", "source", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Nearest neighbours, MinHash components and BPE merges cannot be put in SQL; tests/llm holds
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
