"""A training-data pipeline over ``documents``: filter, deduplicate, decontaminate, mix, write.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``.  All
but the last return the columns of ``documents``; the last returns the digest of the token
files.  Nulls, empty and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import decontaminate, jaccard_join, mixing, quality_rules, token_output
from tagweave.llm.common import scratch, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and don't diverge from their language."""
    return quality_rules.keep(docs, quality_rules.references(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by weight; a document that the mix takes n times is n rows."""
    return mixing.expand(mixing.mix(docs), docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    path = scratch(spark, "pipeline-tokens")
    token_output.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_output.read_token_files(spark, path, digest=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix),
    ("token-ID output", token_files),
]

# not expressible in SQL (chosen paths, dynamic program, tokenizer): tests hold the stages
# against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + "-".join(name.lower().split()))
    return docs
