"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import (decontaminate, divergence_audit, jaccard_join, katz, merkle, minhash_dedup, mixing, oracles, page_diff, quality_rules, sharding,
                          site_quality, token_output, url_filter)
from tagweave.llm.common import scratch

QUERIES: dict = {}
ORACLE: dict[str, str] = {"op3_jaccard_join": oracles.JACCARD, "op5_decontaminate": oracles.LEAKS,
                          "op6_quality_rules": oracles.QUALITY, "op11_merkle": oracles.merkle(),
                          "op12_minhash_dedup": oracles.DEDUP, "op13_divergence_audit": oracles.AUDIT}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed by weights 5, 2, 1 (see mixing)."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", *mixing.ADDED)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` dealt to 16 shards of equal row counts (see sharding)."""
    return sharding.shard(table(spark, sf_dir, "documents")).select("doc_id", *sharding.ADDED)


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` joined on five-word shingles at Jaccard 0.8 (see jaccard_join)."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


@query
def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` by text, host and path evidence (see site_quality)."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return site_quality.judge(docs, labels, site_quality.train(docs, labels))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of ``benchmark`` that each of all ``documents`` holds (see decontaminate)."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against the references of their languages (see quality_rules)."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.references(docs)).drop("class_distance", "word_distance")


@query
def op7_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages`` (see page_diff)."""
    return page_diff.extract(table(spark, sf_dir, "pages")).select("page_id", "url", *page_diff.ADDED)


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``pages`` url by the rules, else by the model (see url_filter)."""
    weights = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), weights) \
        .select("page_id", "host", "path", "rule", "verdict")


@query
def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by a Katz backoff model of their training fold (see katz)."""
    return katz.score(table(spark, sf_dir, "documents"))


@query
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token files and read back (see token_output)."""
    path = scratch(spark, "op10")
    token_output.write_token_files(table(spark, sf_dir, "documents"), path,
                                   public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_output.read_token_files(spark, path, digest=True)


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all ``documents``, climbed from every leaf (see merkle)."""
    return merkle.verify(table(spark, sf_dir, "documents"))


@query
def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` by components of near copies on two-word shingles (see minhash_dedup)."""
    return minhash_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (lang, source) of ``documents`` against its language and other sources (see divergence_audit)."""
    return divergence_audit.audit(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
