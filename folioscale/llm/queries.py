"""The registered queries of this package, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, license, linededup, merkle, mixing, neardup, oracles, pii, sharding, topk, toxicity, trie, winnow
from .shared import table

#: For tests and this query only; a deployment passes its own secret.
PII_KEY = "folioscale-public-test-key"


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.license_scan(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40).drop("key")


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(table(spark, sf_dir, "pages"))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"), PII_KEY)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"), fanout=2).drop("lang", "rank", "n_levels")


def op12_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_likeness(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_topk, op2_neardup, op3_license, op4_mixing, op5_langid, op6_sharding, op7_linededup, op8_decontam, op9_toxicity, op10_pii, op11_merkle, op12_winnow, op13_trie, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
