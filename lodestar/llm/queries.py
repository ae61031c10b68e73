"""Queries of the operators in this folder, bound to the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, divergence, fingerprints, jaccard_join, licenses, merkle, near_dedup, packing, prefix_trie, quality, sharding, token_counts, toxicity
from .divergence_sql import DIVERGENCE_SQL
from .jaccard_sql import JACCARD_SQL
from .tables import conversations, documents, labels
from .trie_sql import MERKLE_SQL, PREFIX_TRIE_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under a name."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return wrap


@query("op1_best_fit_shards")
def op1_best_fit_shards(spark, sf_dir):
    return sharding.shard(documents(spark, sf_dir), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), limit=512)


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    return bpe.digests(documents(spark, sf_dir))


@query("op7_minimum_slack_packing")
def op7_minimum_slack_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), capacity=2048, end_id=0)


@query("op4_nnpu_toxicity")
def op4_nnpu_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir), folds=4, held_out=2, threshold=0.3)


@query("op5_ftrl_quality")
def op5_ftrl_quality(spark, sf_dir):
    return quality.score_quality(documents(spark, sf_dir), labels(spark, sf_dir), folds=5, held_out=0, threshold=0.3)


@query("op9_order_minhash")
def op9_order_minhash(spark, sf_dir):
    return near_dedup.near_classes(documents(spark, sf_dir), words=5, least=0.8).select("doc_id", "class_id")


@query("op10_bottom_k_fingerprints")
def op10_bottom_k_fingerprints(spark, sf_dir):
    return fingerprints.against_edits(documents(spark, sf_dir), k=64, size=5)


@query("op3_divergence_rules", DIVERGENCE_SQL)
def op3_divergence_rules(spark, sf_dir):
    return divergence.judge(documents(spark, sf_dir)).drop("class_distance", "word_distance")


@query("op8_patience_licenses")
def op8_patience_licenses(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir), least=0.8)


@query("op11_jaccard_join", JACCARD_SQL)
def op11_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(documents(spark, sf_dir), words=4, percent=85)


@query("op12_prefix_trie", PREFIX_TRIE_SQL)
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(conversations(spark, sf_dir))


@query("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(documents(spark, sf_dir))
