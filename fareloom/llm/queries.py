"""The registered queries of this subpackage, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    bpe,
    discriminant,
    frames,
    linkgraph,
    mixing,
    ngrams,
    pivots,
    private,
    repeats,
    resample,
    routed,
    simhash,
    sitetree,
)
from fareloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judged(table(spark, sf_dir, "pages"))


@query
def op2_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(spark, sf_dir)


@query
def op3_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return discriminant.scored(table(spark, sf_dir, "documents"), labels)


@query
def op4_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.round_trip(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query
def op7_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.main_text(table(spark, sf_dir, "pages"))


@query
def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngrams.fit(docs, ngrams.labels_of(spark, sf_dir))
    return ngrams.judged(docs, model).select(
        "doc_id", *ngrams.BASE, "base_failed", "kept", "probability"
    )


@query
def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed.search(table(spark, sf_dir, "embeddings"))


@query
def op11_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.query(table(spark, sf_dir, "documents"))


@query
def op12_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.clustered(table(spark, sf_dir, "embeddings"))


@query
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL: dict[str, str] = {"op2_source_mixture": mixing.sql(), "op12_pivot_clusters": pivots.sql()}
