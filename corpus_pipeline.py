"""A training-data pipeline of five of the operators, each on what the one before kept.

Quality rules, SimHash near-duplicates, repeated passages, mixture to target weights,
BPE tokens. Every stage is written as Parquet and read again, so a lost executor
repeats part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import bpe, mixing, ngrams, repeats, simhash
from fareloom.llm.common import prepare, stored, table, unused


def _as_documents(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in like.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the classifier reject go. Labels are those of the table."""
    prepare(spark)
    model = ngrams.fit(docs, ngrams.labels_of(spark, sf_dir))
    own = unused(docs, "quality_")
    kept = ngrams.judged(docs, model, prefix=own).where(f"{own}kept")
    return _as_documents(kept, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the smallest id stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; texts are the kept words, n_chars follows them."""
    prepare(spark)
    own = unused(docs, "removed_")
    cut = repeats.remove_repeats(docs, n_words=f"{own}from", n_removed=f"{own}words")
    if "n_chars" in docs.columns:
        cut = cut.withColumn(
            "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
        )
    return _as_documents(cut, docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows the budgets buy; a document read in two epochs is there twice."""
    prepare(spark)
    own = unused(docs, "read_")
    rows = mixing.mixed(docs, epoch=f"{own}epoch", tokens=f"{own}tokens")
    return _as_documents(rows, docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    return bpe.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mixture", source_mixture),
    ("bpe_tokens", bpe_tokens),
]

# Classifier, fingerprints and tokenizer are beyond SQL: tests hold brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
