"""The pipeline against the operators' plain versions, stage by stage."""

from __future__ import annotations

import os

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fareloom.llm import common

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = common.table(spark, FOLDER, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = common.stored(stages["quality_rules"](spark, docs, FOLDER), "q")
    failed = {b[0] for b in brute.quality_base([tuple(r) for r in docs.select("doc_id", "text").collect()]) if b[-1]}
    ids = {r.doc_id for r in good.collect()}
    assert good.columns == columns and ids and not ids & failed
    single = common.stored(stages["near_duplicates"](spark, good, FOLDER), "s")
    groups = brute.simhash_groups([(r.doc_id, r.text) for r in good.collect()])
    assert {r.doc_id for r in single.collect()} == {g[2] for g in groups}
    cut = common.stored(stages["repeated_passages"](spark, single, FOLDER), "c")
    told = cut.select("doc_id", F.sha2("text", 256)).collect()
    wanted = brute.repeats([(r.doc_id, r.text) for r in single.collect()])
    assert brute.shown(told) == brute.shown([(w[0], w[3]) for w in wanted])
    mixed = common.stored(stages["source_mixture"](spark, cut, FOLDER), "m")
    assert mixed.columns == columns and mixed.count()
    assert mixed.select("doc_id", "text").subtract(cut.select("doc_id", "text")).count() == 0
    last = stages["bpe_tokens"](spark, mixed, FOLDER)
    assert last.count() == mixed.count()


def test_an_empty_table_passes_through(spark):
    docs = common.table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
