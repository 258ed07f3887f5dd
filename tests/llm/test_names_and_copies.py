"""Tables whose own columns are called like an operator's, and rows repeated many times."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

from fareloom.llm import common, mixing, repeats, simhash

TEXTS = [
    (1, " ".join(f"w{i}" for i in range(90)), "en", "src0"),
    (2, " ".join(f"w{i}" for i in range(30, 120)), "de", "src9"),
    (3, None, None, None), (4, "", "en", "src0"), (4, "", "en", "src0"),
    (None, "a few words only", None, "elsewhere"), (6, "x" * 50_000, "fr", "src1"),
]
NAMES = [
    "__fp", "__root", "__n", "__k", "__g", "__r", "__m", "__l", "__at", "__range", "__domain",
    "__lang", "__source", "__whole", "__rest", "__row", "__copy", "__N", "c0", "c1", "fp", "root",
    "n", "epoch", "n_tokens", "n_words", "n_removed",
]
OWN = "own value"


@pytest.fixture(scope="module")
def clashing(spark):
    common.prepare(spark)
    spark.conf.set("spark.sql.caseSensitive", "true")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    yield docs.withColumns({n: F.lit(OWN) for n in NAMES})
    spark.conf.set("spark.sql.caseSensitive", "false")


def _own(frame, taken=()):
    rows = frame.select(*[n for n in NAMES if n not in taken]).distinct().collect()
    return [set(r) for r in rows] == [{OWN}]


def test_near_duplicates_keep_columns_of_any_name(clashing):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns and _own(kept)
    groups = brute.simhash_groups([(r[0], r[1]) for r in TEXTS])
    assert {r.doc_id for r in kept.collect()} == {g[2] for g in groups}


def test_repeats_keep_columns_of_any_name(clashing):
    cut = repeats.remove_repeats(clashing)
    assert set(cut.columns) == set(clashing.columns) and _own(cut, ("n_words", "n_removed"))
    told = cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    assert brute.shown(told) == brute.shown(brute.repeats([(r[0], r[1]) for r in TEXTS]))


def test_mixture_keeps_columns_of_any_name(clashing):
    rows = mixing.mixed(clashing)
    assert set(rows.columns) == set(clashing.columns) and _own(rows, ("epoch", "n_tokens"))
    plain = mixing.mixed(clashing.select("doc_id", "text", "lang", "source"))
    columns = ["doc_id", "text", "lang", "source", "epoch", "n_tokens"]
    assert brute.shown(rows.select(columns).collect()) == brute.shown(plain.select(columns).collect())


def test_unused_prefix_is_free(spark):
    docs = spark.createDataFrame([(1, 2)], "__q_kept int, __Q__x int")
    assert common.unused(docs, "__q_") == "__q___"


def test_rows_repeated_beyond_a_group_are_spread(spark, monkeypatch):
    """Nine rows in a row's place stand for all copies, in several groups, and all come back."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", 2000)
    monkeypatch.setattr(repeats, "COPIES", 7)
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(1, long, {"a": 1}, None, "x")] * 61 + [(1, long, {"a": 1}, "x", None)] * 3
    rows += [(2, "short", None, None, None)] * 40 + [(3, None, None, None, None)] * 25
    rows += [(4, " ".join(f"u{i}" for i in range(60)), {}, "", "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, m map<string,int>, a string, b string")
    spread = repeats._few_copies(common.numbered(docs)[0], "c1")
    most = {r.c0: r.n for r in spread.groupBy("c0").agg(F.count("*").alias("n")).collect()}
    assert most == {1: 9 + 3, 2: 6, 3: 4, 4: 1}
    assert spread.agg(F.sum("__m")).first()[0] == len(rows)
    cut = repeats.remove_repeats(docs)
    told = cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    assert brute.shown(told) == brute.shown(brute.repeats([(r[0], r[1]) for r in rows]))
    assert cut.where("a is null and b = 'x'").count() == 61
    assert cut.where("a = 'x' and b is null").count() == 3


def test_two_repeated_rows_still_see_each_other(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_BYTES", 100)
    long = " ".join(f"v{i}" for i in range(40))
    docs = spark.createDataFrame([(1, long)] * 3, "doc_id int, text string")
    assert {(r.n_words, r.n_removed) for r in repeats.remove_repeats(docs).collect()} == {(40, 40)}
