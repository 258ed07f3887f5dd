"""Rows out of the ordinary that earlier versions lost, choked on or put in one task."""

from __future__ import annotations

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import common, frames, linkgraph, routed, sitetree

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")

VECTORS = "vec_id long, embedding array<double>"


def _all_nearest(rows, k=20):
    """(query_id, rank, vec_id, score) by comparing every row with all others of its length."""
    out = []
    for q, (qid, x) in enumerate(rows):
        if qid % 20:
            continue
        others = [
            (-sum(a * b for a, b in zip(x, y)), i, n)
            for n, (i, y) in enumerate(rows)
            if n != q and len(y) == len(x)
        ]
        out += [(qid, r + 1, i, -s) for r, (s, i, _) in enumerate(sorted(others)[:k])]
    return sorted(out)


def _found(frame):
    return sorted(tuple(r) for r in routed.search(frame).collect())


def test_repeated_ids_and_lengths_are_all_searched(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 60), (rng.integers(-8, 9, 4) / 4).tolist()) for i in range(150)]
    rows += [(20, [1.0, 0.0, 0.0, 0.5])] * 3  # the same row three times, each asks
    rows += [(int(i), (rng.integers(-8, 9, 3) / 4 + 9).tolist()) for i in range(35)]
    rows += [(40, [1.0] * 7)]  # alone with its length
    assert _found(spark.createDataFrame(rows, VECTORS)) == _all_nearest(rows)


def test_a_small_part_sends_its_queries_on(spark):
    """A group of eight far from the rest has a part of its own; its queries still get twenty."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 8)) * 6
    x = centres[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 8)) * 0.3
    x[:8] = rng.normal(size=(8, 8)) * 0.01 + 40
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    found: dict[int, list] = {}
    for q, rank, i, _ in _found(spark.createDataFrame(rows, VECTORS)):
        found.setdefault(q, []).append((rank, i))
    assert sorted(found) == list(range(0, 4000, 20))
    assert all([r for r, _ in f] == list(range(1, 21)) for f in found.values())
    wanted: dict[int, set] = {}
    for q in found:
        score = x @ x[q]
        score[q] = -np.inf
        wanted[q] = set(np.argsort(-score)[:20].tolist())
    hits = sum(len({i for _, i in found[q]} & wanted[q]) for q in found)
    assert hits >= 0.9 * 20 * len(found)


def _texts(spark, pages, host="deep.example"):
    rows = [(i, f"http://{host}/{i}", p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in sitetree.main_text(frame).collect()}


def _words(i, n=60):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_deep_pages_lose_their_layout_too(spark):
    """1,500 levels, the host's notice at the bottom of them beside the page's own text."""
    deep = "<div>" * 1500
    pages = [f"<body>{deep}<p>We use cookies here, all of us do.</p><p>{_words(i)}</p>" for i in range(12)]
    assert _texts(spark, pages) == {i: _words(i) for i in range(12)}


def test_pages_of_very_many_levels_and_bytes():
    started = time.time()
    page = "<div class='a'>" * 50_000 + "<p>Down here</p>" + "</div>" * 50_000
    assert sitetree.extract(page, {1}) == "Down here"
    spelled = sitetree.parse(page)
    assert max(len(p) for p, _, _ in spelled.styles) < 1200
    large = "<body>" + f"<p>{_words(1, 600)}</p>" * 1400
    assert len(large) > 5_000_000 and sitetree.extract(large, set()).count("\n\n") == 1399
    assert time.time() - started < 60


def test_noise_above_a_further_chain_reaches_below():
    html = "<div class=x>" + "<div>" * 200 + "<p>Far below</p>" + "</div>" * 201 + "<p>Beside</p>"
    path = ">div.x"
    assert sitetree.extract(html, {sitetree._key(path)}) == "Beside"
    assert sitetree.extract(html, {sitetree._key(">nothing")}) == "Far below\n\nBeside"


def test_a_heading_on_a_twentieth_of_a_large_host_stays(spark):
    n = 600
    pages = [
        f"<body><p>Our notice of the site to all.</p>{'<h2>References</h2>' if i % 20 == 0 else ''}"
        f"<p>{_words(i, 30)}</p>"
        for i in range(n)
    ]
    wanted = {i: ("References\n\n" if i % 20 == 0 else "") + _words(i, 30) for i in range(n)}
    assert _texts(spark, pages, "large.example") == wanted


def test_shards_are_read_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "SHARD_BYTES", 20_000)
    docs = common.table(spark, FOLDER, "documents")
    shards = frames.write(docs, str(tmp_path / "tokens"))
    n = shards.count()
    assert n > 8
    read = frames.read(spark, shards)
    tasks = read.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > n // 2
    # Rows of no id, and of one, are cut into shards as well.
    for doc_id in (None, 7):
        one = docs.select(F.lit(doc_id).cast("bigint").alias("doc_id"), "text")
        assert frames.write(one, str(tmp_path / f"one-{doc_id}")).count() > 4
        got = frames.read(spark, frames.write(one, str(tmp_path / f"again-{doc_id}")))
        assert got.count() == docs.count()


def test_unfinished_tags_take_time_in_proportion(spark):
    started = time.time()
    pages = [("http://a.example/", "<a " * 350_000), ("http://b.example/", "<a x" + " href" * 100_000)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert {r.verdict for r in linkgraph.judged(frame).collect()} == {"allow"}
    assert time.time() - started < 60
