"""Each operator against a plain version, and on rows that are out of the ordinary."""

from __future__ import annotations

import html as entities
import os
import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareloom.llm import (
    bpe, common, discriminant, frames, linkgraph, mixing, ngrams, queries, repeats, routed,
    simhash, sitetree,
)
from fareloom.llm.components import components

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")

LONG = " ".join(f"w{i}" for i in range(70))
ROWS = [
    (1, None, None, None), (2, "", "en", "src0"), (3, "a b", "en", "src0"),
    (3, "a b", "en", "src0"), (None, "x y z", "de", None), (4, LONG, "en", "src1"),
    (5, "zero one " + LONG + " tail", None, "elsewhere"), (6, "The Same. " * 40, "fr", "src9"),
    (7, "Ünïcode\u00a0wörds\x1cand\x0bspaces 😀 " + "y" * 9000, "en", "src0"), (None, None, "", ""),
]
CLASHES = ["score", "kept", "fp", "root", "part", "g", "n", "epoch", "n_tokens", "key", "label"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns of clashing names."""
    common.prepare(spark)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def got(df, *columns):
    return brute.shown(df.select(*columns).collect() if columns else df.collect())


PAIRS = [(r[0], r[1]) for r in ROWS]


def test_repeated_passages_go(docs, rows, odd):
    for frame, plain in ((docs, rows), (odd, PAIRS)):
        cut = repeats.remove_repeats(frame).withColumn("sha", F.sha2("text", 256))
        assert got(cut, "doc_id", "n_words", "n_removed", "sha") == brute.shown(brute.repeats(plain))
        assert set(frame.columns) <= set(cut.columns)
    assert repeats.remove_repeats(odd.limit(0)).count() == 0


def test_short_windows_inside_one_document(spark):
    plain = [(1, "a a a a a a b c a a a b"), (2, "b c a a x y z"), (3, "q")]
    frame = spark.createDataFrame(plain, "doc_id long, text string")
    cut = repeats.remove_repeats(frame, window=3).withColumn("sha", F.sha2("text", 256))
    wanted = brute.shown(brute.repeats(plain, 3))
    assert got(cut, "doc_id", "n_words", "n_removed", "sha") == wanted


def test_a_passage_everywhere_is_sent_once_a_group(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    plain = [(i, f"a{i} b{i} " * (i % 3) + passage + f" c{i}") for i in range(300)]
    group = pa.table({"text": [t for _, t in plain], "__k": range(300), "__g": [0] * 300})
    sent = repeats.Repeats("text", repeats.WINDOW, 4).probe(group).to_pylist()
    hashes = sum(len(r["hashes"]) // 4 for r in sent)
    every = sum(max(0, len(t.split()) - 17) for _, t in plain)
    assert hashes < every / 4
    frame = spark.createDataFrame(plain, "doc_id long, text string")
    cut = repeats.remove_repeats(frame).withColumn("sha", F.sha2("text", 256))
    assert got(cut, "doc_id", "n_words", "n_removed", "sha") == brute.shown(brute.repeats(plain))
    assert cut.agg(F.min("n_removed")).first()[0] == 40


def test_simhash_groups(docs, rows, odd):
    for frame, plain in ((docs, rows), (odd, PAIRS)):
        assert got(simhash.groups(frame)) == brute.shown(brute.simhash_groups(plain))
    assert simhash.groups(odd.limit(0)).count() == 0


def test_one_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    groups = brute.simhash_groups(PAIRS)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        {g[2] for g in groups if g[2] is not None}
    )


def test_forest_finds_every_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 30), dtype=np.uint64)
    codes = np.unique(np.concatenate([base, (base[:, None] ^ flips).ravel()]))
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    for distance in (1, 2, 4):
        a, b = simhash.forest(np.zeros(len(codes), np.int64), codes, distance)
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance
        label = np.arange(len(codes))
        for _ in range(len(codes)):
            new = np.array([label[n].min() for n in near])
            if np.array_equal(new, label):
                break
            label = new
        root = dict(zip(codes.tolist(), codes.tolist())) | dict(zip(a.tolist(), b.tolist()))
        groups, wanted = {}, {}
        for c, w in zip(codes.tolist(), label.tolist()):
            groups.setdefault(root[c], set()).add(c)
            wanted.setdefault(w, set()).add(c)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    wanted = [(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 130)]
    assert got(found, "node", "root") == brute.shown(wanted)


def test_base_rules_and_classifier(spark, docs, rows, odd):
    labels = ngrams.labels_of(spark, FOLDER)
    model = ngrams.fit(docs, labels)
    judged = ngrams.judged(docs, model)
    assert got(judged, "doc_id", *ngrams.BASE, "base_failed") == brute.shown(brute.quality_base(rows))
    known = judged.join(labels, "doc_id").where("not base_failed")
    right = known.where((F.col("quality") == 1) == F.col("kept")).count()
    assert right >= 0.9 * known.count()
    told = ngrams.judged(odd, None)  # no model: the base rules decide
    wanted = [(*b, not b[-1]) for b in brute.quality_base(PAIRS)]
    assert got(told, "doc_id", *ngrams.BASE, "base_failed", "kept") == brute.shown(wanted)
    assert ngrams.judged(odd.limit(0), model).count() == 0
    assert ngrams.fit(odd, labels.limit(0)) is None


def test_all_labels_of_the_tables_are_learned_from(spark):
    labels = ngrams.labels_of(spark, "/root/testdata/sf0.1")
    assert labels.select("doc_id").distinct().count() <= ngrams.LABELLED_ROWS


def test_margins_equal_the_sum_over_features():
    weights = np.random.default_rng(3).normal(size=(5, 1 << ngrams.BITS)).astype(np.float32)
    split = [common.words(t) for _, t in PAIRS]
    for split_one, total in zip(split, ngrams.margins(weights, split)):
        at, value = ngrams.features(split_one)
        assert total == pytest.approx(float(weights.ravel()[at] @ value), abs=1e-3)


def test_grams_are_of_characters():
    texts = ["дом на", "日本語", "aé", "plain", "", "😀b"]
    found = list(ngrams.buckets([common.words(t) for t in texts]))[2:]
    for size, (h, counts) in zip((2, 3, 4), found):
        grams = [t[i : i + size] for t in texts for i in range(len(t) - size + 1)]
        assert counts.tolist() == [max(len(t) - size + 1, 0) for t in texts]
        assert len(h) == len(grams)
        assert len(set(h.tolist())) == len(set(grams))


def test_discriminant(spark, docs, rows, odd):
    labels = common.table(spark, FOLDER, "labels")
    found = discriminant.scored(docs, labels).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert len(found) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [(r.score, quality[r.doc_id]) for r in found if r.held_out and r.doc_id in quality]
    pairs = [(p > n) + 0.5 * (p == n) for p, a in held for n, b in held if a > b]
    assert np.mean(pairs) > 0.9
    told = discriminant.scored(odd, labels).collect()
    assert len(told) == len(ROWS) and all(r.held_out is not None for r in told)
    assert {r.score for r in discriminant.scored(odd, labels.limit(0)).collect()} == {0.5}
    assert discriminant.scored(odd.limit(0), labels).count() == 0


def test_tree_encoding_equals_the_library(docs, rows, odd):
    path = bpe.default_path()
    assert got(bpe.digests(docs)) == brute.shown(brute.tokens(rows, path))
    # Leaves of long texts as rows of their own, and windows around every cut.
    small = bpe.digests(odd, leaf=64, long=100)
    assert got(small) == brute.shown(brute.tokens(PAIRS, path))
    assert bpe.digests(odd.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text",
    ["a" * 900, "ab'cd" * 150, "!!'s" * 99, "😀é" * 120, "1" * 200, "x<|endoftext|>y " * 9,
     "theingtionqu" * 60, " \t\n", "İẖ̱ ÀÉ" * 40],
)
def test_joins_of_unsplit_texts(text):
    own = bpe.TreeEncoder(bpe.default_path(), leaf=24)
    wanted = brute.tokens([(0, text)], bpe.default_path())
    assert [(0, *next(iter(own.digests([text]))))] == wanted


def test_token_frames_round_trip(spark, docs, rows, odd, tmp_path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(frames.default_path())

    def plain(pairs):
        out, start = [], 0
        for i, t in sorted(pairs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = [*own.encode(t or "", add_special_tokens=False).ids, frames.END]
            out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        return out

    for frame, pairs in ((docs, rows), (odd, PAIRS)):
        assert got(frames.round_trip(frame)) == brute.shown(plain(pairs))
    assert frames.round_trip(odd.limit(0)).count() == 0
    shard = frames.write(docs, str(tmp_path / "tokens")).first()["file"]
    doc_id, text = rows[5]
    wanted = [*own.encode(text, add_special_tokens=False).ids, frames.END]
    assert np.frombuffer(frames.ShardReader(shard).find(doc_id)[0], "<u4").tolist() == wanted
    raw = bytearray(open(shard, "rb").read())
    raw[40] ^= 255  # a damaged frame is told
    open(shard, "wb").write(bytes(raw))
    with pytest.raises(Exception):  # noqa: B017
        reader = frames.ShardReader(shard)
        [reader.read(e) for e in reader.entries]


def test_long_documents_span_frames(tmp_path):
    with open(tmp_path / "s", "wb") as sink:
        writer = frames.ShardWriter(sink)
        held = [np.arange(n, dtype="<u4") for n in (0, 5, 3 * frames.FRAME_IDS + 7, 1)]
        for i, ids in enumerate(held):
            writer.add(i, ids.tobytes())
        writer.close()
    reader = frames.ShardReader(str(tmp_path / "s"))
    assert len(reader.sizes) >= 4
    assert [reader.read(e) for e in reader.entries] == [h.tobytes() for h in held]


def test_mixture_budgets(spark, odd):
    plan = mixing.Plan(share=1000, epochs=3)
    budget = {(r.domain, r.lang, r.source): r for r in mixing.budgets(odd, plan).collect()}
    total = sum(r.n_tokens for r in budget.values())
    spent = sum(r.n_budget for r in budget.values())
    assert all(r.n_budget <= r.cap for r in budget.values())
    assert total - len(budget) <= spent <= total  # nothing is short: all of it is given out
    mixed = mixing.mixed(odd, plan)
    read = mixed.groupBy("doc_id", "text").count()
    assert mixed.count() and read.where("text = 'a b' and count % 2 = 1").count() == 0
    assert mixing.mixed(odd.limit(0), plan).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    plan = mixing.Plan(
        domains={"d": ("a", "b"), "e": ("c",)}, domain_weights={"d": 1, "e": 1},
        lang_weights={}, source_weights={}, share=500, epochs=1,
    )
    texts = [("a", 2), ("b", 100), ("c", 100)]
    frame = spark.createDataFrame(
        [(i, "w " * n, "en", s) for i, (s, n) in enumerate(texts)],
        "doc_id long, text string, lang string, source string",
    )
    budget = {r.source: r.n_budget for r in mixing.budgets(frame, plan).collect()}
    assert budget == {"a": 2, "b": 48, "c": 50}  # half of 202, by halves, a's lack to b


PAGES = [
    (1, "https://WWW.X.com/fr/1?q", '<article><p>A &amp; B</p><p>c<br>d</article><footer>f</footer>'),
    (2, "http://y.net", None), (3, None, ""), (4, "no scheme", "<p>only <b>text</b></p>"),
    (5, "http://x.com/de/", '<a href="http://y.net/z">l</a><div class="comments"><p>r</p></div>'),
    (6, "http://a.example.org/en/12", "<main><h1>T</h1><aside>s</aside><p>u"),
    (6, "http://a.example.org/en/12", "<main><h1>T</h1><aside>s</aside><p>u"), (None, "x://org", "<"),
]


@pytest.fixture(scope="module")
def pages(spark):
    common.prepare(spark)
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return frame.withColumns({c: F.lit("own") for c in ("host", "path", "text", "noise", "rank")})


def test_url_rules_and_trust(pages):
    found = got(linkgraph.judged(pages), "page_id", "host", "path", "rule", "verdict")
    assert found == brute.shown(
        [
            (1, "www.x.com", "/fr/1", "com/fr/", "allow"), (2, "y.net", "", None, "allow"),
            (3, "", "", None, "allow"), (4, "", "", None, "allow"),
            (5, "x.com", "/de/", "com/de/", "block"),
            (6, "a.example.org", "/en/12", "example.org/en/1", "block"),
            (6, "a.example.org", "/en/12", "example.org/en/1", "block"),
            (None, "org", "", None, "allow"),
        ]
    )
    assert linkgraph.judged(pages.limit(0)).count() == 0


def test_ranks_equal_plain_iteration(spark):
    links = [("a", "b", 1.0), ("b", "c", 2.0), ("b", "a", 1.0), ("c", "a", 1.0)]
    seeds = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0}
    rank = {h: 0.15 * s for h, s in seeds.items()}
    out = {h: sum(w for s, _, w in links if s == h) for h in seeds}
    for _ in range(100):
        rank = {
            h: 0.15 * seeds[h] + 0.85 * sum(rank[s] * w / out[s] for s, d, w in links if d == h)
            for h in seeds
        }
    found = linkgraph.propagate(
        spark.createDataFrame(links, "src string, dst string, weight double"),
        spark.createDataFrame(list(seeds.items()), "host string, seed double"),
    )
    assert {r.host: r.rank for r in found.collect()} == pytest.approx(rank, abs=1e-3)


def test_small_seeds_reach_the_end_of_a_chain(spark):
    hosts = [f"h{i}" for i in range(8)]
    found = linkgraph.propagate(
        spark.createDataFrame(
            [(a, b, 1.0) for a, b in zip(hosts, hosts[1:])], "src string, dst string, weight double"
        ),
        spark.createDataFrame([(h, 1e-9 * (h == "h0")) for h in hosts], "host string, seed double"),
    )
    wanted = {h: 0.15 * 1e-9 * 0.85**i for i, h in enumerate(hosts)}
    assert {r.host: r.rank for r in found.collect()} == pytest.approx(wanted, rel=1e-6, abs=0)


def test_main_text(spark, pages):
    found = got(sitetree.main_text(pages), "page_id", "text", "n_chars")
    texts = ["A & B\n\nc d", "", "", "only text", "l", "T\n\nu", "T\n\nu", "<"]
    assert found == brute.shown([(p[0], t, len(t)) for p, t in zip(PAGES, texts)])
    assert sitetree.main_text(pages.limit(0)).count() == 0
    table = common.table(spark, FOLDER, "pages")
    own = {r.page_id: r.text for r in sitetree.main_text(table).collect()}
    for r in table.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h\d)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        blocks = [re.sub(r"\s+", " ", entities.unescape(x)).strip() for x in parts]
        assert own[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_a_layout_is_noise(spark):
    page = "<div class='x'><p>Same words here</p></div><div class='y'><p>Own text {0}</p></div>"
    rows = [(i, f"http://h.net/{i}", page.format(i)) for i in range(12)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in sitetree.main_text(frame).collect()}
    assert found == {i: f"Own text {i}" for i in range(12)}


def _main_texts(spark, pages):
    rows = [(i, f"http://h.net/{i}", page) for i, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in sitetree.main_text(frame).collect()}


def _prose(i, n=60):
    return " ".join(f"w{i * 7919 % 104729}x{j}" for j in range(n))


def test_a_notice_inside_every_article_goes(spark):
    page = "<article><h1>Title {0}</h1><p>{1}</p><p>Sign up for our letter</p><p>{2}</p></article>"
    pages = [page.format(i, _prose(i), _prose(i + 500, 20)) for i in range(12)]
    assert _main_texts(spark, pages) == {
        i: f"Title {i}\n\n{_prose(i)}\n\n{_prose(i + 500, 20)}" for i in range(12)
    }


def test_near_copies_are_no_layout(spark):
    """The copies' title and second paragraph are the same on 30 pages, yet no layout."""
    text = _prose(1, 200).split()
    first = [" ".join([*text[: 6 * i], f"edit{i}", *text[6 * i + 1 :]]) for i in range(30)]
    page = "<article><h1>The title</h1><p>{0}</p><p>Second part of it</p></article>"
    own = {i: f"The title\n\n{t}\n\nSecond part of it" for i, t in enumerate(first)}
    assert _main_texts(spark, [page.format(t) for t in first]) == own


def test_text_outside_an_article_stays(spark):
    page = "<div id=content><p>{0}</p></div><article class=card><p>Teaser {1}</p></article>"
    page += "<div class=end><p>The same everywhere</p></div>"
    found = _main_texts(spark, [page.format(_prose(i), i) for i in range(12)])
    assert found == {i: f"{_prose(i)}\n\nTeaser {i}" for i in range(12)}


def test_names_of_noise_and_of_content(spark):
    page = (
        "<body class='single-post has-sidebar'><div class='post-comments'><p>Reader {0}</p></div>"
        "<div id='content-sidebar'>Aside {0}</div><section class='social-history'><p>{1}</p>"
        "</section><article class='post comments-open'><p class='share-price'>Price {0}</p>"
        "<div class='entry-share'>Share it</div><div class='post-ad'>Own {0}</div></article></body>"
    )
    found = _main_texts(spark, [page.format(i, _prose(i)) for i in range(12)])
    assert found == {i: f"{_prose(i)}\n\nPrice {i}\n\nOwn {i}" for i in range(12)}


def test_a_weak_name_lessens_importance(spark):
    """A text on half of the pages is noise under a weak name only."""
    page = "<div class='{0}'><p>{1}</p></div><p>{2}</p>"
    for name, said in (("related", ""), ("remark", "Said on half\n\n")):
        texts = ["Said on half" if i < 6 else f"Said on {i}" for i in range(12)]
        pages = [page.format(name, t, _prose(i)) for i, t in enumerate(texts)]
        wanted = {i: (said if i < 6 else f"Said on {i}\n\n") + _prose(i) for i in range(12)}
        assert _main_texts(spark, pages) == wanted


def _nearest(rows, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        out[int(ids[i])] = set(ids[np.lexsort((ids, -score))[:k]].tolist())
    return out


def test_learned_partitions(spark):
    table = common.table(spark, FOLDER, "embeddings")
    found = {}
    for r in routed.search(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    wanted = _nearest([(r.vec_id, r.embedding) for r in table.collect()])
    hits = sum(len(found.get(q, set()) & near) for q, near in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def test_vectors_out_of_the_ordinary(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, None), (4, [0.0, 0.0]),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, [2.0, 1.0]),
        (20, [0.0, 1.0]), (None, [9.0, 9.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = got(routed.search(frame.withColumn("part", F.lit(1))))
    first = [(0, 1, 8, 2.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5), (0, 4, 20, 0.0)]
    second = [(20, 1, 8, 1.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert found == brute.shown(first + second)
    assert routed.search(frame.limit(0)).count() == 0


def test_every_number_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
