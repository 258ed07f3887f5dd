"""Personal data, pivot clustering and resampling against plain versions."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import common, pivots, private, queries, resample

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")

KINDS = ["email", "ip", "card", "phone"]
RULES = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                k == 0
                or (k == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                or (k == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (k == 3 and 9 <= len(digits) <= 15)
            ):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def base_row(doc_id, text):
    spans = base_spans(text)
    counts = [sum(1 for s in spans if s[1] == k) for k in range(4)]
    return (doc_id, *counts, hashlib.sha256(listed(spans).encode()).hexdigest())


def shown(rows):
    return sorted((tuple(r) for r in rows), key=repr)


TEXTS = [
    None,
    "",
    "a@b.c.@d.e x@y@z.com foo@bar a@b.c_d@e.f +1@2.3 %@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1..2.3.4 9.9.9.9. 300.300.300.300.1.1.1.1",
    "4111 1111 1111 1111, 4111111111111111 4111-1111-1111-1112 4111  1111 1111 1111",
    "4111111111111111 4111111111111111 0 00 12 123456789012 000000000000",
    "+1 (017) 555-7713 +49 30 1234567. +1234567 +1 (826) 555-4081 190.137.223.204 ++123456789",
    "ünïcode 😀 mail😀me@home.org, é4111111111111111 😀+44 20 7946 0958é",
    "x" * 900 + " " + "1" * 900 + " +1" + "(" * 900,
    "a@" + "b." * 900 + "c 7@" + "1." * 900,
    "me@x.org " * 900,
    "same@same.org",
    "same@same.org",
]


def test_base_spans_are_those_of_the_rules(spark):
    docs = common.table(spark, FOLDER, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = private.query(docs)
    assert shown(tuple(r)[:6] for r in got.collect()) == shown(base_row(*r) for r in rows)
    odd = [(i % 9 if i % 5 else None, t, "own") for i, t in enumerate(TEXTS)]
    given = spark.createDataFrame(odd, "doc_id long, text string, spans string").withColumns(
        {c: F.lit("own") for c in ("row", "base", "kind", "said_ip", "gaps_email", "all_card")}
    )
    got = private.query(given).collect()
    assert shown(tuple(r)[:6] for r in got) == shown(base_row(i, t) for i, t, _ in odd)
    for row in got:
        spans = [s.split(":") for s in row.spans.split(",") if s]
        assert spans == sorted(spans, key=lambda s: (int(s[1]), KINDS.index(s[0])))
        assert len(spans) == row.n_added + sum(row[f"n_{k}"] for k in KINDS)


def test_long_runs_take_time_in_proportion(spark):
    """Texts on which a pattern that tries every start would take hours."""
    texts = [
        "x" * 2_000_000, "1" * 2_000_000, "+1" + "(" * 2_000_000, "1." * 1_000_000, ":" * 2_000_000,
        "a@" + "b." * 500_000 + "c", "7 " * 1_000_000, "a at " * 400_000, "me@x.org " * 20_000,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in private.query(docs).collect()}
    assert (got[5].n_email, got[5].spans) == (1, f"email:0:{len(texts[5])}")
    assert got[8].n_email == 20_000 and got[8].spans.endswith(f",email:179991:{179991 + 8}")
    assert got[3].n_ip == 250_000 and all(got[i].spans == "" for i in (0, 1, 2, 4, 6, 7))


def test_texts_without_data_are_left_alone(spark):
    clean = [
        "Version 1.2.3.400 of 2024-05-12, order 4111 1111 1111 1112, look at google.com now.",
        "ISBN 978-3-16-148410-0, pages 12-19, 10:30:45, ratio 3:4, 1,234,567 of 12.345.678",
        "Meet me at noon dot matrix printers at home. Section 4.2.1.1000",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(clean)], "doc_id long, text string")
    assert [r.spans for r in private.query(rows).collect()] == ["", "", ""]
    none = private.query(rows.limit(0))
    assert none.collect() == [] and none.columns[:6] == [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
    ]


def test_other_writings_are_added(spark):
    """Each planted span is found, at its place, and no decoy."""
    planted = {
        "email": ["jane.doe [at] example [dot] com", "jim_7 at mail dot example dot org"],
        "ip": ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1:2"],
        "card": ["4111.1111.1111.1111", "5500/0000/0000/0004"],
        "phone": ["(555) 123-4567", "0044 207 946 0958"],
    }
    decoys = ["4111.1111.1111.1112", "10:20:30", "look at site.html", "12.345.678"]
    rows, want = [], {}
    for kind, said in planted.items():
        for text in said:
            for n in range(30):
                start = len(f"{n} words before: ")
                rows.append((len(rows), f"{n} words before: {text} and after"))
                want[rows[-1][0]] = f"{kind}:{start}:{start + len(text)}"
    rows += [(len(rows) + i, f"this is {d} here") for i, d in enumerate(decoys * 10)]
    rows += [(10_000 + i, f"call +1 (2{i:02d}) 555-2485 or me{i}@mail.com") for i in range(60)]
    got = {r.doc_id: r.spans for r in private.query(
        spark.createDataFrame(rows, "doc_id long, text string")
    ).collect()}
    found = {i: s for i, s in got.items() if i < 10_000 and s}
    assert found == want


def test_spans_lost_in_a_longer_match_are_added(spark):
    text = "a +1 (826) 555-4081 190.137.223.204 b 4111111111111111 4111111111111111 c"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = private.query(docs).first()
    assert (row.n_phone, row.n_card, row.n_ip) == (0, 0, 1)
    assert row.spans == "phone:2:19,ip:20:35,card:38:54,card:55:71"


def test_reliabilities_and_the_classifier_follow_the_votes():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.3
    # Labelers that are right so often; checks err as they are known to.
    right = np.array([0.95, 0.9, 0.7, 0, 0.6, 0.5, 0.8])
    rates = np.stack([np.stack([1 - right, 0 * right, right], axis=1), np.stack([right, 0 * right, 1 - right], axis=1)])
    rates[:, 3] = [(0.002, 0.098, 0.9), (0.85, 0.1, 0.05)]
    chance = rates[np.where(truth, 0, 1)]
    votes = (rng.random((len(truth), 7, 1)) > chance.cumsum(axis=2)[:, :, :2]).sum(axis=2)
    log = np.log(np.maximum(rates[:, np.arange(7), votes], 1e-12)).sum(axis=2)
    best = ((log[0] - log[1] + np.log(0.3 / 0.7)) > 0) == truth
    distinct, n = np.unique(votes, axis=0, return_counts=True)
    real, table = private.expectation_maximisation(distinct, n.astype(float))
    at = {tuple(v): p for v, p in zip(distinct, real)}
    said = np.array([at[tuple(v)] for v in votes]) > 0.5
    # Without a label nearly as good as knowing how reliable each labeler is.
    assert (said == truth).mean() > best.mean() - 0.01
    others = [0, 1, 2, 4, 5, 6]
    # What is believed beforehand weighs a tenth of the candidates, a quarter of real ones here.
    assert np.abs(table[0, others, 2] - right[others]).max() < 0.15
    x = np.concatenate([distinct == v for v in range(3)], axis=1).astype(float)
    w = private.logistic(x, real, n.astype(float))
    fitted = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert np.average(np.abs(fitted - real), weights=n) < 0.02


def test_running_sums_cross_blocks(spark):
    values = list(range(1000)) + [5] * 77
    frame = spark.createDataFrame([(values,), ([],), (None,)], "v array<bigint>")
    got = [r[0] for r in frame.select(private.running(F.col("v"), private._add, 16)).collect()]
    assert got[0] == np.cumsum(values).tolist() and got[1] == [] and got[2] is None


def clusters(rows, k=40, rounds=5):
    whole = []
    for vec_id, v in rows:
        if v is None or len(v) != 64 or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((vec_id, [math.floor(256 * x) for x in v]))
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(whole, key=key)[:k]]

    def assign():
        out = []
        for _, v in whole:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centres)):
            mine = [v for (_, v), (o, _) in zip(whole, own) if o == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    inertia = Counter()
    for c, d in own:
        inertia[c] += d
    return [
        (i, c, d, inertia[c], sum(inertia.values()),
         hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(whole, own)
    ]


def test_clusters_are_those_of_comparing_all(spark):
    vectors = common.table(spark, FOLDER, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = queries.op12_pivot_clusters(spark, FOLDER)
    assert shown(got.collect()) == shown(clusters(rows))


def test_odd_vectors_cluster(spark):
    rng = np.random.default_rng(4)
    # Coarse values, so distances tie; repeated ids, nulls, wrong lengths and bad components.
    rows = [(int(i % 70), (rng.integers(-2, 3, 64) / 2).tolist()) for i in range(90)]
    rows += [(None, [0.5] * 64), (None, [0.5] * 64), (1, None), (2, []), (3, [1.0] * 63)]
    rows += [(4, [float("nan")] + [0.0] * 63), (5, [float("inf")] + [0.0] * 63)]
    rows += [(6, [None] + [0.0] * 63), (7, [0.0] * 64), (7, [-0.001] * 64), (8, [1000.25] * 64)]
    schema = "vec_id long, embedding array<double>"
    given = spark.createDataFrame(rows, schema).withColumns(
        {c: F.lit("own") for c in ("v", "far", "cluster", "n", "sums")}
    )
    assert shown(pivots.clustered(given).collect()) == shown(clusters(rows))
    few = rows[:7]
    got = pivots.clustered(spark.createDataFrame(few, schema))
    assert shown(got.collect()) == shown(clusters(few))
    empty = pivots.clustered(spark.createDataFrame([], schema))
    assert empty.collect() == [] and len(empty.columns) == 6
    huge = spark.createDataFrame([(1, [1e30] * 64), (2, [0.0] * 64)], schema)
    assert [r.vec_id for r in pivots.clustered(huge).collect()] == [2]


def test_bounds_leave_out_centroids_and_no_nearest():
    rng = np.random.default_rng(2)
    centres = rng.integers(-9, 9, (40, 64)) * 60
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-30, 30, (3000, 64))
    fixed = pivots.far_apart(centres, 12)
    own, far, measured = pivots.nearest(
        x, pivots.roots(x, fixed), centres, pivots.roots(centres, fixed)
    )
    all_far = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (own == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
    assert measured < 0.5 * all_far.size


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(lower)
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def drawn(docs, target, buckets=10000, percent=5):
    def count(texts):
        out = Counter()
        for t in texts:
            out.update(zlib.crc32(g.encode()) % buckets for g in grams(t)[1])
        return out

    s, t = count(x for _, x in docs), count(target)
    up, down = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * up / ((s[b] + 1) * down))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n, found = grams(text)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in found)
        said = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{said}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n >= 20])
    able = [r for r in rows if r[5]]
    order = sorted(able, key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(order[: percent * len(able) // 100]):
        row[4] = place + 1
    return [tuple(r[:5]) for r in rows]


def test_resampling_is_that_of_counting_one_by_one(spark):
    docs = [(r.doc_id, r.text) for r in common.table(spark, FOLDER, "documents").collect()]
    target = [r.text for r in common.table(spark, FOLDER, "benchmark").collect()]
    got = queries.op13_importance_resample(spark, FOLDER)
    assert shown(got.collect()) == shown(drawn(docs, target))


def test_odd_texts_resample(spark):
    long_word = "w" * 5000
    texts = [
        None, "", " ", "!?", "one", "One two", "a  b--c", "ÄÖ ä Ü 東京 😀x", "0 9 : @ [ ` { z",
        f"{long_word} x {long_word} " * 3, "same words " * 40, "same words " * 40, "x" * 255 + " y " * 30,
        " ".join(f"w{i % 7}" for i in range(3000)),
    ]
    docs = [(i if i % 4 else None, t) for i, t in enumerate(texts)] + [(10, "same words " * 40)] * 60
    target = ["same old words", None, "", "one two three"]
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("own") for c in ("score", "weight", "rank", "place", "part", "spread", "n")}
    )
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resampled(given, wanted, percent=50)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    assert shown(got.select(columns).collect()) == shown(drawn(docs, target, percent=50))
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 20
    none = resample.resampled(given.limit(0), wanted)
    assert none.collect() == []
    alone = resample.resampled(given, wanted.limit(0))
    assert shown(alone.select(columns).collect()) == shown(drawn(docs, []))


def test_appended_hashes_are_those_of_the_joined_text():
    import pyarrow as pa

    texts = ["a bb ccc", "d" * 300 + " e " + "f" * 260, "g", "", "a bb"]
    words = resample.words_of(pa.array(texts))
    got = Counter()
    for crc, at, doc in resample.features(words):
        got.update(zip(doc.tolist(), crc[at].tolist()))
    want = Counter((i, zlib.crc32(g.encode())) for i, t in enumerate(texts) for g in grams(t)[1])
    assert got == want
