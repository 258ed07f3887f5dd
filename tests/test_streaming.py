from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fareloom.operators import history, normalise
from fareloom.sources import tables
from fareloom.sources.feeds import read_json
from fareloom.streaming import flows

from test_feeds import SAMPLES


@pytest.fixture
def feed_dir(tmp_path):
    """A folder per feed, to which files of messages can be added."""

    def write(feed, name, *changes):
        folder = tmp_path / "raw" / feed
        folder.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({**SAMPLES[feed], **c}) for c in changes]
        (folder / f"{name}.json").write_text("\n".join(lines) + "\n")
        return str(folder)

    return write


def _canonical(rows):
    return sorted(tuple(r) for r in rows)


def test_stream_and_batch_agree_over_all_feeds(spark, feed_dir, tmp_path):
    paths = {feed: feed_dir(feed, "a", {}, {}) for feed in SAMPLES}
    live = {f: read_json(spark, f, p, streaming=True) for f, p in paths.items()}
    still = {f: read_json(spark, f, p) for f, p in paths.items()}
    union = flows.union_feeds(live)
    assert union.isStreaming
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    flows.write_offers(union, out, marks, once=True).awaitTermination()
    batch = normalise.unify(still)
    assert _canonical(spark.read.schema(batch.schema).parquet(out).collect()) == _canonical(
        batch.collect()
    )


def test_restart_continues_and_redelivery_adds_nothing(spark, feed_dir, tmp_path):
    first = {"scraped_at": "2026-09-13T12:00:00Z", "fare": "NGN 100"}
    second = {"scraped_at": "2026-09-13T13:00:00Z", "fare": "NGN 200"}
    path = feed_dir("gigm", "a", first, first)
    out, marks = str(tmp_path / "history"), str(tmp_path / "marks")

    def run():
        offers = flows.union_feeds({"gigm": read_json(spark, "gigm", path, streaming=True)})
        flows.write_history(offers, out, marks, once=True).awaitTermination()
        return sorted(float(r["price_ngn"]) for r in tables.read_history(spark, out).collect())

    assert run() == [100.0]
    feed_dir("gigm", "b", first, second)
    assert run() == [100.0, 200.0]
    assert run() == [100.0, 200.0]
    # However late: a copy adds nothing, a fact never seen is kept.
    feed_dir("gigm", "c", {"scraped_at": "2026-09-20T12:00:00Z", "fare": "NGN 300"})
    run()
    feed_dir("gigm", "d", first, {"scraped_at": "2026-09-14T12:00:00Z", "fare": "NGN 400"})
    assert run() == [100.0, 200.0, 300.0, 400.0]


def test_latest_ignores_an_old_replay_and_compacts(spark, feed_dir, tmp_path):
    new = {"scraped_at": "2026-09-13T13:00:00Z", "fare": "NGN 200"}
    old = {"scraped_at": "2026-09-13T12:00:00Z", "fare": "NGN 100"}
    path = feed_dir("gigm", "a", new)
    out, marks = str(tmp_path / "latest"), str(tmp_path / "marks")

    def run():
        offers = flows.union_feeds({"gigm": read_json(spark, "gigm", path, streaming=True)})
        flows.write_latest(offers, out, marks, once=True).awaitTermination()
        return [r["price_ngn"] for r in flows.read_latest(spark, out).collect()]

    assert run() == [200.0]
    feed_dir("gigm", "b", old)
    assert run() == [200.0]
    feed_dir("gigm", "c", {"scraped_at": "2026-09-13T14:00:00Z", "fare": "NGN 300"})
    assert run() == [300.0]
    target = str(tmp_path / "compact")
    flows.compact_latest(spark, out, target)
    assert [r["price_ngn"] for r in flows.read_latest(spark, target).collect()] == [300.0]


def test_running_latest_equals_batch(spark, feed_dir):
    changes = [
        {"scraped_at": f"2026-09-13T{h:02d}:00:00Z", "fare": f"NGN {h}00", "dep_time": t}
        for h in (9, 12, 10) for t in ("07:00", "08:00")
    ]
    path = feed_dir("gigm", "a", *changes)
    offers = flows.union_feeds({"gigm": read_json(spark, "gigm", path, streaming=True)})
    query = (
        flows.running_latest(offers).writeStream.outputMode("complete").format("memory")
        .queryName("running_latest").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = normalise.unify({"gigm": read_json(spark, "gigm", path)})
    latest = history.latest_offers(batch, F.to_timestamp("fetched_at"))
    assert _canonical(spark.table("running_latest").collect()) == _canonical(latest.collect())


def test_bad_rows_stop_the_stream_or_go_to_quarantine(spark, feed_dir, tmp_path):
    bad = {"fare": "call us"}
    again = {"fare": "NGN 300"}
    path = feed_dir("gigm", "a", {}, again, bad)

    def start(out, **options):
        offers = flows.union_feeds({"gigm": read_json(spark, "gigm", path, streaming=True)})
        return flows.write_history(
            offers, str(tmp_path / out), str(tmp_path / f"{out}-marks"), once=True, **options
        )

    with pytest.raises(Exception, match="break the rules"):
        start("strict").awaitTermination()
    aside = str(tmp_path / "aside")
    start("kept", quarantine=aside).awaitTermination()
    kept = tables.read_history(spark, str(tmp_path / "kept")).collect()
    assert [float(r["price_ngn"]) for r in kept] == [300.0]
    refused = spark.read.parquet(f"{aside}/batch=0").collect()
    assert [r["problems"] for r in refused] == [["price_ngn"]]
    conflicts = spark.read.parquet(f"{aside}-conflicts/batch=0").collect()
    assert [r["deliveries"] for r in conflicts] == [2]
