"""The prediction log and the kept latest state, across runs, failures and repeats."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fareloom.operators import contract, history
from fareloom.sources import predictions
from fareloom.sources.schemas import OFFER, OFFER_COLUMNS
from fareloom.streaming import flows, state


def _at(text):
    return F.lit(text).cast("timestamp")


@pytest.fixture
def predicted(spark):
    def make(*rows):
        frame = spark.createDataFrame(
            list(rows), "offer_id string, t string, probability double, price double"
        )
        return frame.select(
            "offer_id", F.col("t").cast("timestamp").alias("predicted_at"),
            (F.col("probability") >= 0.5).alias("will_rise"), "probability",
            F.lit("m-1").alias("model_version"), F.col("price").alias("price_at_prediction"),
        )

    return make


@pytest.fixture
def prices(spark):
    rows = [
        ("a", "2026-09-02 00:30:00", 120.0), ("a", "2026-09-02 01:00:00", 1.0),
        ("b", "2026-09-02 00:00:00", 80.0), ("c", "2026-09-03 00:00:00", 500.0),
    ]
    frame = spark.createDataFrame(rows, "offer_id string, t string, price_ngn double")
    return frame.select("offer_id", F.col("t").cast("timestamp").alias("fetched_at"), "price_ngn")


def _log(spark, path):
    rows = predictions.read_predictions(spark, path).collect()
    return {(r.offer_id, str(r.predicted_at)[:16]): r.actual_rose for r in rows}


def test_outcomes_are_filled_in_once_due(spark, predicted, prices, tmp_path):
    path = str(tmp_path / "log")
    rows = predicted(
        ("a", "2026-09-01 00:00:00", 0.9, 100.0), ("b", "2026-09-01 00:00:00", 0.2, 100.0),
        ("c", "2026-09-01 00:00:00", 0.7, 100.0), ("c", "2026-09-02 00:00:00", 0.7, 100.0),
        ("a", "2026-09-01 00:00:00", 0.9, 100.0),
    )
    predictions.append_predictions(rows, path)
    predictions.append_predictions(rows, path)
    first, second = "2026-09-01 00:00", "2026-09-02 00:00"
    open_ = {("a", first): None, ("b", first): None, ("c", first): None, ("c", second): None}
    assert _log(spark, path) == open_
    assert predictions.fill_in(spark, path, prices, _at("2026-09-01 23:00:00")) == []
    # Seen by then: b at the very moment it fell due, nothing of a yet.
    days = predictions.fill_in(spark, path, prices, _at("2026-09-02 00:10:00"))
    assert [str(d) for d in days] == ["2026-09-01"]
    assert _log(spark, path) == open_ | {("b", first): False}
    untouched = set(glob.glob(f"{path}/predict_day=2026-09-02/*.parquet"))
    before = set(glob.glob(f"{path}/predict_day=2026-09-01/*.parquet"))
    predictions.fill_in(spark, path, prices, _at("2026-09-02 12:00:00"))
    done = open_ | {("a", first): True, ("b", first): False}
    assert _log(spark, path) == done
    assert set(glob.glob(f"{path}/predict_day=2026-09-02/*.parquet")) == untouched
    after = set(glob.glob(f"{path}/predict_day=2026-09-01/*.parquet"))
    assert not before & after
    # Again: no day is rewritten, and an append does not open what is settled.
    assert predictions.fill_in(spark, path, prices, _at("2026-09-02 12:00:00")) == []
    predictions.append_predictions(rows, path)
    assert _log(spark, path) == done
    assert set(glob.glob(f"{path}/predict_day=2026-09-01/*.parquet")) == after
    # The last falls due later; c's first one never had a price in its time.
    predictions.fill_in(spark, path, prices, _at("2026-09-09 00:00:00"))
    assert _log(spark, path) == done | {("c", second): True}


def test_the_log_refuses_rows_that_are_no_predictions(spark, predicted, tmp_path):
    path = str(tmp_path / "log")
    good = ("a", "2026-09-01 00:00:00", 0.9, 1.0)
    for bad in (("a", "2026-09-01 00:00:00", 1.5, 1.0), (None, "2026-09-01 00:00:00", 0.5, 1.0)):
        with pytest.raises(ValueError, match="prediction log"):
            predictions.append_predictions(predicted(good, bad), path)
    assert not os.path.exists(path)
    predictions.append_predictions(predicted(), path)
    assert not os.path.exists(path)
    codes = contract.prediction_problems()
    rows = predicted(good, ("b", "2026-09-01 00:00:00", -0.1, 1.0)).select(codes.alias("p"))
    assert [r.p for r in rows.collect()] == [[], ["probability"]]


@pytest.fixture
def deliver(offers, tmp_path):
    """Adds a file of offers to a folder that a stream reads."""

    def write(*changes):
        offers(*changes).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    return write


def _hour(hour, price, offer_id="x-1"):
    return {"offer_id": offer_id, "fetched_at": f"2026-09-13T{hour:02d}:00:00Z", "price_ngn": price}


def test_kept_state_follows_the_stream(spark, deliver, tmp_path):
    out, marks = str(tmp_path / "state"), str(tmp_path / "marks")

    def run():
        stream = spark.readStream.schema(OFFER).parquet(str(tmp_path / "in"))
        state.write_state(stream, out, marks, buckets=4, merge_every=2, once=True).awaitTermination()
        rows = state.read_state(spark, out).collect()
        assert len({r.offer_id for r in rows}) == len(rows)
        return {r.offer_id: r.price_ngn for r in rows}

    deliver(_hour(9, 1.0), _hour(9, 5.0, "x-2"))
    assert run() == {"x-1": 1.0, "x-2": 5.0}
    deliver(_hour(11, 3.0))
    assert run() == {"x-1": 3.0, "x-2": 5.0}  # merged into a base
    assert os.path.isdir(f"{out}/current/version=1") and os.path.isdir(f"{out}/base/version=1")
    deliver(_hour(10, 2.0), _hour(9, 7.0, "x-3"))
    assert run() == {"x-1": 3.0, "x-2": 5.0, "x-3": 7.0}  # an old replay changes nothing
    deliver(_hour(12, 9.0, "x-2"))
    assert run() == {"x-1": 3.0, "x-2": 9.0, "x-3": 7.0}
    assert os.path.isdir(f"{out}/current/version=3")
    asked = state.read_state(spark, out, ["x-2", "nobody"], buckets=4)
    assert [(r.offer_id, r.price_ngn) for r in asked.collect()] == [("x-2", 9.0)]
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:200]
    # The same as grouping everything at once.
    batch = history.latest_offers(spark.read.schema(OFFER).parquet(str(tmp_path / "in")))
    assert {r.offer_id: r.price_ngn for r in batch.collect()} == run()


def test_a_merge_that_broke_off_is_not_seen(spark, offers, tmp_path):
    out = str(tmp_path / "state")
    one = offers(_hour(9, 1.0)).select(
        *OFFER_COLUMNS, F.to_timestamp("fetched_at").alias("observed_at"), F.lit(0).alias("bucket")
    )
    state._write(one, f"{out}/delta/batch=0")
    # A base without its mark, as an interrupted merge leaves it.
    state._write(one.withColumn("price_ngn", F.lit(99.0)), f"{out}/base/version=0")
    assert [r.price_ngn for r in state.read_state(spark, out).collect()] == [1.0]
    state.merge(spark, out, 0)
    state.merge(spark, out, 0)
    assert [r.price_ngn for r in state.read_state(spark, out).collect()] == [1.0]
    # A repeated batch that the base already holds is left out.
    state._write(one.withColumn("price_ngn", F.lit(7.0)), f"{out}/delta/batch=0")
    assert [r.price_ngn for r in state.read_state(spark, out).collect()] == [1.0]
    assert state.read_state(spark, str(tmp_path / "nowhere")).collect() == []


def test_a_failed_batch_is_repeated_with_the_same_rows(spark, deliver, tmp_path):
    marks, seen = str(tmp_path / "marks"), []

    def each(fail):
        def run(batch, number):
            if fail:
                raise RuntimeError("lost")
            seen.append((number, sorted(r.price_ngn for r in batch.collect())))

        stream = spark.readStream.schema(OFFER).parquet(str(tmp_path / "in"))
        flows.each_batch(stream, marks, run, once=True).awaitTermination()

    deliver(_hour(9, 1.0))
    each(False)
    deliver(_hour(10, 2.0))
    with pytest.raises(StreamingQueryException):
        each(True)
    deliver(_hour(11, 3.0))
    each(False)
    assert seen == [(0, [1.0]), (1, [2.0]), (2, [3.0])]
    assert len(os.listdir(f"{marks}/commits")) >= 3


@pytest.mark.parametrize(
    "body, codes",
    [
        ('"price_ngn":25000.0', []),
        ('"price_ngn":"25000"', ["type:price_ngn", "required:price_ngn"]),
        ('"price_ngn":null', ["required:price_ngn"]),
        ('"price_ngn":1.0,"duration_min":600.0', []),
        ('"price_ngn":1,"duration_min":600.5', ["type:duration_min", "required:duration_min"]),
        ('"price_ngn":1,"carrier":["GIGM"]', ["type:carrier", "required:carrier"]),
        ('"price_ngn":1,"zone":{"price_ngn":2}', ["unexpected:zone"]),
        ('"price_ngn":-1', ["range:price_ngn"]),
    ],
)
def test_raw_messages_are_checked_by_path(spark, body, codes):
    usual = {
        "offer_id": '"gigm-road-LOS-ABV-20260914T0600Z"', "carrier": '"GIGM"', "mode": '"road"',
        "origin": '"LOS"', "destination": '"ABV"', "depart_time": '"2026-09-14T07:00:00+01:00"',
        "duration_min": "600", "seats_left": "12", "booking_url": '"https://g.example"',
        "fetched_at": '"2026-09-13T12:00:00Z"',
    }
    rest = ",".join(f'"{k}":{x}' for k, x in usual.items() if f'"{k}"' not in body.split("{")[0])
    frame = spark.createDataFrame([(f"{{{body},{rest}}}", "own")], "value string, offer string")
    assert contract.check_messages(frame.drop("offer")).first()["contract_errors"] == codes
