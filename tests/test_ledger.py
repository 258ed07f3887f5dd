"""The ledger as a stored state machine, and whole outcomes of requests."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from fareloom.operators import ledger

DAY = "2026-09-13 "


@pytest.fixture
def held(spark):
    def make(*rows):
        frame = spark.createDataFrame(
            [(k, o, "GIGM", s, DAY + t) for k, o, s, t in rows],
            "idempotency_key string, offer_id string, carrier string, state string, t string",
        )
        return frame.withColumn("created_at", F.col("t").cast("timestamp")).drop("t")

    return make


@pytest.fixture
def claims(spark):
    def make(*rows):
        frame = spark.createDataFrame(
            [(k, i, "x-1", "GIGM", 100.0, DAY + t) for k, i, t in rows],
            "idempotency_key string, request_id int, offer_id string, carrier string, "
            "quoted_price_ngn double, t string",
        )
        return frame.withColumn("requested_at", F.col("t").cast("timestamp")).drop("t")

    return make


@pytest.fixture
def changes(spark):
    def make(*rows):
        frame = spark.createDataFrame(
            [(k, DAY + t, n, c, v) for n, (k, t, c, v) in enumerate(rows)],
            "idempotency_key string, t string, number int, column_name string, new_value string",
        )
        return frame.withColumn("at", F.col("t").cast("timestamp")).drop("t")

    return make


def _by_key(rows):
    return {r.idempotency_key: r for r in rows.collect()}


def test_one_claim_wins_and_held_keys_stay(held, claims, changes):
    after = _by_key(
        ledger.ledger_after(
            held(("a", "x-9", "confirmed", "08:00:00")),
            claims(("a", 1, "09:00:00"), ("b", 3, "10:00:00"), ("b", 2, "10:00:00"), (None, 4, "10:00:00")),
            changes(),
        )
    )
    assert set(after) == {"a", "b"}
    assert (after["a"].state, after["a"].offer_id) == ("confirmed", "x-9")
    b = after["b"]
    assert (b.state, b.attempts, b.price_ngn_quoted, b.created_at) == ("pending", 0, 100.0, b.updated_at)


def test_changes_fold_in_order_whatever_order_they_come_in(held, claims, changes):
    rows = [
        ("a", "10:00:00", "state", "unknown"), ("a", "11:00:00", "state", "confirmed"),
        ("a", "10:30:00", "attempts", "2"), ("a", "11:00:00", "provider_reference", "REF1"),
        ("a", "10:10:00", "last_error", "timeout"), ("a", "11:00:00", "last_error", None),
        ("a", "07:00:00", "provider", "late"),  # before the booking was made
        ("a", "12:00:00", "offer_id", "x-2"), ("a", "12:00:00", "state", "refunded"),
        ("nobody", "12:00:00", "state", "failed"),
    ]
    start = held(("a", "x-1", "pending", "08:00:00"))
    for given in (rows, rows[::-1]):
        row = _by_key(ledger.ledger_after(start, claims(), changes(*given)))["a"]
        assert (row.state, row.attempts, row.provider_reference) == ("confirmed", 2, "REF1")
        assert (row.offer_id, row.provider) == ("x-1", None)
        assert str(row.updated_at).endswith("11:00:00")
    assert _by_key(ledger.ledger_after(start, claims(), changes(*rows)))["a"].last_error is None
    told = ledger.refused(start, changes(*rows)).collect()
    assert {(r.idempotency_key, tuple(r.problems)) for r in told} == {
        ("a", ("not_updatable",)), ("a", ("invalid_state",)), ("nobody", ("no_booking",)),
    }


def test_the_stored_table_takes_deliveries_more_than_once(spark, held, claims, changes, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.write_ledger(held(*[(f"k{i}", "x-1", "pending", "08:00:00") for i in range(40)]), path, 8)
    files = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    first = changes(("k1", "09:00:00", "state", "unknown"), ("n1", "09:30:00", "attempts", "1"))
    second = changes(("k1", "10:00:00", "state", "confirmed"))
    new = claims(("n1", 1, "09:00:00"))
    for batch in (first, second, second, first):
        ledger.bring_up_to_date(spark, path, new, batch, 8)
    rows = _by_key(ledger.read_ledger(spark, path))
    assert len(rows) == 41
    # The old delivery that came again did not undo the newer one.
    assert rows["k1"].state == "confirmed" and rows["n1"].attempts == 1
    assert rows["k2"].state == "pending"
    # Only the buckets of the two keys were rewritten.
    kept = files & set(glob.glob(f"{path}/bucket=*/*.parquet"))
    assert len(files - kept) <= 2 < len(files)
    ledger.bring_up_to_date(spark, path, new.limit(0), first.limit(0), 8)
    assert len(_by_key(ledger.read_ledger(spark, path))) == 41
    assert ledger.read_ledger(spark, str(tmp_path / "none")).collect() == []


def test_bookings_of_an_offer_come_oldest_first(held):
    rows = held(
        ("c", "x-1", "failed", "10:00:00"), ("a", "x-1", "pending", "09:00:00"),
        ("b", "x-1", "pending", "09:00:00"), ("d", "x-2", "pending", "08:00:00"),
    )
    got = ledger.oldest_first(rows, rows.filter("offer_id = 'x-1'")).orderBy("place").collect()
    assert [(r.place, r.idempotency_key) for r in got] == [(1, "a"), (2, "b"), (3, "c")]


def test_outcomes_tell_the_rise_the_provider_and_the_link(spark, offers):
    latest = offers({"offer_id": "x-1", "price_ngn": 30000.0}, {"offer_id": "x-2", "mode": "air", "price_ngn": 100.0})
    requests = spark.createDataFrame(
        [(1, "k1", "x-1", 25000.0), (2, "k2", "x-1", 30000.0), (3, "k3", "x-2", 100.0),
         (4, "k4", "gone", 1.0), (5, "k1", "x-1", 25000.0)],
        "request_id int, idempotency_key string, offer_id string, quoted_price_ngn double",
    ).withColumns({"email": F.lit("a@b.co"), "requested_at": F.lit(DAY + "09:00:00").cast("timestamp")})
    empty = spark.createDataFrame([], "idempotency_key string, offer_id string, state string, "
                                  "provider_reference string, last_error string")
    got = {r.request_id: r for r in ledger.outcomes(requests, latest, empty, True).collect()}
    assert got[1].state == "failed" and got[1].detail == (
        "The fare has risen 20.0% since you saw it - from NGN 25,000 to NGN 30,000. "
        "Nothing was booked. Search again to accept the new price."
    )
    assert (got[1].provider, got[1].handoff_url) == (None, None)
    assert got[2].state == "pending" and got[2].provider == "deeplink"
    assert got[2].handoff_url.startswith("https://gigm.example/booking?trip=LOSABV&from=LOS&to=ABV&date=2026-09-14")
    assert (got[3].provider, got[3].handoff_url) == ("carrier_api", None)
    assert got[4].state == "no_offer" and got[5].is_new is False
    out = ledger.outcomes(requests, latest, empty, True).withColumn(
        "at", F.lit(DAY + "09:00:01").cast("timestamp")
    )
    offers_of = latest.select("offer_id", "carrier")
    after = _by_key(
        ledger.ledger_after(empty.withColumn("created_at", F.lit(None).cast("timestamp")),
                            requests.join(offers_of, "offer_id"), ledger.changes_of(out))
    )
    assert (after["k1"].state, after["k1"].price_ngn_at_book) == ("failed", 30000.0)
    assert after["k1"].last_error == "price_changed: quoted 25000, now 30000"
    assert (after["k2"].state, after["k2"].provider) == ("pending", "deeplink")
    assert set(after) == {"k1", "k2", "k3"}
