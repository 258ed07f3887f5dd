from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fareloom.operators import bookings, history, ops

LEDGER = (
    "idempotency_key string, offer_id string, state string, provider_reference string, "
    "last_error string"
)


@pytest.fixture
def wanted(spark):
    def make(*rows):
        usual = {"email": "a@b.co", "price": 25000.0, "key": None, "at": "2026-09-13 12:00:00"}
        full = [{**usual, **r} for r in rows]
        return spark.createDataFrame(
            [(i, r["at"], "o-1", r["price"], r["email"], r["key"]) for i, r in enumerate(full)],
            "request_id int, t string, offer_id string, quoted_price_ngn double, email string, "
            "idempotency_key string",
        ).select("request_id", F.col("t").cast("timestamp").alias("requested_at"), "offer_id",
                 "quoted_price_ngn", "email", "idempotency_key")

    return make


@pytest.fixture
def ledger(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), LEDGER)

    return make


def _claims(requests, held):
    return {r["request_id"]: r for r in bookings.claims(requests, held).collect()}


def test_one_winner_and_one_replay(wanted, ledger):
    out = _claims(
        wanted({}, {"email": " A@B.co", "at": "2026-09-13 12:00:01"}, {"price": 26000.0}),
        ledger(),
    )
    assert [out[i]["is_new"] for i in range(3)] == [True, False, True]
    assert out[1]["state"] == "pending" and out[1]["replayed"] is True
    assert out[0]["detail"] is None and "already started" in out[1]["detail"]


def test_a_simultaneous_race_has_one_winner_by_id(wanted, ledger):
    out = _claims(wanted(*[{"key": "same-key-1"}] * 20), ledger())
    assert [i for i, r in out.items() if r["is_new"]] == [0]


@pytest.mark.parametrize(
    "state, reference, error, said",
    [
        ("confirmed", "REF1", None, "already booked: REF1"),
        ("pending", None, None, "already started"),
        ("failed", None, "sold out", "already failed, not retried: sold out"),
        ("unknown", None, None, "outcome unknown"),
    ],
)
def test_a_taken_key_replays_its_booking(wanted, ledger, state, reference, error, said):
    held = ledger(("taken-key-1", "o-1", state, reference, error))
    (row,) = _claims(wanted({"key": "taken-key-1"}), held).values()
    assert (row["is_new"], row["state"]) == (False, state)
    assert row["detail"].startswith(said)


def test_price_rise_is_refused_and_a_fall_is_not(wanted, spark):
    live = spark.createDataFrame([("o-1", 25250.0)], "offer_id string, price_ngn double")
    requests = wanted({"price": 25000.0}, {"price": 24900.0}, {"price": 30000.0})
    rows = bookings.price_guard(requests, live).orderBy("request_id").collect()
    assert [r["status"] for r in rows] == ["ok", "price_changed", "ok"]
    assert rows[1]["last_error"] == "price_changed: quoted 24900, now 25250"
    assert rows[1]["rise_pct"] == 1.41
    gone = bookings.price_guard(requests, live.filter("false")).first()
    assert (gone["status"], gone["live_price_ngn"]) == ("no_offer", None)


def _fold(spark, *log):
    rows = [("k", i + 1, o, s, r) for i, (o, s, r) in enumerate(log)]
    frame = spark.createDataFrame(
        rows, "idempotency_key string, attempt int, outcome string, status int, read_only boolean"
    )
    out = bookings.attempt_outcomes(frame).first()
    return out["state"], out["attempts"], out["last_error"], out["any_ambiguous"]


OK, TIMEOUT = ("ok", 200, False), ("timeout", None, False)
NO_ROUTE, BUSY, REFUSED = (
    ("connect_error", None, False), ("http", 503, False), ("http", 422, False),
)


@pytest.mark.parametrize(
    "log, expected",
    [
        ([TIMEOUT, OK], ("unknown", 1, "timeout", True)),
        ([NO_ROUTE, OK], ("confirmed", 2, None, False)),
        ([REFUSED, OK], ("failed", 1, "rejected", False)),
        ([BUSY, BUSY, BUSY, OK], ("unknown", 3, "unavailable", True)),
        ([NO_ROUTE] * 4, ("failed", 3, "unreachable", False)),
        ([BUSY, NO_ROUTE, NO_ROUTE], ("failed", 3, "unreachable", True)),
        ([("http", 429, False), OK], ("confirmed", 2, None, True)),
        ([("http", 401, False)], ("failed", 1, "misconfigured", False)),
        ([("unreadable", 200, False)], ("unknown", 1, "timeout", True)),
        ([("timeout", None, True), OK], ("confirmed", 2, None, False)),
        ([("transport_error", None, False), OK], ("confirmed", 2, None, False)),
    ],
)
def test_attempt_logs_fold_to_a_state(spark, log, expected):
    assert _fold(spark, *log) == expected


def test_reconcile_confirms_what_exists_and_fails_what_does_not(spark, ledger):
    held = ledger(
        ("k1", "o", "unknown", None, None), ("k2", "o", "unknown", None, None),
        ("k3", "o", "pending", None, None), ("k4", "o", "unknown", None, None),
    )
    orders = spark.createDataFrame(
        [("ord_1", "BR1", '{"idempotency_key":"k1"}'), ("ord_4", None, '{"idempotency_key":"k4"}'),
         ("ord_9", "BR9", None)],
        "id string, booking_reference string, metadata string",
    )
    out = {r["idempotency_key"]: r for r in bookings.reconcile(held, orders).collect()}
    assert set(out) == {"k1", "k2", "k4"}
    assert (out["k1"]["state"], out["k1"]["provider_reference"]) == ("confirmed", "BR1")
    assert out["k4"]["provider_reference"] == "ord_4"
    assert out["k2"]["state"] == "failed" and out["k2"]["last_error"].startswith("reconciled")


def test_routing_needs_a_flight_and_the_api(spark):
    rows = spark.createDataFrame(
        [("a", "Air Peace", "air"), ("b", "GIGM", "road")],
        "offer_id string, carrier string, mode string",
    )
    on = [r["provider"] for r in bookings.routing(rows, True).orderBy("offer_id").collect()]
    off = [r["books_via_api"] for r in bookings.routing(rows, False).collect()]
    assert on == ["carrier_api", "deeplink"] and off == [False, False]


def test_pick_holdable_prefers_the_same_carrier(spark):
    requests = spark.createDataFrame(
        [(1, "Air Peace"), (2, "Arik Air"), (3, "Ibom Air"), (4, "Air Peace"), (5, "")],
        "request_id int, carrier string",
    )
    quotes = spark.createDataFrame(
        [
            (1, "q1", "AIR PEACE LTD", "90.0", False), (1, "q2", "Other", "10.0", False),
            (1, "q3", "Air Peace", "5.0", True), (2, "q4", "Other", None, False),
            (2, "q5", "Other", "70.0", False), (3, "q6", "Ibom Air", "1.0", None),
            (5, "q7", None, "3.0", False),
        ],
        "request_id int, quote_id string, owner_name string, total_amount string, "
        "requires_instant_payment boolean",
    )
    out = {r["request_id"]: r for r in bookings.pick_holdable(requests, quotes).collect()}
    assert (out[1]["quote_id"], out[1]["same_carrier"]) == ("q1", True)
    assert (out[2]["quote_id"], out[2]["same_carrier"]) == ("q5", False)
    assert out[3]["status"] == "instant_payment_only"
    assert out[4]["status"] == "no_quotes"
    assert (out[5]["quote_id"], out[5]["same_carrier"]) == ("q7", False)


def test_states_and_duplicate_keys(ledger):
    held = ledger(*[("k", "o", "pending", None, None)] * 2, ("j", "o", "failed", None, None))
    counts = {r["state"]: r["n"] for r in bookings.counts_by_state(held).collect()}
    assert counts == {"pending": 2, "failed": 1}
    dupes = history.duplicate_keys(held, ["idempotency_key"]).collect()
    assert [(r["idempotency_key"], r["n"]) for r in dupes] == [("k", 2)]


# ---------------------------------------------------------------- operations --


@pytest.fixture
def log(spark):
    def make(n, path, method="GET", client="c1", start=0):
        return spark.range(n).select(
            F.col("id").alias("request_id"),
            F.timestamp_millis(F.lit(1789300800000 + start) + F.col("id") * 10).alias("ts"),
            F.lit(client).alias("client"), F.lit(method).alias("method"), F.lit(path).alias("path"),
        )

    return make


@pytest.mark.parametrize(
    "n, path, method, over",
    [
        (21, "/search/nl", "GET", [20]),
        (30, "/search", "GET", []),
        (121, "/search", "GET", [120]),
        (12, "/book", "POST", [10, 11]),
        (12, "/book", "GET", []),
        (500, "/health", "GET", []),
    ],
)
def test_allowances_per_minute(log, n, path, method, over):
    rows = ops.rate_limited(log(n, path, method)).collect()
    assert sorted(r["request_id"] for r in rows) == over


def test_windows_clients_and_paths_count_apart(log):
    rows = (
        log(20, "/search/nl").unionByName(log(20, "/search/nl", client="c2"))
        .unionByName(log(20, "/search/nl", start=60_000))
    )
    assert ops.rate_limited(rows).count() == 0


def test_a_flood_is_cut_before_the_shuffle(log):
    text = ops.rate_limited(log(5000, "/book"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 2


def test_latency_share_and_tail(log):
    rows = log(101, "/search").withColumn("duration_ms", F.col("request_id").cast("double"))
    out = ops.latency_by_path(rows).first()
    assert (out["p95_ms"], out["n_requests"]) == (95.0, 101)
    assert out["share_over_target"] == 0.0


def test_weekly_unknowns_from_log_lines(spark):
    lines = spark.createDataFrame(
        [
            ('{"ts":"2026-09-13T23:59:59Z","event":"booking.state_changed","state":"unknown",'
             '"carrier":"GIGM"}',),
            ('{"ts":"2026-09-14T00:00:00Z","event":"booking.state_changed","state":"unknown",'
             '"carrier":"GIGM"}',),
            ('{"ts":"2026-09-14T00:00:00Z","event":"http.request"}',),
            ("not json",),
        ],
        "line string",
    )
    out = {(str(r["week"]), r["n"]) for r in ops.unknown_per_week(lines).collect()}
    assert out == {("2026-09-07", 1), ("2026-09-14", 1)}
