from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fareloom.operators import contract, normalise
from fareloom.plans.views import KEYS, Views
from fareloom.sources.feeds import decode, read_json, topic

FETCHED = "2026-09-13T12:00:00Z"
SAMPLES = {
    "gigm": {
        "operator": "G.I.G.M", "from_city": "Lagos", "to_city": "Abuja",
        "dep_date": "14-09-2026", "dep_time": "07:00", "fare": "NGN 42,500",
        "seats": "12 left", "travel_hours": 12.0, "booking_link": "https://g.example",
        "scraped_at": FETCHED,
    },
    "abctransport": {
        "company": "ABC Transport", "origin_terminal": "LAGOS-JIBOWU",
        "destination_terminal": "ABUJA-UTAKO", "departs": "2026-09-14 07:00:00",
        "amount": 42500.0, "seats_available": 12, "journey_minutes": 720,
        "url": "https://g.example", "ts": FETCHED,
    },
    "crosscountry": {
        "carrier_code": "CC", "start": "Lagos", "end": "Abuja", "epoch_departure": 1789365600,
        "price_kobo": 4250000, "seats": 12, "duration_secs": 43200,
        "deeplink": "https://g.example", "captured_at_epoch": 1789300800,
    },
    "chisco": {
        "line": "CHISCO", "board": "Lagos", "alight": "Onitsha", "when": "14/09/2026 07:00",
        "cost": "42,500.00", "open_seats": 12, "hours": 12.0, "link": "https://g.example",
        "pulled": FETCHED,
    },
    "airpeace": {
        "airline": "Air Peace", "flight_number": "P47021", "dep_airport": "LOS",
        "arr_airport": "ABV", "std": "2026-09-14T07:00:00+01:00", "cabin": "ECONOMY",
        "total_fare": {"amount": 42500.0, "currency": "NGN"}, "seats_remaining": 12,
        "duration_minutes": 720, "deep_link": "https://g.example", "fetched": FETCHED,
    },
    "ibomair": {
        "carrier": "QI", "from": "LOS", "to": "ABV", "departure_utc": "2026-09-14T06:00:00Z",
        "fare_ngn": 42500.0, "seats": 12, "block_minutes": 720,
        "booking_url": "https://g.example", "as_of": FETCHED,
    },
    "arik": {
        "op_carrier": "W3", "board_point": "LOS", "off_point": "ABV",
        "flight_date": "2026-09-14", "dep_minutes_after_midnight": 420,
        "fare_amount": 42500.0, "fare_currency": "NGN", "avail": 12, "elapsed_minutes": 720,
        "url": "https://g.example", "extracted_at": FETCHED,
    },
    "britishairways": {
        "marketingCarrier": "BA", "origin": "LHR", "destination": "LOS",
        "departureDateTime": "2026-09-14T07:00:00+01:00", "cabinClass": "M",
        "totalPrice": 500.0, "currencyCode": "GBP", "availableSeats": 12,
        "journeyDurationMinutes": 720, "bookingUrl": "https://g.example", "timestamp": FETCHED,
    },
}


@pytest.fixture
def normalised(spark):
    def run(feed, unknown_place="PHC", **changes):
        body = json.dumps({**SAMPLES[feed], **changes})
        messages = spark.createDataFrame([(body,)], "value string")
        return normalise.NORMALISERS[feed](decode(messages, feed), unknown_place).collect()

    return run


@pytest.mark.parametrize("feed", list(SAMPLES))
def test_every_feed_yields_the_same_journey(normalised, feed):
    (offer,) = normalised(feed)
    assert offer["offer_id"].startswith(f"{feed}-")
    assert offer["offer_id"].endswith("-20260914T0600Z")
    assert offer["depart_time"] == "2026-09-14T07:00:00+01:00"
    assert offer["duration_min"] == 720
    assert offer["price_ngn"] == (1025000.0 if feed == "britishairways" else 42500.0)
    assert offer["seats_left"] == 12
    assert offer["fetched_at"] == FETCHED


GUARDED = {
    "gigm": ["fare", "dep_date"], "abctransport": ["amount", "departs"],
    "crosscountry": ["price_kobo", "epoch_departure"], "chisco": ["cost", "when"],
    "airpeace": ["total_fare", "std"], "ibomair": ["fare_ngn", "departure_utc"],
    "arik": ["fare_amount", "flight_date"],
    "britishairways": ["totalPrice", "departureDateTime"],
}


@pytest.mark.parametrize("feed, column", [(f, c) for f, cs in GUARDED.items() for c in cs])
def test_rows_without_price_or_departure_are_dropped(normalised, feed, column):
    assert normalised(feed, **{column: None}) == []


def test_unknown_city_falls_to_the_default_or_to_null(normalised):
    assert normalised("gigm", from_city="Enugu")[0]["origin"] == "PHC"
    strict = normalised("gigm", unknown_place=None, from_city="Enugu")[0]
    assert strict["origin"] is None and strict["offer_id"] is None


def test_dirty_text_gives_nulls_and_not_a_failure(normalised):
    offer = normalised("gigm", fare="call us", seats="few", dep_time="late")[0]
    assert offer["price_ngn"] is None and offer["seats_left"] is None
    assert offer["depart_time"] is None and offer["offer_id"] is None


@pytest.mark.parametrize(
    "text, shown, stamp",
    [
        ("2026-01-14T07:00:00+00:00", "2026-01-14T07:00:00Z", "20260114T0700Z"),
        ("2026-07-14T07:00:00+01:00", "2026-07-14T07:00:00+01:00", "20260714T0600Z"),
    ],
)
def test_london_departures_in_winter_and_summer(normalised, text, shown, stamp):
    offer = normalised("britishairways", departureDateTime=text)[0]
    assert offer["depart_time"] == shown and offer["offer_id"].endswith(stamp)


def test_hours_are_cut_not_rounded(normalised):
    assert normalised("gigm", travel_hours=8.2)[0]["duration_min"] == 491


def test_feed_files_read_in_batch_and_strict(spark, tmp_path):
    path = tmp_path / "gigm.json"
    path.write_text(json.dumps(SAMPLES["gigm"]) + "\n")
    assert read_json(spark, "gigm", str(path)).count() == 1
    path2 = tmp_path / "bad.json"
    path2.write_text("{not json\n")
    with pytest.raises(Exception):
        read_json(spark, "gigm", str(path2), strict=True).collect()
    assert topic("gigm") == "raw.gigm"
    with pytest.raises(KeyError):
        topic("nobody")


# ----------------------------------------------------------------- contract --


def _errors(frame):
    return contract.check_offers(frame).first()["contract_errors"]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, []),
        ({"carrier": "X"}, ["length:carrier"]),
        ({"mode": "sea"}, ["enum:mode"]),
        ({"origin": "Lagos"}, ["pattern:origin"]),
        ({"destination": "abv"}, ["pattern:destination"]),
        ({"duration_min": 0}, ["range:duration_min"]),
        ({"duration_min": 4321}, ["range:duration_min"]),
        ({"price_ngn": 0.0}, ["range:price_ngn"]),
        ({"price_ngn": 100000000.5}, ["range:price_ngn"]),
        ({"seats_left": -1}, ["range:seats_left"]),
        ({"seats_left": 0}, []),
        ({"booking_url": ""}, ["length:booking_url"]),
        ({"offer_id": "nope"}, ["pattern:offer_id"]),
        ({"seats_left": None, "carrier": None}, ["required:carrier", "required:seats_left"]),
        ({"depart_time": "2026-09-14T07:00:00"}, ["no_offset:depart_time"]),
        ({"fetched_at": "2026-09-13T12:00:00"}, ["no_offset:fetched_at"]),
        ({"fetched_at": "2026-09-14T06:00:00Z"}, ["already_departed"]),
        ({"carrier": "Nobody"}, ["unknown_carrier"]),
        ({"destination": "LOS"}, ["same_place", "wrong_offer_id"]),
        ({"destination": "KAN"}, ["unsupported_route", "unknown_place", "wrong_offer_id"]),
        (
            {"destination": "ONI", "mode": "air", "carrier": "Air Peace"},
            ["impossible_mode:destination", "wrong_offer_id"],
        ),
    ],
)
def test_contract_rule_by_rule(offers, change, expected):
    assert _errors(offers(change)) == expected


def test_raw_messages_are_checked_for_unknown_fields_and_types(spark, offers):
    good = offers({}).toJSON().first()
    record = json.loads(good)
    bodies = [
        good,
        json.dumps({**record, "card": "4111"}),
        json.dumps({**record, "price_ngn": "cheap"}),
        "[]",
    ]
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, value string")
    found = {r["i"]: r["contract_errors"] for r in contract.check_messages(frame).collect()}
    assert found[0] == []
    assert found[1] == ["unexpected:card"]
    assert "type:price_ngn" in found[2] and "required:price_ngn" in found[2]
    assert found[3] == ["not_an_object"]


def test_valid_and_quarantined_rows_are_apart(offers):
    checked = contract.check_offers(offers({}, {"seats_left": -1}))
    good, bad = contract.split_valid(checked)
    assert good.count() == 1 and bad.count() == 1
    assert good.first()["contract_valid"] is True


@pytest.mark.parametrize(
    "person, top, expected",
    [
        ({}, {}, []),
        ({"email": "nope"}, {}, ["email"]),
        ({"email": "a b@c.de"}, {}, ["email"]),
        ({"card_number": "4111"}, {}, ["passenger_unexpected_field"]),
        ({}, {"card_number": "4111"}, ["unexpected_field"]),
        ({}, {"quoted_price_ngn": 0}, ["quoted_price_ngn"]),
        ({"gender": "x", "born_on": "May"}, {}, ["born_on", "gender"]),
        ({"given_name": ""}, {}, ["given_name"]),
        ({}, {"idempotency_key": "short"}, ["idempotency_key"]),
    ],
)
def test_booking_request_rules(spark, person, top, expected):
    body = {
        "offer_id": "gigm-road-LOS-ABV-20260914T0600Z", "quoted_price_ngn": 25000,
        "passenger": {"given_name": "Ada", "family_name": "Obi", "email": "a@b.co", **person},
        **top,
    }
    frame = spark.createDataFrame([(json.dumps(body),)], "body string")
    row = contract.check_booking_requests(frame).first()
    assert row["request_errors"] == expected


def test_state_and_update_rules(spark):
    changes = spark.createDataFrame(
        [("state", "confirmed"), ("state", "refunded"), ("offer_id", "x"), ("attempts", "2")],
        "column_name string, new_value string",
    )
    found = [r[0] for r in changes.select(contract.update_problems()).collect()]
    assert found == [[], ["invalid_state"], ["not_updatable"], []]
    states = spark.createDataFrame([("pending",), ("lost",)], "state string")
    assert [r[0] for r in states.select(contract.booking_problems()).collect()] == [[], ["state"]]
    odds = spark.createDataFrame([(0.5,), (1.5,)], "probability double")
    rows = odds.select(contract.prediction_problems()).collect()
    assert [r[0] for r in rows] == [[], ["probability"]]


def test_string_records_become_numbers_again(spark):
    frame = spark.createDataFrame(
        [("600.0", "9", "25000"), ("x", "1", "100000")],
        "duration_min string, seats_left string, price_ngn string",
    )
    rows = normalise.coerce(frame).orderBy("price_ngn").collect()
    assert (rows[0]["duration_min"], rows[0]["price_ngn"]) == (600, 25000.0)
    assert rows[1]["duration_min"] is None and rows[1]["price_ngn"] == 100000.0


def test_history_form_has_instants_and_two_decimals(offers):
    row = normalise.to_history(offers({"price_ngn": 1234.567})).first()
    assert str(row["price_ngn"]) == "1234.57"
    assert row["depart_time"].isoformat() == "2026-09-14T06:00:00"


def test_tagged_messages_make_the_offers_of_their_feeds(spark):
    """One pass over all feeds gives what the feeds give one by one; the rest makes no offer."""
    views = Views(spark, "/root/testdata/sf0.001")
    messages = views.messages(views.obs).cache()
    odd = spark.createDataFrame(
        [("gigm", "{not json"), ("gigm", None), (None, "{}"), ("elsewhere", "{}"),
         ("arik", '{"operator": "G.I.G.M", "fare": "NGN 1"}')], "feed string, value string"
    )
    found = normalise.unify_messages(messages.unionByName(odd), None)
    single = normalise.unify({k: views.encode(views.obs, k) for k in KEYS}, None)
    assert found.schema.simpleString() == single.schema.simpleString()
    assert found.exceptAll(single).count() == 0 == single.exceptAll(found).count()
    raw = messages.select("feed", F.col("value").cast("binary").alias("value"))
    assert normalise.unify_messages(raw, None).count() == single.count() > 0
    plan = normalise.unify_messages(views.messages(views.obs))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    messages.unpersist()
