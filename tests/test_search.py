from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fareloom.operators import intents, ranking
from fareloom.plans import search

COACH = {"price_ngn": 25000.0, "duration_min": 600}
FLIGHT = {
    "offer_id": "airpeace-air-LOS-ABV-20260914T0600Z", "carrier": "Air Peace", "mode": "air",
    "price_ngn": 95000.0, "duration_min": 75,
}


@pytest.fixture
def asked(spark):
    def make(*rows):
        usual = {"origin": "LOS", "destination": "ABV", "date": None, "limit": 10}
        full = [{**usual, **r} for r in rows]
        return spark.createDataFrame(
            [(i, r["origin"], r["destination"], r["date"], r["limit"])
             for i, r in enumerate(full)],
            "request_id int, origin string, destination string, date string, limit int",
        )

    return make


@pytest.fixture
def lists(now):
    def run(requests, latest):
        rows = search.search_lists(requests, latest, now).orderBy("request_id", "kind", "rank")
        out = {}
        for r in rows.collect():
            out.setdefault((r["request_id"], r["kind"]), []).append(r)
        return out

    return run


def test_unknown_place_unsupported_route_and_empty_are_three_answers(asked, offers, now):
    requests = asked(
        {"destination": "KAN"}, {"origin": "ABV", "destination": "PHC"}, {"destination": "PHC"}
    )
    rows = search.search_envelope(requests, offers({}), now).orderBy("request_id").collect()
    assert [r["status"] for r in rows] == ["unknown_place", "out_of_scope", "ok"]
    assert [r["count"] for r in rows] == [None, None, 0]
    assert rows[2]["stale"] is False


@pytest.mark.parametrize(
    "change", [{"limit": 0}, {"limit": 51}, {"origin": "LAGOS"}, {"date": "2026-02-30"}]
)
def test_malformed_requests_are_refused_not_cut(asked, offers, lists, now, change):
    requests = asked(change)
    assert search.search_envelope(requests, offers({}), now).first()["status"] == "invalid_request"
    assert lists(requests, offers({})) == {}


def test_cheapest_is_the_coach_and_fastest_the_flight_door_to_door(asked, offers, lists):
    found = lists(asked({"origin": "los"}), offers(COACH, FLIGHT))
    assert [r["mode"] for r in found[0, "cheapest"]] == ["road", "air"]
    fastest = found[0, "fastest"]
    assert fastest[0]["mode"] == "air" and fastest[0]["door_to_door_min"] == 75 + 150 + 90


def test_a_short_coach_beats_a_flight(asked, offers, lists):
    found = lists(asked({}), offers({**COACH, "duration_min": 300}, {**FLIGHT, "duration_min": 80}))
    assert found[0, "fastest"][0]["mode"] == "road"


def test_ties_break_on_speed_then_carrier(asked, offers, lists):
    found = lists(
        asked({}),
        offers(
            {"carrier": "GIGM", "offer_id": "c"}, {"carrier": "CHISCO", "offer_id": "b"},
            {"duration_min": 500, "offer_id": "a"},
        ),
    )
    assert [r["offer_id"] for r in found[0, "cheapest"]] == ["a", "b", "c"]


def test_limit_cuts_both_lists_but_not_the_count(asked, offers, lists, now):
    many = offers(*[{"offer_id": f"o{i:02d}", "price_ngn": 1000.0 + i} for i in range(60)])
    requests = asked({"limit": 3}, {"limit": 50}, {"limit": None})
    found = lists(requests, many)
    sizes = [len(found[i, kind]) for i in range(3) for kind in ("cheapest", "fastest")]
    assert sizes == [3, 3, 50, 50, 10, 10]
    assert search.search_envelope(requests, many, now).first()["count"] == 60


def test_the_all_dates_list_equals_a_list_over_all_offers(asked, offers, lists):
    many = offers(
        *[
            {"offer_id": f"o{d}-{i}", "price_ngn": float((i * 37 + d * 11) % 500 + 1),
             "depart_time": f"2026-09-{14 + d}T07:00:00+01:00"}
            for d in range(6) for i in range(30)
        ]
    )
    found = lists(asked({"limit": 50}, {"limit": 50, "date": "2026-09-16"}), many)
    rows = many.orderBy("price_ngn", "offer_id").limit(50).collect()
    assert [r["offer_id"] for r in found[0, "cheapest"]] == [r["offer_id"] for r in rows]
    assert len(found[1, "cheapest"]) == 30


def test_departures_are_compared_as_instants(asked, offers, lists):
    gone = {"offer_id": "gone", "depart_time": "2026-09-13T12:30:00+01:00"}
    ahead = {"offer_id": "ahead", "depart_time": "2026-09-13T13:30:00+01:00"}
    left_now = {"offer_id": "now", "depart_time": "2026-09-13T13:00:00+01:00"}
    found = lists(asked({}), offers(gone, ahead, left_now))
    assert [r["offer_id"] for r in found[0, "cheapest"]] == ["ahead"]


def test_a_midnight_coach_belongs_to_its_local_date(asked, offers, lists):
    night = offers({"depart_time": "2026-09-15T00:30:00+01:00"})
    found = lists(asked({"date": "2026-09-15"}, {"date": "2026-09-14"}), night)
    assert (0, "cheapest") in found and (1, "cheapest") not in found


def test_routes_do_not_leak(asked, offers, lists):
    found = lists(asked({}), offers({}, {"origin": "ABV", "destination": "LOS"}))
    assert len(found[0, "cheapest"]) == 1


def test_stale_is_flagged_and_shown(asked, offers, lists, now):
    old = {"offer_id": "old", "fetched_at": "2026-09-13T11:44:59Z"}
    edge = {"offer_id": "edge", "fetched_at": "2026-09-13T11:45:00Z"}
    found = lists(asked({}), offers(old, edge))
    assert {r["offer_id"]: r["stale"] for r in found[0, "cheapest"]} == {
        "old": True, "edge": False,
    }
    both = search.search_envelope(asked({}), offers(old, edge), now).first()
    assert (both["stale"], both["stale_count"]) == (False, 1)
    assert search.search_envelope(asked({}), offers(old), now).first()["stale"] is True


def test_a_popular_route_is_cut_before_the_shuffle(asked, offers, now):
    plan = search.search_lists(asked({}), offers({}), now)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 4
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_offer_detail_reports_missing_and_broken_offers(spark, offers, now):
    ids = spark.createDataFrame([("gone",), ("bad",)], "offer_id string")
    rows = search.offer_detail(ids, offers({"offer_id": "bad"}), now).collect()
    found = {r["offer_id"]: r for r in rows}
    assert found["gone"]["status"] == "not_found"
    assert found["bad"]["contract_valid"] is False
    assert found["bad"]["contract_errors"] == ["pattern:offer_id"]


def test_offers_without_a_prediction_stay(spark, offers):
    none = spark.createDataFrame([], "offer_id string, will_rise boolean, probability double")
    assert search.with_predictions(offers({}), none).count() == 1


def test_single_list_and_labels(offers, now):
    rows = ranking.annotate(offers(COACH, FLIGHT), now)
    assert ranking.ranked(rows, "cheapest", 1).first()["mode"] == "road"
    labels = {r["mode_label"]: r for r in ranking.offer_labels(rows).collect()}
    assert labels["Flight"]["journey_label"] == "5h 15m"
    assert labels["Flight"]["scheduled_label"] == "1h 15m"
    assert labels["Coach"]["has_ground_time"] is False
    assert labels["Coach"]["stale_label"] is None


# ---------------------------------------------------------------- free text --

MONDAY = date(2026, 9, 14)


@pytest.fixture
def read(spark):
    def run(text, today=MONDAY):
        frame = spark.createDataFrame([(1, text, today)], "query_id int, text string, today date")
        return intents.parse(frame).first()

    return run


@pytest.mark.parametrize(
    "text, origin, destination",
    [
        ("cheapest way to Abuja", "LOS", "ABV"),
        ("to abuja from lagos", "LOS", "ABV"),
        ("from Abuja to Lagos", "ABV", "LOS"),
        ("lagos port harcourt", "LOS", "PHC"),
        ("to port harcourt", "LOS", "PHC"),
        ("to the port-harcourt terminal", "LOS", "PHC"),
        ("closest abuja coach", "LOS", "ABV"),
        ("onitsha lagos", "ONI", "LOS"),
        ("London", "LOS", "LHR"),
        ("from abuja", "LOS", "ABV"),
        ("abuja from onitsha", "ONI", "ABV"),
        ("lagos to abuja", "LOS", "ABV"),
        ("take me home", "LOS", ""),
        ("lagos", "LOS", ""),
        ("from lagos around lagos", "LOS", ""),
        ("éphéso ph", "LOS", "PHC"),
    ],
)
def test_routes_from_text(read, text, origin, destination):
    row = read(text)
    assert (row["origin"], row["destination"]) == (origin, destination)


@pytest.mark.parametrize(
    "text, today, expected",
    [
        ("abuja 2026-10-01", MONDAY, "2026-10-01"),
        ("day after tomorrow", MONDAY, "2026-09-16"),
        ("tomorrow", MONDAY, "2026-09-15"),
        ("tonight", MONDAY, "2026-09-14"),
        ("friday", MONDAY, "2026-09-18"),
        ("this friday", MONDAY, "2026-09-18"),
        ("next friday", MONDAY, "2026-09-25"),
        ("monday", MONDAY, "2026-09-21"),
        ("next monday", MONDAY, "2026-09-21"),
        ("coming sun", MONDAY, "2026-09-20"),
        ("14 september", MONDAY, "2026-09-14"),
        ("13th september", MONDAY, "2027-09-13"),
        ("sept 20", MONDAY, "2026-09-20"),
        ("december 1st", MONDAY, "2026-12-01"),
        ("the 20th", MONDAY, "2026-09-20"),
        ("the 5th", MONDAY, "2027-09-05"),
        ("31 september", MONDAY, None),
        ("29 february", MONDAY, None),
        ("29 february", date(2028, 1, 1), "2028-02-29"),
        ("next week", MONDAY, "2026-09-21"),
        ("abuja soon", MONDAY, None),
        ("monday 1 october", MONDAY, "2026-09-21"),
    ],
)
def test_dates_from_text(read, text, today, expected):
    assert read(text, today)["date"] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("to abuja", "cheapest"),
        ("fastest to abuja", "fastest"),
        ("cheap and fast", "cheapest"),
        ("quick but cheap", "fastest"),
        ("in a hurry to abuja", "fastest"),
        ("breakfast in abuja", "fastest"),  # words match inside words
        ("least expensive", "cheapest"),
    ],
)
def test_preference(read, text, expected):
    assert read(text)["preference"] == expected


def test_problems_and_notes(read):
    nowhere = read("take me home")
    assert nowhere["problems"] == ["no destination could be identified"]
    assert nowhere["note"].startswith("no place could be identified; no date was given")
    assert nowhere["confident"] is False
    assert read("lagos")["note"].startswith("only Lagos was named")
    assert read("to lagos")["problems"] == ["origin and destination are the same place"]
    assert read("abuja 2026-13-40")["problems"] == ["date is not a calendar date"]
    assert read("abuja " + "x" * 300)["problems"] == ["text must be 2 to 300 characters"]
    assert read("abuja to port harcourt")["problems"] == []  # out of scope, but understood


def test_text_search_answers_and_echoes(spark, offers, now):
    texts = spark.createDataFrame(
        [(1, "fastest to abuja tomorrow", date(2026, 9, 13)), (2, "hello", date(2026, 9, 13)),
         (3, "abuja to onitsha", date(2026, 9, 13))],
        "query_id int, text string, today date",
    )
    answer, rows = search.search_text(texts, offers(COACH, FLIGHT), now)
    found = {r["query_id"]: r for r in answer.collect()}
    assert (found[1]["status"], found[1]["count"], found[1]["preference"]) == ("ok", 2, "fastest")
    assert found[2]["status"] == "not_understood"
    assert found[3]["status"] == "out_of_scope"
    assert {r["request_id"] for r in rows.collect()} == {1}
