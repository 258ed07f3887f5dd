from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareloom.functions import identity, money, times, urls
from fareloom.functions.staging import evaluated_once
from fareloom.operators import dashboard, ops


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-09-14T06:00:00Z", datetime(2026, 9, 14, 6)),
        (" 2026-09-14T07:00:00+01:00 ", datetime(2026, 9, 14, 6)),
        ("2026-09-14T07:00:00+0100", datetime(2026, 9, 14, 6)),
        ("2026-09-14T07:00:00.250+01:00", datetime(2026, 9, 14, 6, 0, 0, 250000)),
        ("2026-09-14T07:00:00", None),
        ("2026-09-14", None),
        ("2026-13-14T07:00:00Z", None),
        ("", None),
        (None, None),
    ],
)
def test_only_offset_carrying_text_is_an_instant(one, text, expected):
    micros = one(F.unix_micros(times.instant(F.col("t").cast("string"))), t=text)
    assert micros == (None if expected is None else _micros(expected))


def _micros(moment):
    return int((moment - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


@pytest.mark.parametrize(
    "moment, place, expected",
    [
        ("2026-01-15 12:00:00", "LOS", "2026-01-15T13:00:00+01:00"),
        ("2026-01-15 12:00:00", "LHR", "2026-01-15T12:00:00+00:00"),
        ("2026-07-15 12:00:00", "LHR", "2026-07-15T13:00:00+01:00"),
    ],
)
def test_departures_are_rendered_in_their_own_zone(one, moment, place, expected):
    ts = F.col("m").cast("timestamp")
    assert one(times.render_departure(ts, F.col("p")), m=moment, p=place) == expected


def test_negative_and_half_hour_offsets(one):
    ts = F.lit("2026-01-15 12:00:00").cast("timestamp")
    assert one(times.render_local(ts, "America/New_York")) == "2026-01-15T07:00:00-05:00"
    assert one(times.render_local(ts, "Asia/Kolkata")) == "2026-01-15T17:30:00+05:30"
    assert one(times.render_local(ts, "Europe/London", "Z")) == "2026-01-15T12:00:00Z"


def test_wall_clock_follows_summer_time_and_refuses_offsets(one):
    def read(text):
        wall = times.wall_clock_instant(F.col("t"), F.lit("LHR"))
        return one(times.render_utc(wall), t=text)

    assert read("2026-01-15T09:00") == "2026-01-15T09:00:00Z"
    assert read("2026-07-15T09:00:00") == "2026-07-15T08:00:00Z"
    assert read("2026-07-15T09:00:00+01:00") is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("NGN 42,500", 42500.0),
        ("₦42,500.00", 42500.0),
        ("42 500", 42500.0),
        ("£310.50", 310.5),
        ("1.234.567", 1234567.0),
        ("free", None),
        ("0", None),
        ("", None),
    ],
)
def test_price_text(one, text, expected):
    assert one(money.parse_price(F.col("t")), t=text) == expected


def test_currency_conversion(one):
    def convert(amount, code, rate=2050.0):
        return one(money.to_ngn(F.col("a"), F.col("c"), rate), a=amount, c=code)

    assert convert(1000.0, " ngn ") == 1000.0
    assert convert(310.5, "GBP") == 636525.0
    assert convert(310.5, "GBP", 0.0) is None
    assert convert(10.0, "USD") is None
    assert convert(-1.0, "NGN") is None


def test_offer_id_uses_the_instant_not_the_text(one):
    def made(text, carrier="GIGM"):
        return one(
            identity.offer_id(
                F.lit(carrier), F.lit(" Road"), F.lit("los"), F.lit("ABV "),
                times.instant(F.lit(text)),
            )
        )

    assert made("2026-09-14T07:00:00+01:00") == "gigm-road-LOS-ABV-20260914T0600Z"
    assert made("2026-09-14T06:00:00Z", "gigm") == "gigm-road-LOS-ABV-20260914T0600Z"
    assert made("2026-09-14T06:00:00Z", "Nobody") is None


def test_route_key_is_lagos_first_both_ways(one):
    def key(a, b):
        return one(identity.route_key(F.lit(a), F.lit(b)))

    assert key("LOS", "ABV") == key("ABV", "LOS") == "LOS-ABV"
    assert key("ABV", "PHC") is None
    assert key("LOS", "LOS") is None


def test_derived_key_ignores_case_and_spaces_but_not_price_or_traveller(one):
    def key(email, price):
        return one(identity.idempotency_key(F.lit("o-1"), F.lit(email), F.lit(price)))

    assert key("a@b.co", 25000.0) == key("  A@B.co ", 25000.0)
    assert key("a@b.co", 25000.0) != key("a@b.co", 26000.0)
    assert key("a@b.co", 25000.0) != key("c@b.co", 25000.0)
    assert key("a@b.co", 25000.0).startswith("auto-v1-")
    assert len(key("a@b.co", 25000.0)) == len("auto-v1-") + 16


def test_deep_link_keeps_parameters_and_their_order(one):
    def link(url):
        return one(
            urls.deep_link(
                F.lit(url), F.lit("LOS"), F.lit("ABV"), F.lit("2026-09-14T07:00:00+01:00")
            )
        )

    tail = "date=2026-09-14&depart=07%3A00&passengers=1&class=economy"
    assert link("https://x.example/b") == f"https://x.example/b?from=LOS&to=ABV&{tail}"
    assert link("https://x.example/b?z=1&from=OLD&a=b%20c&blank=#top") == (
        f"https://x.example/b?z=1&from=LOS&a=b+c&to=ABV&{tail}#top"
    )
    assert "@" not in link("https://x.example/b")


@pytest.mark.parametrize(
    "p, rise, expected",
    [
        (0.78, True, "Likely to rise (78%)"),
        (0.22, False, "Unlikely to rise (22%)"),
        (0.40, False, "Could go either way (40%)"),
        (0.60, True, "Could go either way (60%)"),
        (0.604, True, "Could go either way (60%)"),
        (0.605, True, "Likely to rise (61%)"),
    ],
)
def test_prediction_label_bands(one, p, rise, expected):
    assert one(dashboard.prediction_label(F.col("p"), F.col("r")), p=p, r=rise) == expected


def test_labels(one):
    assert one(money.naira_label(F.lit(42500.4))) == "NGN 42,500"
    assert one(money.duration_label(F.lit(720))) == "12h 00m"
    assert one(money.duration_label(F.lit(45))) == "45m"


def test_client_is_the_first_forwarded_address(one):
    key = ops.client_key(F.col("f").cast("string"), F.col("p").cast("string"))
    assert one(key, f="1.2.3.4, 10.0.0.1", p="127.0.0.1") == "1.2.3.4"
    assert one(key, f="", p="127.0.0.1") == "127.0.0.1"
    assert one(key, f=None, p=None) == "unknown"


def test_error_list_is_flattened(one):
    body = '{"errors":[{"title":"Gone","message":"too late"},{"message":"sorry"}]}'
    assert one(ops.error_message(F.lit(body))) == "Gone: too late; ?: sorry"
    assert one(ops.error_message(F.lit("<html>"))) == "<html>"
    assert one(ops.error_message(F.lit(""))) == "no response body"
    long = '{"errors":[{"title":"T","message":"' + "x" * 900 + '"}]}'
    assert len(one(ops.error_message(F.lit(long)))) == 400


def test_filters_stay_above_columns_worked_out_once(spark):
    frame = evaluated_once(spark.range(5), {"x": F.sha2(F.col("id").cast("string"), 256)})
    found = frame.filter((F.col("x") > "5") & (F.length("x") == 64))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2") == 1
    assert frame.count() == 5
