"""Eight carrier feeds, eight shapes, one canonical offer.

Each carrier is one narrow projection of its own columns: no joins, no Python,
so a feed of any size is one map-side pass and the same function serves a batch
and a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import money, times
from fareloom.functions.identity import offer_id_from_key
from fareloom.functions.staging import evaluated_once
from fareloom.sources.registry import CARRIERS, lookup
from fareloom.sources.schemas import FEED_SCHEMAS

LAGOS = "Africa/Lagos"
LONDON = "Europe/London"

# The spellings the road carriers use for each place. Anything
# not listed falls to the default place.
CITY_CODES = {"Lagos": "LOS", "Abuja": "ABV", "Onitsha": "ONI", "Port Harcourt": "PHC"}
TERMINAL_CODES = {
    "LAGOS-JIBOWU": "LOS",
    "ABUJA-UTAKO": "ABV",
    "ONITSHA-UPPER-IWEKA": "ONI",
    "PORT-HARCOURT-WATERLINES": "PHC",
}
DEFAULT_PLACE = "PHC"

Field = Callable[[str], Column]  # a published column by its name

_NAMES = {c[0]: c[1] for c in CARRIERS}
_MODES = {c[0]: c[2] for c in CARRIERS}


def place_code(value: Column, codes: Mapping[str, str], unknown: str | None = DEFAULT_PLACE):
    """Code of a published place name. ``unknown=None`` leaves it null instead."""
    code = lookup(codes, value)
    return code if unknown is None else F.coalesce(code, F.lit(unknown))


def _canonical(
    at: Field, key: str, keep: list[str], *, origin: Column, destination: Column,
    depart: Column, duration: Column, price: Column, seats: Column, url: Column,
    fetched: Column, zone: Column | str = LAGOS,
) -> tuple[Column, list[Column]]:
    """Whether a record makes an offer, and the offer's columns."""
    present = reduce(lambda a, b: a & b, [at(c).isNotNull() for c in keep])
    return present, [
        offer_id_from_key(F.lit(key), F.lit(_MODES[key]), origin, destination, depart).alias(
            "offer_id"
        ),
        F.lit(_NAMES[key]).alias("carrier"),
        F.lit(_MODES[key]).alias("mode"),
        origin.alias("origin"),
        destination.alias("destination"),
        times.render_local(depart, zone, zero="Z").alias("depart_time"),
        duration.try_cast("int").alias("duration_min"),
        price.cast("double").alias("price_ngn"),
        seats.try_cast("int").alias("seats_left"),
        url.alias("booking_url"),
        fetched.alias("fetched_at"),
    ]


def _feed(offer: Callable[..., tuple[Column, list[Column]]]) -> Callable[..., DataFrame]:
    """A feed's table or stream as offers; ``offer`` itself is kept for tagged messages."""

    @wraps(offer)
    def normaliser(
        feed: DataFrame, unknown_place: str | None = DEFAULT_PLACE, **options
    ) -> DataFrame:
        present, columns = offer(lambda c: F.col(f"`{c}`"), unknown_place, **options)
        return feed.filter(present).select(*columns)

    normaliser.offer = offer
    return normaliser


@_feed
def gigm(at: Field, unknown_place: str | None):
    when = F.concat(at("dep_date"), F.lit(" "), at("dep_time"))
    return _canonical(
        at, "gigm", ["fare", "dep_date"],
        origin=place_code(at("from_city"), CITY_CODES, unknown_place),
        destination=place_code(at("to_city"), CITY_CODES, unknown_place),
        depart=times.parse_local(when, "dd-MM-yyyy HH:mm", LAGOS),
        duration=at("travel_hours") * 60,
        price=money.digits_as_double(at("fare")),
        seats=money.digits_as_int(at("seats")),
        url=at("booking_link"),
        fetched=at("scraped_at"),
    )


@_feed
def abctransport(at: Field, unknown_place: str | None):
    return _canonical(
        at, "abctransport", ["amount", "departs"],
        origin=place_code(at("origin_terminal"), TERMINAL_CODES, unknown_place),
        destination=place_code(at("destination_terminal"), TERMINAL_CODES, unknown_place),
        depart=times.parse_local(at("departs"), "yyyy-MM-dd HH:mm:ss", LAGOS),
        duration=at("journey_minutes"),
        price=at("amount"),
        seats=at("seats_available"),
        url=at("url"),
        fetched=at("ts"),
    )


@_feed
def crosscountry(at: Field, unknown_place: str | None):
    return _canonical(
        at, "crosscountry", ["price_kobo", "epoch_departure"],
        origin=place_code(at("start"), CITY_CODES, unknown_place),
        destination=place_code(at("end"), CITY_CODES, unknown_place),
        depart=F.timestamp_seconds(at("epoch_departure")),
        duration=at("duration_secs") / 60,
        price=at("price_kobo").cast("double") / 100.0,
        seats=at("seats"),
        url=at("deeplink"),
        fetched=times.render_utc(F.timestamp_seconds(at("captured_at_epoch"))),
    )


@_feed
def chisco(at: Field, unknown_place: str | None):
    return _canonical(
        at, "chisco", ["cost", "when"],
        origin=place_code(at("board"), CITY_CODES, unknown_place),
        destination=place_code(at("alight"), CITY_CODES, unknown_place),
        depart=times.parse_local(at("when"), "dd/MM/yyyy HH:mm", LAGOS),
        duration=at("hours") * 60,
        price=money.digits_as_double(at("cost")),
        seats=at("open_seats"),
        url=at("link"),
        fetched=at("pulled"),
    )


@_feed
def airpeace(at: Field, unknown_place: str | None):
    return _canonical(
        at, "airpeace", ["total_fare", "std"],
        origin=at("dep_airport"),
        destination=at("arr_airport"),
        depart=times.instant(at("std")),
        duration=at("duration_minutes"),
        price=at("total_fare")["amount"],
        seats=at("seats_remaining"),
        url=at("deep_link"),
        fetched=at("fetched"),
    )


@_feed
def ibomair(at: Field, unknown_place: str | None):
    return _canonical(
        at, "ibomair", ["fare_ngn", "departure_utc"],
        origin=at("from"),
        destination=at("to"),
        depart=times.parse_local(at("departure_utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'", "UTC"),
        duration=at("block_minutes"),
        price=at("fare_ngn"),
        seats=at("seats"),
        url=at("booking_url"),
        fetched=at("as_of"),
    )


@_feed
def arik(at: Field, unknown_place: str | None):
    midnight = times.parse_local(at("flight_date"), "yyyy-MM-dd", LAGOS)
    minutes = at("dep_minutes_after_midnight").cast("bigint")
    return _canonical(
        at, "arik", ["fare_amount", "flight_date"],
        origin=at("board_point"),
        destination=at("off_point"),
        depart=F.timestamp_seconds(F.unix_seconds(midnight) + minutes * 60),
        duration=at("elapsed_minutes"),
        price=at("fare_amount"),
        seats=at("avail"),
        url=at("url"),
        fetched=at("extracted_at"),
    )


@_feed
def britishairways(at: Field, unknown_place: str | None, rate: float = money.GBP_NGN):
    """The one feed in pounds, and the one with departures outside Lagos time."""
    return _canonical(
        at, "britishairways", ["totalPrice", "departureDateTime"],
        origin=at("origin"),
        destination=at("destination"),
        depart=times.instant(at("departureDateTime")),
        zone=F.when(at("origin") == "LHR", LONDON).otherwise(LAGOS),
        duration=at("journeyDurationMinutes"),
        price=at("totalPrice") * F.lit(float(rate)),
        seats=at("availableSeats"),
        url=at("bookingUrl"),
        fetched=at("timestamp"),
    )


NORMALISERS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        gigm, abctransport, crosscountry, chisco, airpeace, ibomair, arik, britishairways
    )
}


def unify(feeds: Mapping[str, DataFrame], unknown_place: str | None = DEFAULT_PLACE) -> DataFrame:
    """All feeds as one offer table or stream; a UNION ALL, so nothing shuffles."""
    parts = [NORMALISERS[key](feed, unknown_place) for key, feed in feeds.items()]
    return reduce(DataFrame.unionByName, parts)


def unify_messages(
    messages: DataFrame,
    unknown_place: str | None = DEFAULT_PLACE,
    feed: str = "feed",
    value: str = "value",
) -> DataFrame:
    """Messages of all feeds in one table or stream, each with its feed's name, as offers.

    The source is read once, whatever the number of feeds: a message is parsed by its own
    feed's schema alone. Bodies are text or bytes. Messages of an unknown or null feed, and
    those that ``unify`` would leave out, make no offer.
    """
    tag, body = F.col(feed), F.col(value).cast("string")
    parsed = evaluated_once(
        messages.select(tag.alias("feed"), body.alias("body")),
        {
            key: F.when(F.col("feed") == key, F.from_json("body", FEED_SCHEMAS[key]))
            for key in NORMALISERS
        },
    )
    offers = []
    for key, normaliser in NORMALISERS.items():
        present, columns = normaliser.offer(F.col(key).getField, unknown_place)
        offers.append(F.when((F.col("feed") == key) & present, F.struct(*columns)))
    made = evaluated_once(parsed, {"offer": F.coalesce(*offers)})
    return made.where("offer is not null").select("offer.*")


def coerce(records: DataFrame) -> DataFrame:
    """String-typed offers, as a hash store returns them, with their types back."""
    return records.withColumns(
        {
            "duration_min": F.col("duration_min").try_cast("double").try_cast("int"),
            "seats_left": F.col("seats_left").try_cast("double").try_cast("int"),
            "price_ngn": F.col("price_ngn").try_cast("double"),
        }
    )


def to_history(offers: DataFrame) -> DataFrame:
    """Canonical text offers in the stored form: instants and two-decimal money."""
    return offers.select(
        "offer_id", "carrier", "mode", "origin", "destination",
        times.instant(F.col("depart_time")).alias("depart_time"),
        "duration_min",
        F.col("price_ngn").try_cast("decimal(12,2)").alias("price_ngn"),
        "seats_left", "booking_url",
        times.instant(F.col("fetched_at")).alias("fetched_at"),
    )
