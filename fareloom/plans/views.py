"""The driver tables seen as fares.

Every view is a projection of the given tables, as large as they are. The SQL
twin of each view is in ``view_sql``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions import times
from fareloom.functions.identity import offer_id_from_key
from fareloom.operators.history import latest_offers, newest
from fareloom.operators.normalise import CITY_CODES, TERMINAL_CODES
from fareloom.session import prepare
from fareloom.sources.registry import CARRIERS
from fareloom.sources.tables import is_folder

KEYS = [c[0] for c in CARRIERS]
FAR_ENDS = [[r.split("-")[1] for r in c[3]] for c in CARRIERS]

# Declared, so that opening a table reads no file.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

# The moments the demo questions are asked at.
OBS_NOW = "2024-01-31 00:00:00"
LISTING_NOW = "1998-09-01 00:00:00"
STALE_AFTER = 90 * 86400  # the listing is months apart, not minutes


def pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def div(a: Column, b: int) -> Column:
    return F.floor(a / b)


def _journey(carrier: Column, spread: Column, outbound: Column) -> dict[str, Column]:
    far = F.coalesce(
        *[
            F.when(carrier == i, pick(ends, spread % len(ends)))
            for i, ends in enumerate(FAR_ENDS)
        ]
    )
    return {
        "carrier_key": pick(KEYS, carrier),
        "carrier": pick([c[1] for c in CARRIERS], carrier),
        "mode": pick([c[2] for c in CARRIERS], carrier),
        "origin": F.when(outbound, F.lit("LOS")).otherwise(far),
        "destination": F.when(outbound, far).otherwise(F.lit("LOS")),
    }


def _plus(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("bigint") * 1_000_000)


def _url() -> Column:
    return F.concat(
        F.lit("https://"), F.col("carrier_key"), F.lit(".example/book?o="), F.col("origin"),
        F.lit("&d="), F.col("destination"),
    )


class Views:
    """Lazily built views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream, whether it is one file or a folder of them."""
        path = f"{self.dir}/{name}.parquet"
        reader = self.spark.readStream.schema(TABLES[name])
        if is_folder(self.spark, path):
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.dir)

    def at(self, moment: str) -> Column:
        return F.lit(moment).cast("timestamp")

    # -------------------------------------------------------------- history --

    def observe(self, events: DataFrame) -> DataFrame:
        """Events as observations: a user is a departure, a value is its price."""
        u = F.col("user_id")
        carrier = u % 8
        depart = _plus(
            F.lit("2024-01-10 00:00:00").cast("timestamp"),
            (u % 100) * 86400 + (u * 7 % 24) * 3600 + (u % 4) * 900,
        )
        journey = _journey(carrier, div(u, 8), div(u, 48) % 2 == 0)
        return (
            events.withColumns(journey)
            .withColumns(
                {
                    "depart_time": depart,
                    "duration_min": F.when(F.col("mode") == "road", 300 + (u % 30) * 6)
                    .otherwise(60 + (u % 4) * 15)
                    .cast("int"),
                    "price_ngn": (F.round(F.col("value") * 100) + 100).cast("double"),
                    "seats_left": F.get_json_object("props", "$.k").cast("int"),
                    "fetched_at": F.col("ts").cast("timestamp"),
                }
            )
            .withColumns(
                {
                    "booking_url": _url(),
                    "offer_id": offer_id_from_key(
                        F.col("carrier_key"), F.col("mode"), F.col("origin"),
                        F.col("destination"), F.col("depart_time"),
                    ),
                }
            )
            .select(
                "event_id", "user_id", "event_type", "carrier_key", "offer_id", "carrier",
                "mode", "origin", "destination", "depart_time", "duration_min", "price_ngn",
                "seats_left", "booking_url", "fetched_at",
            )
        )

    @cached_property
    def obs(self) -> DataFrame:
        return self.observe(self.table("events"))

    @cached_property
    def history(self) -> DataFrame:
        return self.obs.select(
            "offer_id", "carrier", "mode", "origin", "destination", "depart_time",
            "duration_min", "price_ngn", "seats_left", "booking_url", "fetched_at",
        )

    @staticmethod
    def as_text(rows: DataFrame) -> DataFrame:
        """Stored rows as canonical text offers."""
        return rows.withColumns(
            {
                "depart_time": times.render_departure(F.col("depart_time"), F.col("origin")),
                "fetched_at": times.render_utc(F.col("fetched_at")),
            }
        )

    @cached_property
    def offers_text(self) -> DataFrame:
        return self.as_text(self.history)

    # ---------------------------------------------------------------- feeds --

    def encode(self, obs: DataFrame, key: str) -> DataFrame:
        """Observations of one carrier as that carrier would publish them."""
        return obs.filter(F.col("carrier_key") == key).select(*ENCODERS[key]())

    def spread_obs(self) -> DataFrame:
        """The observations over all cores: a file of one row group is one task's else."""
        events, cores = self.table("events"), self.spark.sparkContext.defaultParallelism
        few = events.rdd.getNumPartitions() < cores
        return self.observe(events.repartition(cores) if few else events)

    def messages(self, obs: DataFrame) -> DataFrame:
        """Observations of all carriers as JSON messages with the name of their feed."""
        bodies = [
            F.when(F.col("carrier_key") == key, F.to_json(F.struct(*columns())))
            for key, columns in ENCODERS.items()
        ]
        return obs.select(F.col("carrier_key").alias("feed"), F.coalesce(*bodies).alias("value"))

    # -------------------------------------------------------------- listing --

    @cached_property
    def listing(self) -> DataFrame:
        """Line items as canonical text offers known by LISTING_NOW."""
        items = (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        part = F.col("l_partkey")
        rows = (
            items.withColumns(
                _journey(F.col("s_nationkey") % 8, part, F.col("l_suppkey") % 2 == 0)
            )
            .withColumns(
                {
                    "depart_time": _plus(
                        F.col("l_shipdate").cast("timestamp"), part % 24 * 3600
                    ),
                    "fetched_at": _plus(
                        F.col("o_orderdate").cast("timestamp"), F.col("l_orderkey") % 1440 * 60
                    ),
                    "duration_min": F.when(F.col("mode") == "road", 300 + part % 420)
                    .otherwise(55 + part % 90)
                    .cast("int"),
                    "price_ngn": F.col("l_extendedprice"),
                    "seats_left": F.col("l_quantity").cast("int"),
                }
            )
            .withColumn("booking_url", _url())
            .withColumn(
                "offer_id",
                offer_id_from_key(
                    F.col("carrier_key"), F.col("mode"), F.col("origin"),
                    F.col("destination"), F.col("depart_time"),
                ),
            )
            .filter(F.col("fetched_at") <= self.at(LISTING_NOW))
        )
        return self.as_text(rows).select(
            "offer_id", "carrier", "mode", "origin", "destination", "depart_time",
            "duration_min", "price_ngn", "seats_left", "booking_url", "fetched_at",
        )

    @cached_property
    def latest(self) -> DataFrame:
        return latest_offers(self.listing, times.instant(F.col("fetched_at")))

    @cached_property
    def latest_obs(self) -> DataFrame:
        return latest_offers(self.history)

    # ------------------------------------------------------------- requests --

    @cached_property
    def requests(self) -> DataFrame:
        c = F.col("c_custkey")
        ends = ["LOS", "ABV", "LOS", "ONI", "LOS", "PHC", "LOS", "LHR", "ABV", "LOS"]
        back = ["ABV", "LOS", "ONI", "LOS", "PHC", "LOS", "LHR", "LOS", "PHC", "XXX"]
        tens = div(c, 10)
        origin = pick(ends, c % 10)
        return self.table("customer").select(
            c.alias("request_id"),
            F.when(c % 3 == 0, F.lower(origin)).otherwise(origin).alias("origin"),
            pick(back, c % 10).alias("destination"),
            F.when(
                tens % 5 != 0,
                F.date_format(
                    F.date_add(F.lit("1998-09-01").cast("date"), (tens % 90).cast("int")),
                    "yyyy-MM-dd",
                ),
            ).alias("date"),
            F.when(c % 7 != 0, 1 + c % 20).cast("int").alias("limit"),
        )

    @cached_property
    def texts(self) -> DataFrame:
        """Customers as people typing a travel query."""
        c = F.col("c_custkey")
        place = pick(TEXT_PLACES, div(c, 15) % len(TEXT_PLACES))
        other = pick(TEXT_PLACES, div(c, 90) % len(TEXT_PLACES))
        shape = pick(TEXT_SHAPES, c % len(TEXT_SHAPES))
        filled = F.replace(F.replace(shape, F.lit("{P}"), place), F.lit("{Q}"), other)
        day = F.date_add(F.lit("1998-09-01").cast("date"), (c % 11).cast("int"))
        return self.table("customer").select(
            c.alias("query_id"), filled.alias("text"), day.alias("today")
        )

    # ------------------------------------------------------------- bookings --

    @cached_property
    def booking_requests(self) -> DataFrame:
        """Purchases and sign-ups as booking requests; coarse quotes repeat keys."""
        rows = self.obs.filter(F.col("event_type").isin("purchase", "signup"))
        e, u = F.col("event_id"), F.col("user_id")
        coarse = F.floor(F.col("price_ngn") / 20000) * 20000 + 5000
        return rows.select(
            e.alias("request_id"),
            F.col("fetched_at").alias("requested_at"),
            F.when(e % 29 == 0, F.concat(F.lit("gone-"), F.col("offer_id")))
            .otherwise(F.col("offer_id"))
            .alias("offer_id"),
            coarse.cast("double").alias("quoted_price_ngn"),
            F.when(e % 2 == 0, F.concat(F.lit(" Pat"), u.cast("string"), F.lit("@Example.COM ")))
            .otherwise(F.concat(F.lit("pat"), u.cast("string"), F.lit("@example.com")))
            .alias("email"),
            F.when(e % 7 == 0, F.concat(F.lit("given-key-"), (u % 80).cast("string"))).alias(
                "idempotency_key"
            ),
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """Views as bookings already made, one row per key."""
        u, e = F.col("user_id"), F.col("event_id")
        state = pick(["pending", "confirmed", "failed", "unknown"], e % 4)
        rows = self.obs.filter("event_type = 'view'").select(
            F.when(
                (e % 5 == 0) & (u % 80 < 40), F.concat(F.lit("given-key-"), (u % 80).cast("string"))
            )
            .otherwise(F.concat(F.lit("k-"), e.cast("string")))
            .alias("idempotency_key"),
            "offer_id",
            "carrier",
            state.alias("state"),
            F.col("price_ngn").alias("price_ngn_quoted"),
            F.when(e % 4 == 1, F.concat(F.lit("REF"), e.cast("string"))).alias(
                "provider_reference"
            ),
            F.when(e % 4 == 2, "rejected: sold out").alias("last_error"),
            F.col("fetched_at").alias("created_at"),
        )
        return newest(rows, "idempotency_key", "created_at")

    @cached_property
    def attempts(self) -> DataFrame:
        e = F.col("event_id")
        outcome = (
            F.when(F.col("event_type") == "view", "ok")
            .when(F.col("event_type") == "click", "connect_error")
            .when(F.col("event_type") == "signup", "timeout")
            .when(F.col("event_type") == "purchase", "http")
            .when(e % 2 == 0, "unreadable")
            .otherwise("transport_error")
        )
        return self.table("events").select(
            F.concat(F.lit("k-"), div(e, 4).cast("string")).alias("idempotency_key"),
            (e % 4 + 1).cast("int").alias("attempt"),
            outcome.alias("outcome"),
            pick([401, 403, 404, 422, 429, 500, 503], F.col("user_id") % 7).alias("status"),
            (F.col("user_id") % 5 == 0).alias("read_only"),
        )

    @cached_property
    def orders_at_carrier(self) -> DataFrame:
        """Carrier orders for two in three of the unknown bookings, some twice."""
        e = F.col("event_id")
        rows = self.table("events").filter(
            (F.col("event_type") == "view") & (e % 4 == 3) & (e % 3 != 0)
        )
        return rows.select(
            F.concat(F.lit("ord_"), e.cast("string")).alias("id"),
            F.when(e % 5 != 0, F.concat(F.lit("BR"), e.cast("string"))).alias("booking_reference"),
            F.to_json(
                F.struct(F.concat(F.lit("k-"), e.cast("string")).alias("idempotency_key"))
            ).alias("metadata"),
        )

    @cached_property
    def request_log(self) -> DataFrame:
        """Events on a clock run 600 times faster, as HTTP requests."""
        e, u = F.col("event_id"), F.col("user_id")
        origin = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        path = (
            F.when(F.col("event_type") == "purchase", "/book")
            .when(F.col("event_type").isin("click", "signup"), "/search/nl")
            .when(F.col("event_type") == "view", "/search")
            .otherwise("/health")
        )
        return self.table("events").select(
            e.alias("request_id"),
            F.timestamp_micros(origin + F.floor((us - origin) / 600)).alias("ts"),
            F.when(u % 4 != 0, F.concat(F.lit(" 10.0.0."), (u % 3).cast("string"),
                                        F.lit(", 172.16.0.1"))).alias("forwarded"),
            F.lit("127.0.0.1").alias("peer"),
            F.when(F.col("event_type") == "purchase", "POST").otherwise("GET").alias("method"),
            path.alias("path"),
            F.lit(200).alias("status"),
            F.col("value").alias("duration_ms"),
        )

    # ---------------------------------------------------------- predictions --

    @cached_property
    def predictions(self) -> DataFrame:
        """Every observation as a prediction made seven minutes later."""
        p = probability()
        return self.obs.select(
            "offer_id",
            _plus(F.col("fetched_at"), F.lit(420)).alias("predicted_at"),
            (p >= 0.5).alias("will_rise"),
            p.alias("probability"),
            F.lit("demo-1").alias("model_version"),
            F.col("price_ngn").alias("price_at_prediction"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        """A prediction table with known labels, tied to the price."""
        p = probability()
        return self.obs.select(
            p.alias("probability"),
            (F.col("price_ngn") + p * 8000 > 8000).cast("int").alias("label"),
        )


def probability() -> Column:
    return (F.col("event_id") * 7919 % 10001) / F.lit(10000.0)


TEXT_PLACES = ["Abuja", "port harcourt", "ONITSHA", "London", "Lagos", "Kano"]
TEXT_SHAPES = [
    "Cheapest way to {P} next friday",
    "from {P} to {Q} tomorrow",
    "fastest to the {P} on 14 september",
    "{P} lagos budget",
    "quick trip {P} 1998-10-05",
    "I need to be in {P} day after tomorrow, cheap not fast",
    "to {P} from {Q} this Monday",
    "{P}",
    "from {P} please, the 5th",
    "september 31 to {P}",
    "closest coach today",
    "save money {P} {Q} next week",
    "to {P} tonight asap",
    "3rd jan lagos {P}",
    "go {P} 1998-13-40",
]


def _city(code: str) -> Column:
    return _named(code, {v: k for k, v in CITY_CODES.items()} | {"LHR": "London"})


def _named(code: str, names: dict[str, str]) -> Column:
    listed = [F.when(F.col(code) == c, F.lit(n)) for c, n in names.items()]
    unknown = F.when(F.col("event_id") % 50 == 0, F.lit("Enugu"))
    return F.coalesce(unknown, *listed)


def _dropped(value: Column) -> Column:
    """Every 41st message lacks its price."""
    return F.when(F.col("event_id") % 41 != 0, value)


def _lagos(pattern: str) -> Column:
    return F.date_format(F.from_utc_timestamp("depart_time", "Africa/Lagos"), pattern)


def _fetched() -> Column:
    return times.render_utc(F.col("fetched_at"))


def _hours() -> Column:
    return F.round(F.col("duration_min").cast("double") / 60, 1)


ENCODERS: dict[str, Callable[[], list[Column | str]]] = {
    "gigm": lambda: [
        F.lit("G.I.G.M").alias("operator"), _city("origin").alias("from_city"),
        _city("destination").alias("to_city"), _lagos("dd-MM-yyyy").alias("dep_date"),
        _lagos("HH:mm").alias("dep_time"),
        _dropped(F.concat(F.lit("NGN "), F.format_number("price_ngn", 0))).alias("fare"),
        F.concat(F.col("seats_left").cast("string"), F.lit(" left")).alias("seats"),
        _hours().alias("travel_hours"), F.col("booking_url").alias("booking_link"),
        _fetched().alias("scraped_at"),
    ],
    "abctransport": lambda: [
        F.lit("ABC Transport").alias("company"),
        _named("origin", {v: k for k, v in TERMINAL_CODES.items()}).alias("origin_terminal"),
        _named("destination", {v: k for k, v in TERMINAL_CODES.items()}).alias(
            "destination_terminal"
        ),
        _lagos("yyyy-MM-dd HH:mm:ss").alias("departs"),
        _dropped(F.col("price_ngn")).alias("amount"),
        F.col("seats_left").alias("seats_available"),
        F.col("duration_min").alias("journey_minutes"), F.col("booking_url").alias("url"),
        _fetched().alias("ts"),
    ],
    "crosscountry": lambda: [
        F.lit("CC").alias("carrier_code"), _city("origin").alias("start"),
        _city("destination").alias("end"),
        F.unix_seconds("depart_time").alias("epoch_departure"),
        _dropped(F.round(F.col("price_ngn") * 100).cast("bigint")).alias("price_kobo"),
        F.col("seats_left").alias("seats"), (F.col("duration_min") * 60).alias("duration_secs"),
        F.col("booking_url").alias("deeplink"),
        F.unix_seconds("fetched_at").alias("captured_at_epoch"),
    ],
    "chisco": lambda: [
        F.lit("CHISCO").alias("line"), _city("origin").alias("board"),
        _city("destination").alias("alight"), _lagos("dd/MM/yyyy HH:mm").alias("when"),
        _dropped(F.format_number("price_ngn", 2)).alias("cost"),
        F.col("seats_left").alias("open_seats"), _hours().alias("hours"),
        F.col("booking_url").alias("link"), _fetched().alias("pulled"),
    ],
    "airpeace": lambda: [
        F.lit("Air Peace").alias("airline"), F.lit("P47021").alias("flight_number"),
        F.col("origin").alias("dep_airport"), F.col("destination").alias("arr_airport"),
        times.render_local(F.col("depart_time"), "Africa/Lagos").alias("std"),
        F.lit("ECONOMY").alias("cabin"),
        _dropped(
            F.struct(F.col("price_ngn").alias("amount"), F.lit("NGN").alias("currency"))
        ).alias("total_fare"),
        F.col("seats_left").alias("seats_remaining"),
        F.col("duration_min").alias("duration_minutes"),
        F.col("booking_url").alias("deep_link"), _fetched().alias("fetched"),
    ],
    "ibomair": lambda: [
        F.lit("QI").alias("carrier"), F.col("origin").alias("from"),
        F.col("destination").alias("to"),
        times.render_utc(F.col("depart_time")).alias("departure_utc"),
        _dropped(F.col("price_ngn")).alias("fare_ngn"), F.col("seats_left").alias("seats"),
        F.col("duration_min").alias("block_minutes"), "booking_url",
        _fetched().alias("as_of"),
    ],
    "arik": lambda: [
        F.lit("W3").alias("op_carrier"), F.col("origin").alias("board_point"),
        F.col("destination").alias("off_point"), _lagos("yyyy-MM-dd").alias("flight_date"),
        (_lagos("HH").cast("int") * 60 + _lagos("mm").cast("int")).alias(
            "dep_minutes_after_midnight"
        ),
        _dropped(F.col("price_ngn")).alias("fare_amount"), F.lit("NGN").alias("fare_currency"),
        F.col("seats_left").alias("avail"), F.col("duration_min").alias("elapsed_minutes"),
        F.col("booking_url").alias("url"), _fetched().alias("extracted_at"),
    ],
    "britishairways": lambda: [
        F.lit("BA").alias("marketingCarrier"), "origin", "destination",
        times.render_departure(F.col("depart_time"), F.col("origin")).alias("departureDateTime"),
        F.lit("M").alias("cabinClass"),
        _dropped(F.floor(F.col("price_ngn") / 2050.0 * 100 + 0.5) / 100.0).alias("totalPrice"),
        F.lit("GBP").alias("currencyCode"), F.col("seats_left").alias("availableSeats"),
        F.col("duration_min").alias("journeyDurationMinutes"),
        F.col("booking_url").alias("bookingUrl"), _fetched().alias("timestamp"),
    ],
}
