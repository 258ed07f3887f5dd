"""Feeds, normalisers, scalar functions and the contract."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import identity, money, times
from fareloom.operators import contract, dashboard, normalise, ops
from fareloom.plans import view_sql as S
from fareloom.plans.registry import question
from fareloom.plans.views import KEYS, TABLES, Views, probability
from fareloom.session import new_path
from fareloom.sources import registry, tables
from fareloom.sources.feeds import decode
from fareloom.sources.schemas import OFFER, OFFER_COLUMNS
from fareloom.streaming import flows, state

_UNKNOWN = "event_id % 50 = 0"
_ROAD_ID = f"""
  CASE WHEN {_UNKNOWN} THEN 'PHC' ELSE origin END AS o2,
  CASE WHEN {_UNKNOWN} THEN 'PHC' ELSE destination END AS d2"""


def _canonical_sql(key: str) -> str:
    """What a normaliser must yield, stated from the observations themselves."""
    road = dict(zip(KEYS, [c[2] for c in registry.CARRIERS]))[key] == "road"
    origin, dest = ("o2", "d2") if road else ("origin", "destination")
    duration = "duration_min"
    if key in ("gigm", "chisco"):
        duration = (
            "CAST(trunc(round(CAST(duration_min AS DOUBLE) / 60, 1) * 60) AS INTEGER)"
        )
    price = "price_ngn"
    if key == "britishairways":
        price = (
            "floor(price_ngn / CAST(2050 AS DOUBLE) * 100 + 0.5) / CAST(100 AS DOUBLE) "
            "* CAST(2050 AS DOUBLE)"
        )
    place = "origin" if key == "britishairways" else "'LOS'"
    return f"""
  SELECT {S.id_of('carrier_key', 'mode', origin, dest, 'depart_time')} AS offer_id,
    carrier, mode, {origin} AS origin, {dest} AS destination,
    {S.local_text('depart_time', place, 'Z')} AS depart_time, {duration} AS duration_min,
    {price} AS price_ngn, seats_left, booking_url, {S.utc_text('fetched_at')} AS fetched_at
  FROM (SELECT *, {_ROAD_ID} FROM obs) WHERE carrier_key = '{key}' AND event_id % 41 <> 0"""


_ALL_FEEDS = " UNION ALL ".join(_canonical_sql(k) for k in KEYS)


def _one_feed(key: str):
    def run(v: Views) -> DataFrame:
        """The feed as JSON messages, decoded against its schema and normalised."""
        raw = v.encode(v.obs, key)
        messages = raw.select(F.to_json(F.struct(*[f"`{c}`" for c in raw.columns])).alias("value"))
        return normalise.NORMALISERS[key](decode(messages, key))

    return run


for _key in KEYS:
    question(f"norm_{_key}", S.with_views(S.OBS) + _canonical_sql(_key))(_one_feed(_key))


@question("offers_union", S.with_views(S.OBS) + _ALL_FEEDS)
def offers_union(v):
    return normalise.unify_messages(v.messages(v.spread_obs()))


@question(
    "feed_volume",
    S.with_views(S.OBS) + "SELECT carrier_key AS feed, count(*) AS n_messages FROM obs GROUP BY 1",
)
def feed_volume(v):
    return ops.feed_volume(v.messages(v.obs))


# The column in which each road feed names the place of departure.
_BOARDING = {
    "gigm": ("from_city", normalise.CITY_CODES),
    "abctransport": ("origin_terminal", normalise.TERMINAL_CODES),
    "crosscountry": ("start", normalise.CITY_CODES),
    "chisco": ("board", normalise.CITY_CODES),
}


@question(
    "place_map",
    S.with_views(S.OBS)
    + f"""
  SELECT carrier_key AS feed, CASE WHEN {_UNKNOWN} THEN 'Enugu'
      WHEN carrier_key = 'abctransport' THEN CASE origin WHEN 'LOS' THEN 'LAGOS-JIBOWU'
        WHEN 'ABV' THEN 'ABUJA-UTAKO' WHEN 'ONI' THEN 'ONITSHA-UPPER-IWEKA'
        ELSE 'PORT-HARCOURT-WATERLINES' END
      WHEN origin = 'LOS' THEN 'Lagos' WHEN origin = 'ABV' THEN 'Abuja'
      WHEN origin = 'ONI' THEN 'Onitsha' ELSE 'Port Harcourt' END AS place,
    CASE WHEN {_UNKNOWN} THEN 'PHC' ELSE origin END AS code,
    CASE WHEN {_UNKNOWN} THEN NULL ELSE origin END AS strict_code, count(*) AS n
  FROM obs WHERE mode = 'road' GROUP BY ALL""",
)
def place_map(v):
    """Every place name of the road feeds, with and without the default place."""
    parts = [
        v.encode(v.obs, key).select(
            F.lit(key).alias("feed"),
            F.col(column).alias("place"),
            normalise.place_code(F.col(column), codes).alias("code"),
            normalise.place_code(F.col(column), codes, None).alias("strict_code"),
        )
        for key, (column, codes) in _BOARDING.items()
    ]
    named = reduce(DataFrame.unionByName, parts)
    return named.groupBy(*named.columns).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ streams --


def _stream_feeds(v: Views) -> DataFrame:
    """The events table read as a stream of the messages of eight feeds."""
    return flows.union_messages(v.messages(v.observe(v.stream("events"))))


@question("stream_union", S.with_views(S.OBS) + _ALL_FEEDS)
def stream_union(v):
    out, marks = new_path(v.spark, "offers"), new_path(v.spark, "marks")
    flows.write_offers(_stream_feeds(v), out, marks, once=True).awaitTermination()
    return v.spark.read.schema(OFFER).parquet(out)


@question(
    "stream_dedup",
    S.with_views(S.OBS)
    + f"""
  SELECT offer_id, carrier, mode, origin, destination,
    epoch_us(CAST(depart_time AS TIMESTAMPTZ)) AS depart_us, duration_min,
    CAST(CAST(price_ngn AS DECIMAL(12, 2)) AS DOUBLE) AS price_ngn, seats_left, booking_url,
    epoch_us(CAST(fetched_at AS TIMESTAMPTZ)) AS fetched_us
  FROM ({_ALL_FEEDS})
  QUALIFY row_number() OVER (PARTITION BY offer_id, fetched_at ORDER BY duration_min,
    price_ngn, seats_left NULLS FIRST, booking_url) = 1""",
)
def stream_dedup(v):
    """Every message of all feeds delivered twice; the history holds each fact once."""
    copies = F.explode(F.array(F.lit(1), F.lit(2)))
    twice = _stream_feeds(v).select("*", copies.alias("_copy")).drop("_copy")
    out, marks = new_path(v.spark, "history"), new_path(v.spark, "marks")
    flows.write_history(twice, out, marks, once=True).awaitTermination()
    stored = tables.read_history(v.spark, out)
    return stored.select(
        "offer_id", "carrier", "mode", "origin", "destination",
        F.unix_micros("depart_time").alias("depart_us"), "duration_min",
        F.col("price_ngn").cast("double").alias("price_ngn"), "seats_left", "booking_url",
        F.unix_micros("fetched_at").alias("fetched_us"),
    )


@question(
    "stream_latest",
    S.with_views(S.OBS)
    + f"""
  SELECT offer_id, price_ngn, seats_left, fetched_at FROM ({_ALL_FEEDS})
  QUALIFY row_number() OVER (PARTITION BY offer_id ORDER BY fetched_at DESC, duration_min DESC,
    price_ngn DESC, seats_left DESC NULLS LAST, booking_url DESC) = 1""",
)
def stream_latest(v):
    """The latest offer of every departure of all feeds."""
    out, marks = new_path(v.spark, "latest"), new_path(v.spark, "marks")
    flows.write_latest(_stream_feeds(v), out, marks, once=True).awaitTermination()
    return flows.read_latest(v.spark, out).select(
        "offer_id", "price_ngn", "seats_left", "fetched_at"
    )


_STATE_SQL = (
    S.with_views(S.OBS)
    + f"""
  SELECT offer_id, price_ngn, seats_left, {S.utc_text('fetched_at')} AS fetched_at FROM obs
  QUALIFY row_number() OVER (PARTITION BY offer_id
    ORDER BY date_trunc('second', fetched_at) DESC, carrier DESC, mode DESC, origin DESC,
      destination DESC, depart_time DESC, duration_min DESC, price_ngn DESC,
      seats_left DESC NULLS LAST, booking_url DESC) = 1"""
)
DELIVERIES = 4


def _deliver(v: Views, folder: str, part: int) -> None:
    """One more delivery of the events: their fourth, as files added to a folder."""
    events = v.table("events").filter(F.col("event_id") % DELIVERIES == part)
    events.write.mode("append").parquet(folder)


def _delivered(v: Views, folder: str) -> DataFrame:
    """The offers of all deliveries so far, as a stream."""
    events = v.spark.readStream.schema(TABLES["events"]).parquet(folder)
    return v.as_text(v.observe(events)).select(*OFFER_COLUMNS)


@question("stream_running_latest", _STATE_SQL)
def stream_running_latest(v):
    """A kept table of latest offers after five deliveries, the last an old one again.

    Every run resumes from the checkpoint; deltas are merged into a new base every second one.
    """
    folder, out, marks = (new_path(v.spark, n) for n in ("delivered", "state", "marks"))
    for part in (0, 1, 2, 3, 0):
        _deliver(v, folder, part)
        state.write_state(
            _delivered(v, folder), out, marks, buckets=8, merge_every=2, once=True
        ).awaitTermination()
    return state.read_state(v.spark, out).select(
        "offer_id", "price_ngn", "seats_left", "fetched_at"
    )


@question(
    "stream_restart",
    S.with_views(S.OBS)
    + f"""SELECT offer_id, price_ngn, seats_left, {S.utc_text('fetched_at')} AS fetched_at,
    2 AS copies FROM obs""",
)
def stream_restart(v):
    """A stream that fails before its second batch is written and is started again.

    Beside it runs one that never fails; every offer is in either output once.
    """
    folder, out, marks = (new_path(v.spark, n) for n in ("delivered", "offers", "marks"))
    whole, whole_marks = new_path(v.spark, "offers"), new_path(v.spark, "marks")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def fail(batch: DataFrame, number: int) -> None:
        raise RuntimeError("stopped between batches")

    for part in range(DELIVERIES):
        _deliver(v, folder, part)
        if part == 1:
            try:
                flows.each_batch(_delivered(v, folder), marks, fail, once=True).awaitTermination()
            except StreamingQueryException:
                pass  # the batch is written by the next run
        flows.each_batch(_delivered(v, folder), marks, write, once=True).awaitTermination()
    flows.write_offers(_delivered(v, folder), whole, whole_marks, once=True).awaitTermination()
    columns = ["offer_id", "price_ngn", "seats_left", "fetched_at"]
    resumed = v.spark.read.schema(f"{OFFER}, batch int").parquet(out).select(*columns)
    at_once = v.spark.read.schema(OFFER).parquet(whole).select(*columns)
    return resumed.unionByName(at_once).groupBy(*columns).agg(
        F.count(F.lit(1)).cast("int").alias("copies")
    )


# --------------------------------------------------------------- dimensions --


@question(
    "dim_places",
    S.with_views(S.OBS)
    + f"""
  SELECT p.code, p.name, p.kind, p.timezone, p.country, p.has_airport,
    p.airport_ground_minutes, count(o.origin) AS n_observations
  FROM (VALUES {", ".join(str(p) for p in registry.PLACES)})
    AS p(code, name, kind, timezone, country, has_airport, airport_ground_minutes)
  LEFT JOIN obs o ON o.origin = p.code GROUP BY ALL""",
)
def dim_places(v):
    seen = v.obs.groupBy(F.col("origin").alias("code")).agg(F.count("*").alias("n"))
    return (
        registry.places(v.spark)
        .join(seen, "code", "left")
        .withColumn("n_observations", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@question(
    "route_pairs",
    S.with_views(S.OBS)
    + f"""
  SELECT r.origin, r.destination, count(o.origin) AS n_observations
  FROM (SELECT split_part(x, '-', 1) AS origin, split_part(x, '-', 2) AS destination
    FROM (SELECT unnest([{S.ROUTE_LIST}]) AS x)) r
  LEFT JOIN obs o ON o.origin = r.origin AND o.destination = r.destination GROUP BY ALL""",
)
def route_pairs(v):
    keys = ["origin", "destination"]
    seen = v.obs.groupBy(*keys).agg(F.count("*").alias("n"))
    return (
        registry.routes(v.spark)
        .join(seen, keys, "left")
        .select(*keys, F.coalesce("n", F.lit(0)).alias("n_observations"))
    )


_LEGS = ", ".join(
    f"('{c[0]}', '{c[2]}', '{a}', '{b}')"
    for c in registry.CARRIERS
    for route in c[3]
    for a, b in (route.split("-"), route.split("-")[::-1])
)


@question(
    "carrier_directions",
    S.with_views(S.OBS)
    + f"""
  SELECT l.carrier_key, l.mode, l.origin, l.destination, count(o.origin) AS n_observations
  FROM (VALUES {_LEGS}) AS l(carrier_key, mode, origin, destination)
  LEFT JOIN obs o ON o.carrier_key = l.carrier_key AND o.origin = l.origin
    AND o.destination = l.destination GROUP BY ALL""",
)
def carrier_directions(v):
    keys = ["carrier_key", "origin", "destination"]
    seen = v.obs.groupBy(*keys).agg(F.count("*").alias("n"))
    return (
        registry.carrier_directions(v.spark)
        .join(seen, keys, "left")
        .select("carrier_key", "mode", "origin", "destination",
                F.coalesce("n", F.lit(0)).alias("n_observations"))
    )


# ------------------------------------------------------------ scalar values --


@question(
    "offer_id", S.with_views(S.OBS) + "SELECT event_id, offer_id AS computed_id FROM obs"
)
def offer_id(v):
    """The id recomputed from names, padded codes and local departure text."""
    text = times.render_departure(F.col("depart_time"), F.col("origin"))
    named = F.when(F.col("event_id") % 2 == 0, F.col("carrier")).otherwise(
        F.upper("carrier_key")
    )
    return v.obs.select(
        "event_id",
        identity.offer_id(
            named, F.concat(F.lit(" "), F.upper("mode")), F.lower("origin"),
            F.col("destination"), times.instant(text),
        ).alias("computed_id"),
    )


@question(
    "depart_local",
    S.with_views(S.OBS)
    + f"""SELECT event_id, {S.local_text('depart_time', 'origin')} AS depart_local,
    epoch_us(depart_time) AS wall_us FROM obs""",
)
def depart_local(v):
    local = times.render_departure(F.col("depart_time"), F.col("origin"))
    return v.obs.select(
        "event_id",
        local.alias("depart_local"),
        F.unix_micros(
            times.wall_clock_instant(F.substring(local, 1, 19), F.col("origin"))
        ).alias("wall_us"),
    )


@question(
    "utc_instant",
    """SELECT event_id, CASE event_id % 4 WHEN 2 THEN NULL
      ELSE epoch_us(ts) // 1000000 * 1000000 END AS instant_us FROM events""",
)
def utc_instant(v):
    ts = F.col("ts").cast("timestamp")
    lagos = times.render_local(ts, "Africa/Lagos")
    shape = F.col("event_id") % 4
    text = (
        F.when(shape == 0, times.render_utc(ts))
        .when(shape == 1, lagos)
        .when(shape == 2, F.substring(lagos, 1, 19))
        .otherwise(F.concat(F.lit(" "), F.regexp_replace(lagos, ":(00)$", "$1")))
    )
    return v.table("events").select(
        "event_id", F.unix_micros(times.instant(text)).alias("instant_us")
    )


@question(
    "fetched_render", f"SELECT event_id, {S.utc_text('ts')} AS fetched_at FROM events"
)
def fetched_render(v):
    return v.table("events").select(
        "event_id", times.render_utc(F.col("ts").cast("timestamp")).alias("fetched_at")
    )


@question(
    "parse_price",
    S.with_views(S.OBS)
    + """
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN price_ngn WHEN 1 THEN price_ngn
      WHEN 2 THEN price_ngn * 1000000 WHEN 5 THEN price_ngn + 0.5 END AS price FROM obs""",
)
def parse_price(v):
    whole = F.format_number("price_ngn", 0)
    digits = F.col("price_ngn").cast("bigint").cast("string")
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.concat(F.lit("NGN "), whole))
        .when(kind == 1, F.concat(F.lit("₦"), whole, F.lit(".00")))
        .when(kind == 2, F.concat(digits, F.lit(".000.000")))
        .when(kind == 3, F.lit("sold out"))
        .when(kind == 4, F.lit("0.00"))
        .otherwise(F.concat(F.lit("£"), digits, F.lit(".50")))
    )
    return v.obs.select("event_id", money.parse_price(text).alias("price"))


@question(
    "to_ngn",
    """
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN round(value, 2)
      WHEN 1 THEN round(value * 2050, 2) END AS price_ngn FROM events""",
)
def to_ngn(v):
    kind = F.col("event_id") % 4
    code = (
        F.when(kind == 0, " ngn ").when(kind == 1, "GBP").when(kind == 2, "USD").otherwise("NGN")
    )
    amount = F.when(kind == 3, -F.col("value")).otherwise(F.col("value"))
    return v.table("events").select("event_id", money.to_ngn(amount, code).alias("price_ngn"))


@question(
    "route_key",
    S.with_views(S.OBS)
    + """SELECT event_id, 'LOS-' || far AS route_key, origin || '-' || destination AS route
  FROM obs""",
)
def route_key(v):
    o, d = F.col("origin"), F.col("destination")
    return v.obs.select(
        "event_id",
        identity.route_key(o, d).alias("route_key"),
        identity.route_label(o, d).alias("route"),
    )


@question(
    "coerce_types",
    S.with_views(S.OBS)
    + """SELECT event_id, duration_min, price_ngn,
      CASE WHEN event_id % 31 <> 0 THEN seats_left END AS seats_left FROM obs""",
)
def coerce_types(v):
    """Hash-store records: every value is text, some of it not a number."""
    stored = v.obs.select(
        "event_id",
        F.concat(F.col("duration_min").cast("string"), F.lit(".0")).alias("duration_min"),
        F.col("price_ngn").cast("string").alias("price_ngn"),
        F.when(F.col("event_id") % 31 == 0, "n/a")
        .otherwise(F.col("seats_left").cast("string"))
        .alias("seats_left"),
    )
    return normalise.coerce(stored)


_PERCENT = f"CAST(floor({S.PROBABILITY} * 100 + 0.5) AS BIGINT)"


@question(
    "prediction_label",
    S.with_views(S.OBS, S.PREDICTIONS)
    + f"""
  SELECT event_id, CASE WHEN {_PERCENT} BETWEEN 40 AND 60 THEN 'Could go either way'
    WHEN {S.PROBABILITY} >= 0.5 THEN 'Likely to rise' ELSE 'Unlikely to rise' END
    || ' (' || {_PERCENT} || '%)' AS label
  FROM events""",
)
def prediction_label(v):
    p = probability()
    return v.table("events").select(
        "event_id", dashboard.prediction_label(p, p >= 0.5).alias("label")
    )


# ----------------------------------------------------------------- contract --

_DEPARTED = "depart_time <= date_trunc('second', fetched_at)"
_NOT_SHAPE = "kind NOT IN (0, 1, 2, 3, 4, 8)"


@question(
    "contract_check",
    S.with_views(S.OBS)
    + f"""
  SELECT event_id, concat_ws('|',
      CASE kind WHEN 4 THEN 'required:seats_left' WHEN 0 THEN 'length:carrier'
        WHEN 1 THEN 'enum:mode' WHEN 2 THEN 'range:duration_min' WHEN 3 THEN 'range:price_ngn'
        WHEN 8 THEN 'length:booking_url' END,
      CASE WHEN kind = 5 THEN 'same_place' END,
      CASE WHEN kind = 9 THEN 'unsupported_route' END,
      CASE WHEN kind = 12 THEN 'impossible_mode:destination' END,
      CASE WHEN kind = 6 THEN 'no_offset:depart_time' WHEN kind = 10
        THEN 'no_offset:fetched_at' END,
      CASE WHEN {_NOT_SHAPE} AND kind NOT IN (6, 10) AND {_DEPARTED}
        THEN 'already_departed' END,
      CASE WHEN kind = 11 THEN 'unknown_carrier' END,
      CASE WHEN kind IN (5, 7, 9, 12) THEN 'wrong_offer_id' END)
    AS errors
  FROM (SELECT *, event_id % 26 AS kind FROM obs)""",
)
def contract_check(v):
    """Offers of which half are damaged in one of thirteen ways."""
    kind = F.col("event_id") % 26

    def hurt(k: int, column: str, value) -> Column:
        return F.when(kind == k, value).otherwise(F.col(column))

    offers = v.as_text(v.obs).withColumns(
        {
            "carrier": F.when(kind == 0, "X").otherwise(hurt(11, "carrier", "Nobody Air")),
            "mode": F.when(kind == 1, "sea").otherwise(hurt(12, "mode", "air")),
            "duration_min": hurt(2, "duration_min", 0),
            "price_ngn": hurt(3, "price_ngn", -1.0),
            "seats_left": hurt(4, "seats_left", F.lit(None)),
            "origin": F.when(kind == 9, "PHC").otherwise(hurt(12, "origin", "LOS")),
            "destination": F.when(kind == 5, F.col("origin"))
            .when(kind == 9, "ABV")
            .otherwise(hurt(12, "destination", "ONI")),
            "depart_time": hurt(6, "depart_time", F.substring("depart_time", 1, 19)),
            "offer_id": hurt(7, "offer_id", F.regexp_replace("offer_id", r"\d\dZ$", "59Z")),
            "booking_url": hurt(8, "booking_url", ""),
            "fetched_at": hurt(10, "fetched_at", F.substring("fetched_at", 1, 19)),
        }
    )
    return contract.check_offers(offers).select(
        "event_id", F.array_join("contract_errors", "|").alias("errors")
    )


@question(
    "quarantine",
    S.with_views(S.OBS)
    + f"""
  SELECT CASE WHEN mode = 'road' AND {_UNKNOWN}
      THEN 'required:offer_id|required:origin|required:destination'
    ELSE 'already_departed' END AS reason, count(*) AS n
  FROM obs WHERE event_id % 41 <> 0
    AND (mode = 'road' AND {_UNKNOWN} OR {_DEPARTED}) GROUP BY 1""",
)
def quarantine(v):
    """All feeds normalised without a default place; the refused rows, by reason."""
    checked = contract.check_offers(normalise.unify_messages(v.messages(v.spread_obs()), None))
    _, bad = contract.split_valid(checked)
    return bad.groupBy(F.array_join("contract_errors", "|").alias("reason")).agg(
        F.count("*").alias("n")
    )


@question(
    "contract_messages",
    S.with_views(S.OBS)
    + f"""
  SELECT event_id, CASE kind WHEN 0 THEN 'unexpected:card'
      WHEN 1 THEN 'type:price_ngn|required:price_ngn'
      WHEN 2 THEN 'type:price_ngn|required:price_ngn'
      WHEN 3 THEN 'type:seats_left|required:seats_left'
      WHEN 4 THEN 'type:carrier|required:carrier'
      WHEN 5 THEN 'type:duration_min|required:duration_min'
      WHEN 6 THEN 'required:origin' WHEN 7 THEN 'type:booking_url|required:booking_url'
      WHEN 8 THEN 'not_an_object' WHEN 9 THEN 'not_an_object'
      WHEN 10 THEN 'unexpected:card|unexpected:zone' WHEN 11 THEN 'required:price_ngn'
      ELSE CASE WHEN {_DEPARTED} THEN 'already_departed' ELSE '' END END AS errors
  FROM (SELECT *, event_id % 26 AS kind FROM obs)""",
)
def contract_messages(v):
    """Every event as a raw JSON message, of which nearly half are damaged in one of twelve ways."""
    kind = F.col("event_id") % 26

    def field(name: str, value: str) -> Column:
        return F.regexp_replace("value", f'"{name}":(?:"[^"]*"|[^,}}]+)', f'"{name}":{value}')

    damaged = {
        0: F.regexp_replace("value", r"^\{", '{"card":"4111",'),
        1: field("price_ngn", '"call us"'),
        2: field("price_ngn", '"25000.0"'),
        3: field("seats_left", "1.5"),
        4: field("carrier", "5"),
        5: field("duration_min", "true"),
        6: F.regexp_replace("value", '"origin":"[^"]*",', ""),
        7: field("booking_url", '{"href":"https://x.example"}'),
        8: F.concat(F.lit("["), "value", F.lit("]")),
        9: F.substring("value", 1, 40),
        10: F.regexp_replace("value", r"^\{", '{"card":"4111","zone":1,'),
        11: field("price_ngn", "null"),
    }
    sent = v.as_text(v.obs).select(
        "event_id", F.to_json(F.struct(*OFFER_COLUMNS)).alias("value")
    )
    value = F.coalesce(*[F.when(kind == k, text) for k, text in damaged.items()], F.col("value"))
    return contract.check_messages(sent.withColumn("value", value)).select(
        "event_id", F.array_join("contract_errors", "|").alias("errors")
    )


@question(
    "prediction_constraints",
    S.with_views(S.OBS, S.PREDICTIONS)
    + """
  SELECT offer_id, epoch_us(predicted_at) AS predicted_us,
    CASE WHEN CAST(1.5 AS DOUBLE) * probability - CAST(0.2 AS DOUBLE) BETWEEN 0 AND 1
      THEN '' ELSE 'probability' END AS errors FROM predictions""",
)
def prediction_constraints(v):
    """What the prediction log refuses, of predictions stretched beyond a probability."""
    rows = v.predictions.withColumn("probability", F.lit(1.5) * F.col("probability") - F.lit(0.2))
    return rows.select(
        "offer_id", F.unix_micros("predicted_at").alias("predicted_us"),
        F.array_join(contract.prediction_problems(), "|").alias("errors"),
    )


@question(
    "booking_constraints",
    S.with_views(S.OBS, S.LEDGER)
    + """
  SELECT idempotency_key, CASE WHEN length(idempotency_key) % 3 = 0 THEN 'state' ELSE '' END
    AS errors FROM ledger""",
)
def booking_constraints(v):
    """What the ledger refuses, of rows of which a third are in no legal state."""
    state_ = F.when(F.length("idempotency_key") % 3 == 0, "lost").otherwise(F.col("state"))
    return v.ledger.withColumn("state", state_).select(
        "idempotency_key", F.array_join(contract.booking_problems(), "|").alias("errors")
    )


@question(
    "history_constraints",
    S.with_views(S.OBS)
    + """
  SELECT event_id, concat_ws('|',
    CASE WHEN event_id % 13 = 0 THEN 'mode' END, CASE WHEN event_id % 11 = 0 THEN 'duration_min' END,
    CASE WHEN event_id % 17 = 0 THEN 'price_ngn' END, CASE WHEN event_id % 19 = 0 THEN 'seats_left'
    END) AS errors FROM obs""",
)
def history_constraints(v):
    e = F.col("event_id")
    rows = v.obs.withColumns(
        {
            "mode": F.when(e % 13 != 0, F.col("mode")),
            "duration_min": F.when(e % 11 == 0, 0).otherwise(F.col("duration_min")),
            "price_ngn": F.when(e % 17 == 0, 0.0).otherwise(F.col("price_ngn")),
            "seats_left": F.when(e % 19 == 0, -1).otherwise(F.col("seats_left")),
        }
    )
    return rows.select(
        "event_id", F.array_join(contract.history_problems(), "|").alias("errors")
    )


@question(
    "bulk_load_tsv",
    S.with_views(S.OBS)
    + """SELECT offer_id, carrier, mode, origin, destination, epoch_us(depart_time) AS depart_us,
    duration_min, price_ngn, seats_left, booking_url, epoch_us(fetched_at) AS fetched_us FROM obs""",
)
def bulk_load_tsv(v):
    path = new_path(v.spark, "tsv")
    tables.write_tsv(v.history, path)
    return _stored(tables.read_tsv(v.spark, path))


def _stored(history: DataFrame) -> DataFrame:
    return history.select(
        *[c for c in OFFER_COLUMNS if c not in ("depart_time", "fetched_at", "price_ngn")],
        F.col("price_ngn").cast("double").alias("price_ngn"),
        F.unix_micros("depart_time").alias("depart_us"),
        F.unix_micros("fetched_at").alias("fetched_us"),
    )
