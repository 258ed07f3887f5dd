"""Searches, rankings, text queries, bookings and operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.operators import bookings, contract, intents, ops, ranking
from fareloom.operators.history import newest
from fareloom.plans import search
from fareloom.plans import view_sql as S
from fareloom.plans.registry import question
from fareloom.plans.views import (
    LISTING_NOW, STALE_AFTER, TEXT_SHAPES, pick,
)
from fareloom.sources import registry

_SALE = S.with_views(S.LISTING, S.SALE)
_SEARCH = S.with_views(S.LISTING, S.SALE, S.REQUESTS)


@question("upcoming_offers", _SALE + "SELECT offer_id, depart_time FROM sale")
def upcoming_offers(v):
    return ranking.upcoming(v.latest, v.at(LISTING_NOW)).select("offer_id", "depart_time")


@question(
    "annotate_offers",
    _SALE.replace(f"WHERE depart_at > {S.LISTING_AT}", "")
    + "SELECT offer_id, door_to_door_min, age_seconds, stale FROM sale",
)
def annotate_offers(v):
    """Stale offers are marked and kept."""
    rows = ranking.annotate(v.latest, v.at(LISTING_NOW), STALE_AFTER)
    return rows.select("offer_id", "door_to_door_min", "age_seconds", "stale")


@question(
    "door_to_door",
    S.with_views(S.LISTING) + f"SELECT offer_id, mode, {S.DOOR} AS door_to_door_min FROM latest",
)
def door_to_door(v):
    return v.latest.select(
        "offer_id", "mode",
        ranking.door_to_door(
            F.col("mode"), F.col("origin"), F.col("destination"), F.col("duration_min")
        ).alias("door_to_door_min"),
    )


_BEST = {
    "cheapest": "price_ngn, door_to_door_min, carrier, offer_id",
    "fastest": "door_to_door_min, price_ngn, carrier, offer_id",
}


def _rank_question(kind: str):
    sql = f"""SELECT offer_id, carrier, price_ngn, door_to_door_min FROM sale
  ORDER BY {_BEST[kind]} LIMIT 50"""

    @question(f"rank_{kind}", _SALE + sql)
    def run(v):
        sale = search.on_sale(v.latest, v.at(LISTING_NOW), STALE_AFTER)
        return ranking.ranked(sale, kind, 50).select(
            "offer_id", "carrier", "price_ngn", "door_to_door_min"
        )

    return run


for _kind in _BEST:
    _rank_question(_kind)


def _minutes(name: str) -> str:
    return (
        f"CASE WHEN {name} >= 60 THEN ({name} // 60) || 'h ' || lpad(CAST({name} % 60 AS VARCHAR), "
        f"2, '0') || 'm' ELSE {name} || 'm' END"
    )


@question(
    "offer_labels",
    _SALE
    + f"""
  SELECT offer_id, 'NGN ' || format('{{:,}}', CAST(floor(price_ngn + 0.5) AS BIGINT))
      AS price_label, substr(depart_time, 12, 5) AS departs,
    {_minutes('door_to_door_min')} AS journey_label, {_minutes('duration_min')}
      AS scheduled_label, door_to_door_min <> duration_min AS has_ground_time,
    CASE mode WHEN 'air' THEN 'Flight' ELSE 'Coach' END AS mode_label,
    CASE WHEN stale THEN 'Last updated ' || CAST(floor(age_seconds / 60 + 0.5) AS BIGINT)
      || ' minutes ago' END AS stale_label
  FROM sale""",
)
def offer_labels(v):
    return ranking.offer_labels(search.on_sale(v.latest, v.at(LISTING_NOW), STALE_AFTER))


def _lists_sql(requests: str, extra: str = "") -> str:
    parts = [
        f"""
  SELECT r.request_id, '{kind}' AS kind, row_number() OVER (PARTITION BY r.request_id
      ORDER BY {_BEST[kind]}) AS rank, r.lim, s.offer_id, s.carrier, s.price_ngn,
    s.door_to_door_min, s.stale
  FROM {requests} r JOIN sale s ON s.origin = r.origin AND s.destination = r.destination
    AND (r.date IS NULL OR r.date = s.board_date) WHERE {extra or "true"}"""
        for kind in _BEST
    ]
    return " UNION ALL ".join(parts)


_LIST_COLUMNS = [
    "request_id", "kind", "rank", "offer_id", "carrier", "price_ngn", "door_to_door_min", "stale",
]


@question(
    "search_requests",
    _SEARCH
    + f"""
  SELECT request_id, kind, CAST(rank AS INTEGER) AS rank, offer_id, carrier, price_ngn,
    door_to_door_min, stale
  FROM ({_lists_sql('checked', "r.status = 'ok'")}) WHERE rank <= lim""",
)
def search_requests(v):
    return search.search_lists(v.requests, v.latest, v.at(LISTING_NOW), STALE_AFTER).select(
        *_LIST_COLUMNS
    )


@question(
    "search_envelope",
    _SEARCH
    + f"""
  SELECT r.request_id, r.origin, r.destination, r.date, r.status,
    CASE WHEN r.status = 'ok' THEN count(s.offer_id) END AS count,
    CASE WHEN r.status = 'ok' THEN count(*) FILTER (s.stale) END AS stale_count,
    CASE WHEN r.status = 'ok' THEN count(s.offer_id) > 0
      AND count(*) FILTER (s.stale) = count(s.offer_id) END AS stale,
    {S.utc_text(S.LISTING_AT)} AS searched_at
  FROM checked r LEFT JOIN sale s ON s.origin = r.origin AND s.destination = r.destination
    AND (r.date IS NULL OR r.date = s.board_date) GROUP BY 1, 2, 3, 4, 5""",
)
def search_envelope(v):
    return search.search_envelope(v.requests, v.latest, v.at(LISTING_NOW), STALE_AFTER)


@question(
    "supported_routes",
    S.with_views(S.REQUESTS) + "SELECT request_id, origin, destination FROM checked WHERE "
    "status = 'ok'",
)
def supported_routes(v):
    asked = v.requests.select(
        "request_id", F.upper("origin").alias("origin"), F.upper("destination").alias(
            "destination")
    )
    return asked.join(registry.routes(v.spark), ["origin", "destination"], "left_semi")


@question(
    "offer_detail",
    S.with_views(
        S.LISTING,
        f"""asked AS (SELECT DISTINCT CASE WHEN l_orderkey % 17 = 0 THEN 'gone-' || offer_id
        ELSE offer_id END AS offer_id FROM (SELECT l_orderkey,
        {S.id_of('carrier_key', 'mode', 'origin', 'destination', 'depart_at')} AS offer_id
        FROM (SELECT lst1.*, row_number() OVER () AS l_orderkey FROM lst1)))""",
    )
    + f"""
  SELECT a.offer_id, CASE WHEN l.offer_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
    l.price_ngn, CASE WHEN l.offer_id IS NULL THEN NULL
      WHEN l.depart_at <= l.seen_at THEN 'already_departed' ELSE '' END AS errors
  FROM (SELECT offer_id FROM latest UNION ALL SELECT 'gone-' || offer_id FROM latest) a
  LEFT JOIN latest l ON l.offer_id = a.offer_id""",
)
def offer_detail(v):
    """Every id once as it is and once as an id that does not exist."""
    ids = v.latest.select(
        F.explode(
            F.array(F.col("offer_id"), F.concat(F.lit("gone-"), F.col("offer_id")))
        ).alias("offer_id")
    )
    rows = search.offer_detail(ids, v.latest, v.at(LISTING_NOW), STALE_AFTER)
    return rows.select(
        "offer_id", "status", "price_ngn",
        F.array_join("contract_errors", "|").alias("errors"),
    )


@question(
    "offers_with_predictions",
    S.with_views(S.OBS, S.LATEST_OBS, S.PREDICTIONS)
    + """
  SELECT l.offer_id, l.price_ngn, p.will_rise, p.probability FROM latest_obs l LEFT JOIN (
    SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY offer_id
      ORDER BY predicted_at DESC) = 1) p USING (offer_id)""",
)
def offers_with_predictions(v):
    last = newest(v.predictions, "offer_id", "predicted_at")
    return search.with_predictions(v.latest_obs, last).select(
        "offer_id", "price_ngn", "will_rise", "probability"
    )


# -------------------------------------------------------------- text queries --

# What each phrase template means, stated outright: where the origin and the
# destination come from, which day, which preference.
_P, _Q = "pc", "qc"
_ONE = ("'LOS'", f"CASE WHEN {_P} IS NULL OR {_P} = 'LOS' THEN '' ELSE {_P} END")
_PAIR_WITH_LAGOS = (
    f"CASE WHEN {_P} IS NULL OR {_P} = 'LOS' THEN 'LOS' ELSE {_P} END",
    f"CASE WHEN {_P} IS NULL THEN '' ELSE 'LOS' END",
)


def _d(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def _weekday(target: int, following: bool) -> str:
    gap = f"((({target} - (isodow(today) - 1)) % 7 + 7) % 7)"
    ahead = f"{gap} + 7" if following else gap
    return _d(f"today + CAST(CASE WHEN {gap} = 0 THEN 7 ELSE {ahead} END AS INTEGER)")


_TO_P = ("'LOS'", f"coalesce({_P}, '')")
# to {P}: the other end is Lagos even when P is Lagos (then both ends agree).
_FROM_TO = (
    f"""CASE WHEN {_P} IS NOT NULL AND {_Q} IS NOT NULL THEN {_P}
      WHEN {_Q} IS NOT NULL THEN 'LOS' ELSE 'LOS' END""",
    f"""CASE WHEN {_Q} IS NOT NULL THEN {_Q} WHEN {_P} IS NULL OR {_P} = 'LOS' THEN ''
      ELSE {_P} END""",
)
_TO_FROM = (
    f"CASE WHEN {_P} IS NOT NULL AND {_Q} IS NOT NULL THEN {_Q} ELSE 'LOS' END",
    f"""CASE WHEN {_P} IS NOT NULL THEN {_P} WHEN {_Q} IS NULL OR {_Q} = 'LOS' THEN ''
      ELSE {_Q} END""",
)
_FROM_ONE = ("'LOS'", f"CASE WHEN {_P} IS NULL OR {_P} = 'LOS' THEN '' ELSE {_P} END")
_P_Q = (
    f"""CASE WHEN {_P} IS NOT NULL AND {_Q} IS NOT NULL THEN {_P} ELSE 'LOS' END""",
    f"""CASE WHEN {_P} IS NOT NULL AND {_Q} IS NOT NULL THEN {_Q}
      WHEN coalesce({_P}, {_Q}) IS NULL OR coalesce({_P}, {_Q}) = 'LOS' THEN ''
      ELSE coalesce({_P}, {_Q}) END""",
)
_LAGOS_P = ("'LOS'", f"coalesce({_P}, '')")
_P_LAGOS = (f"coalesce({_P}, 'LOS')", f"CASE WHEN {_P} IS NULL THEN '' ELSE 'LOS' END")
_LOST = ("'LOS'", "''")

_FIFTH = _d(
    "CASE WHEN make_date(year(today), month(today), 5) >= today "
    "THEN make_date(year(today), month(today), 5) "
    "ELSE make_date(year(today) + 1, month(today), 5) END"
)
_MEANING = [
    (_TO_P, _weekday(4, True), "cheapest"),
    (_FROM_TO, _d("today + 1"), "cheapest"),
    (_TO_P, _d("DATE '1998-09-14'"), "fastest"),
    (_P_LAGOS, "NULL", "cheapest"),
    (_ONE, "'1998-10-05'", "fastest"),
    (_ONE, _d("today + 2"), "cheapest"),
    (_TO_FROM, _weekday(0, False), "cheapest"),
    (_ONE, "NULL", "cheapest"),
    (_FROM_ONE, _FIFTH, "cheapest"),
    (_TO_P, "NULL", "cheapest"),
    (_LOST, _d("today"), "cheapest"),
    (_P_Q, _d("today + 7"), "cheapest"),
    (_TO_P, _d("today"), "fastest"),
    (_LAGOS_P, _d("DATE '1999-01-03'"), "cheapest"),
    (_ONE, "'1998-13-40'", "cheapest"),
]
assert len(_MEANING) == len(TEXT_SHAPES)


def _by_shape(values) -> str:
    arms = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values))
    return f"CASE shape {arms} END"


_PARSED = f"""
parsed AS (
  SELECT *, {_by_shape(m[0][0] for m in _MEANING)} AS origin,
    {_by_shape(m[0][1] for m in _MEANING)} AS destination,
    {_by_shape(m[1] for m in _MEANING)} AS date,
    {_by_shape(repr(m[2]) for m in _MEANING)} AS preference
  FROM coded),
judged AS (
  SELECT *, concat_ws('; ',
      CASE WHEN destination = '' THEN 'no destination could be identified' END,
      CASE WHEN origin = destination THEN 'origin and destination are the same place' END,
      CASE WHEN date = '1998-13-40' THEN 'date is not a calendar date' END) AS problems
  FROM parsed)"""
_TEXT = S.with_views(S.TEXTS, _PARSED)


@question(
    "intent_places",
    S.with_views(S.TEXTS)
    + f"""
  SELECT query_id, coalesce(array_to_string(CASE
      WHEN shape IN (1, 6, 11) THEN [pc, qc] WHEN shape = 3 THEN [pc, 'LOS']
      WHEN shape = 13 THEN ['LOS', pc] WHEN shape = 10 THEN []
      ELSE [pc] END, ','), '') AS places,
    CASE WHEN shape = 1 THEN pc WHEN shape = 6 THEN qc WHEN shape = 8 THEN pc END AS after_from,
    CASE WHEN shape IN (0, 2, 6, 9, 12) THEN pc WHEN shape = 1 THEN qc END AS after_to
  FROM coded""",
)
def intent_places(v):
    text = F.col("text")
    return v.texts.select(
        "query_id",
        F.array_join(intents.places_named(text), ",").alias("places"),
        intents.place_after(text, "from").alias("after_from"),
        intents.place_after(text, "to").alias("after_to"),
    )


@question("intent_route", _TEXT + "SELECT query_id, origin, destination FROM parsed")
def intent_route(v):
    return intents.with_route(v.texts).select("query_id", "origin", "destination")


@question("intent_date", _TEXT + "SELECT query_id, date FROM parsed")
def intent_date(v):
    return v.texts.select(
        "query_id", intents.travel_date(F.col("text"), F.col("today")).alias("date")
    )


@question("intent_preference", _TEXT + "SELECT query_id, preference FROM parsed")
def intent_preference(v):
    return v.texts.select("query_id", intents.preference(F.col("text")).alias("preference"))


@question(
    "intent_validate",
    _TEXT
    + """SELECT query_id, origin, destination, date, preference, destination <> '' AS confident,
    problems FROM judged""",
)
def intent_validate(v):
    return intents.parse(v.texts).select(
        "query_id", "origin", "destination", "date", "preference", "confident",
        F.array_join("problems", "; ").alias("problems"),
    )


_TEXT_REQUESTS = f"""
treq AS (
  SELECT query_id AS request_id, origin, destination, date, 10 AS lim,
    CASE WHEN origin || '-' || destination IN ({S.ROUTE_LIST}) THEN 'ok'
      ELSE 'out_of_scope' END AS status, preference
  FROM judged WHERE problems = '')"""


@question(
    "search_text",
    S.with_views(S.LISTING, S.SALE, S.TEXTS, _PARSED, _TEXT_REQUESTS)
    + f"""
  SELECT request_id AS query_id, kind = preference AS shown_first, kind,
    CAST(rank AS INTEGER) AS rank, offer_id
  FROM ({_lists_sql('treq', "r.status = 'ok'")}) JOIN treq USING (request_id)
  WHERE rank <= 10""",
)
def search_text(v):
    _, lists = search.search_text(v.texts, v.latest, v.at(LISTING_NOW), stale_after=STALE_AFTER)
    shown = intents.parse(v.texts).select("query_id", "preference")
    return lists.withColumnRenamed("request_id", "query_id").join(shown, "query_id").select(
        "query_id", (F.col("kind") == F.col("preference")).alias("shown_first"), "kind", "rank",
        "offer_id",
    )


@question(
    "search_text_envelope",
    S.with_views(S.LISTING, S.SALE, S.TEXTS, _PARSED, _TEXT_REQUESTS)
    + """
  SELECT j.query_id, coalesce(r.status, 'not_understood') AS status,
    CASE WHEN r.status = 'ok' THEN count(s.offer_id) END AS count
  FROM judged j LEFT JOIN treq r ON r.request_id = j.query_id
  LEFT JOIN sale s ON r.status = 'ok' AND s.origin = r.origin AND s.destination = r.destination
    AND (r.date IS NULL OR r.date = s.board_date) GROUP BY j.query_id, r.status""",
)
def search_text_envelope(v):
    answer, _ = search.search_text(
        v.texts, v.latest, v.at(LISTING_NOW), stale_after=STALE_AFTER
    )
    return answer.select("query_id", "status", "count")


# ------------------------------------------------------------------ bookings --


@question(
    "derive_key",
    S.with_views(S.OBS, S.BOOKING_REQUESTS)
    + "SELECT request_id, idempotency_key FROM keyed",
)
def derive_key(v):
    return bookings.with_key(v.booking_requests).select("request_id", "idempotency_key")


@question(
    "booking_claims",
    S.with_views(S.OBS, S.BOOKING_REQUESTS, S.LEDGER)
    + """
  SELECT request_id, idempotency_key, is_new, NOT is_new AS replayed,
    CASE WHEN is_new THEN 'pending' ELSE coalesce(held_state, 'pending') END AS state,
    CASE WHEN is_new THEN NULL
      WHEN coalesce(held_state, 'pending') = 'pending'
        THEN 'already started, waiting at the carrier''s checkout'
      WHEN held_state = 'confirmed' THEN 'already booked: ' || provider_reference
      WHEN held_state = 'failed' THEN 'already failed, not retried: ' || last_error
      ELSE 'outcome unknown, not retried, needs reconciling' END AS detail
  FROM (SELECT k.request_id, k.idempotency_key, l.state AS held_state, l.provider_reference,
      l.last_error, l.state IS NULL AND row_number() OVER (PARTITION BY k.idempotency_key
        ORDER BY k.requested_at, k.request_id) = 1 AS is_new
    FROM keyed k LEFT JOIN ledger l USING (idempotency_key))""",
)
def booking_claims(v):
    return bookings.claims(v.booking_requests, v.ledger).select(
        "request_id", "idempotency_key", "is_new", "replayed", "state", "detail"
    )


@question(
    "book_requests",
    S.with_views(S.OBS, S.LATEST_OBS, S.BOOKING_REQUESTS, S.LEDGER)
    + """
  SELECT request_id, idempotency_key, is_new,
    CASE WHEN held_state IS NOT NULL THEN held_state WHEN first_moved THEN 'failed'
      ELSE 'pending' END AS state
  FROM (SELECT k.request_id, k.idempotency_key, g.state AS held_state,
      g.state IS NULL AND row_number() OVER w = 1 AS is_new,
      first_value(l.price_ngn > k.quoted_price_ngn * 1.01::DOUBLE) OVER w AS first_moved
    FROM keyed k JOIN latest_obs l USING (offer_id) LEFT JOIN ledger g USING (idempotency_key)
    WINDOW w AS (PARTITION BY k.idempotency_key ORDER BY k.requested_at, k.request_id))
  UNION ALL SELECT request_id, NULL, false, 'no_offer' FROM breq
  WHERE offer_id NOT IN (SELECT offer_id FROM latest_obs)""",
)
def book_requests(v):
    return bookings.book_requests(v.booking_requests, v.latest_obs, v.ledger).select(
        "request_id", "idempotency_key", "is_new", "state"
    )


@question(
    "booking_status",
    S.with_views(S.OBS, S.BOOKING_REQUESTS, S.LEDGER)
    + """SELECT k.idempotency_key, l.offer_id, coalesce(l.state, 'none') AS state,
    l.provider_reference
  FROM (SELECT DISTINCT idempotency_key FROM keyed) k LEFT JOIN ledger l USING (idempotency_key)""",
)
def booking_status(v):
    return bookings.booking_status(bookings.with_key(v.booking_requests), v.ledger)


@question(
    "price_guard",
    S.with_views(S.OBS, S.LATEST_OBS, S.BOOKING_REQUESTS)
    + """
  SELECT b.request_id, CASE WHEN l.price_ngn IS NULL THEN 'no_offer'
      WHEN l.price_ngn > b.quoted_price_ngn * 1.01::DOUBLE THEN 'price_changed' ELSE 'ok' END
      AS status, l.price_ngn AS live_price_ngn,
    CASE WHEN l.price_ngn > b.quoted_price_ngn * 1.01::DOUBLE THEN 'price_changed: quoted '
      || CAST(b.quoted_price_ngn AS BIGINT) || ', now ' || CAST(l.price_ngn AS BIGINT) END
      AS last_error
  FROM breq b LEFT JOIN latest_obs l USING (offer_id)""",
)
def price_guard(v):
    return bookings.price_guard(v.booking_requests, v.latest_obs).select(
        "request_id", "status", "live_price_ngn", "last_error"
    )


@question(
    "bookings_by_state",
    S.with_views(S.OBS, S.LEDGER) + "SELECT state, count(*) AS n FROM ledger GROUP BY 1",
)
def bookings_by_state(v):
    return bookings.counts_by_state(v.ledger)


@question(
    "ledger_for_offer",
    S.with_views(S.OBS, S.LEDGER)
    + """SELECT idempotency_key, offer_id, state, epoch_us(created_at) AS created_us FROM ledger
    WHERE offer_id IN (SELECT offer_id FROM obs WHERE event_type = 'error')""",
)
def ledger_for_offer(v):
    asked = v.obs.filter("event_type = 'error'")
    return bookings.for_offers(v.ledger, asked).select(
        "idempotency_key", "offer_id", "state", F.unix_micros("created_at").alias("created_us")
    )


@question(
    "reconcile_unknown",
    S.with_views(S.OBS, S.LEDGER)
    + f"""
  SELECT idempotency_key, offer_id, CASE WHEN hit THEN 'confirmed' ELSE 'failed' END AS state,
    CASE WHEN hit THEN CASE WHEN event_id % 5 <> 0 THEN 'BR' ELSE 'ord_' END || event_id END
      AS provider_reference,
    CASE WHEN NOT hit THEN '{bookings.RECONCILED_ABSENT}' END AS last_error
  FROM (SELECT *, idempotency_key = 'k-' || event_id AND event_id % 3 <> 0 AS hit
    FROM ledger WHERE state = 'unknown')""",
)
def reconcile_unknown(v):
    return bookings.reconcile(v.ledger, v.orders_at_carrier)


_KIND = """CASE outcome WHEN 'view' THEN 'success' WHEN 'click' THEN 'unreachable'
      WHEN 'signup' THEN CASE WHEN read_only THEN 'unreachable' ELSE 'timeout' END
      WHEN 'purchase' THEN CASE WHEN user_id % 7 IN (0, 1) THEN 'misconfigured'
        WHEN user_id % 7 IN (2, 3) THEN 'rejected' ELSE 'unavailable' END
      ELSE CASE WHEN event_id % 2 = 1 THEN 'unreachable' WHEN read_only THEN 'unavailable'
        ELSE 'timeout' END END"""


@question(
    "attempt_outcome",
    f"""
  WITH a AS (SELECT event_id // 4 AS k, event_id % 4 + 1 AS attempt, event_type AS outcome,
      event_id, user_id, user_id % 5 = 0 AS read_only FROM events WHERE event_id % 4 < 3),
  kinds AS (SELECT k, attempt, {_KIND} AS kind FROM a),
  stops AS (SELECT *, min(CASE WHEN kind NOT IN ('unreachable', 'unavailable') THEN attempt END)
      OVER (PARTITION BY k) AS stop FROM kinds),
  counted AS (SELECT * FROM stops WHERE stop IS NULL OR attempt <= stop)
  SELECT 'k-' || k AS idempotency_key, CAST(max(attempt) AS INTEGER) AS attempts,
    CASE WHEN arg_max(kind, attempt) = 'success' THEN 'confirmed'
      WHEN arg_max(kind, attempt) IN ('unavailable', 'timeout') THEN 'unknown'
      ELSE 'failed' END AS state,
    CASE WHEN arg_max(kind, attempt) <> 'success' THEN arg_max(kind, attempt) END AS last_error,
    bool_or(kind IN ('unavailable', 'timeout')) AS any_ambiguous
  FROM counted GROUP BY k""",
)
def attempt_outcome(v):
    return bookings.attempt_outcomes(v.attempts)


@question(
    "booking_routing",
    S.with_views(S.LISTING)
    + """SELECT offer_id, carrier, CASE mode WHEN 'air' THEN 'carrier_api' ELSE 'deeplink' END
      AS provider, mode = 'air' AS books_via_api, CASE mode WHEN 'air'
      THEN 'held through the booking API, no payment' ELSE 'no booking API for road carriers' END
      AS reason FROM latest""",
)
def booking_routing(v):
    return bookings.routing(v.latest, api_enabled=True)


@question(
    "deep_link",
    S.with_views(S.LISTING)
    + """SELECT offer_id, booking_url || '&from=' || origin || '&to=' || destination || '&date='
      || substr(depart_time, 1, 10) || '&depart=' || substr(depart_time, 12, 2) || '%3A'
      || substr(depart_time, 15, 2) || '&passengers=1&class=economy' AS deep_link FROM latest""",
)
def deep_link(v):
    return bookings.with_deep_link(v.latest).select("offer_id", "deep_link")


@question(
    "ledger_update_rules",
    """
  SELECT event_id, concat_ws('|',
    CASE WHEN event_type = 'click' THEN 'not_updatable' END,
    CASE WHEN event_type = 'view' AND event_id % 5 = 4 THEN 'invalid_state' END) AS errors FROM events""",
)
def ledger_update_rules(v):
    e = F.col("event_id")
    changes = v.table("events").select(
        "event_id",
        F.when(F.col("event_type") == "view", "state")
        .when(F.col("event_type") == "click", "offer_id")
        .when(F.col("event_type") == "signup", "attempts")
        .otherwise("last_error")
        .alias("column_name"),
        pick(["pending", "confirmed", "failed", "unknown", "refunded"], e % 5).alias("new_value"),
    )
    return changes.select(
        "event_id", F.array_join(contract.update_problems(), "|").alias("errors")
    )


_QUOTE_OWNER = S.pick([c[1] for c in registry.CARRIERS], "l_suppkey % 8")


@question(
    "pick_holdable",
    f"""
  WITH q AS (SELECT l_orderkey AS request_id, 'q' || l_partkey || '-' || l_suppkey AS quote_id,
      {_QUOTE_OWNER} AS owner, CASE WHEN l_linenumber % 7 <> 0 THEN l_extendedprice END AS amount,
      l_linenumber % 3 = 1 AS holdable FROM lineitem),
  r AS (SELECT o_orderkey AS request_id,
      {S.pick([c[1] for c in registry.CARRIERS], 'o_custkey % 8')} AS carrier FROM orders),
  best AS (SELECT q.*, owner = r.carrier AS same_carrier FROM q JOIN r USING (request_id)
    WHERE holdable QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY
      owner = r.carrier DESC, coalesce(amount, 'infinity'::DOUBLE), quote_id) = 1)
  SELECT r.request_id, b.quote_id, b.same_carrier,
    CASE WHEN b.request_id IS NOT NULL THEN 'ok' WHEN EXISTS (SELECT 1 FROM q
      WHERE q.request_id = r.request_id) THEN 'instant_payment_only' ELSE 'no_quotes' END AS status
  FROM r LEFT JOIN best b USING (request_id)""",
)
def pick_holdable(v):
    names = [c[1] for c in registry.CARRIERS]
    line = F.col("l_linenumber")
    quotes = v.table("lineitem").select(
        F.col("l_orderkey").alias("request_id"),
        F.concat(
            F.lit("q"), F.col("l_partkey").cast("string"), F.lit("-"),
            F.col("l_suppkey").cast("string"),
        ).alias("quote_id"),
        F.concat(F.upper(pick(names, F.col("l_suppkey") % 8)), F.lit(" Ltd")).alias("owner_name"),
        F.when(line % 7 != 0, F.col("l_extendedprice").cast("string")).alias("total_amount"),
        F.when(line % 3 == 0, True).when(line % 3 == 1, False).alias("requires_instant_payment"),
    )
    asked = v.table("orders").select(
        F.col("o_orderkey").alias("request_id"),
        pick(names, F.col("o_custkey") % 8).alias("carrier"),
    )
    return bookings.pick_holdable(asked, quotes).select(
        "request_id", "quote_id", "same_carrier", "status"
    )


@question(
    "booking_request_rules",
    S.with_views(S.OBS, S.BOOKING_REQUESTS)
    + """
  SELECT request_id, CASE request_id % 11 WHEN 1 THEN 'unexpected_field' WHEN 2 THEN 'offer_id'
    WHEN 3 THEN 'quoted_price_ngn' WHEN 4 THEN 'idempotency_key'
    WHEN 5 THEN 'passenger_unexpected_field' WHEN 6 THEN 'given_name' WHEN 7 THEN 'email'
    WHEN 8 THEN 'born_on' WHEN 9 THEN 'gender' ELSE '' END AS errors
  FROM breq""",
)
def booking_request_rules(v):
    """Requests as JSON bodies, most of them wrong in one way."""
    kind = F.col("request_id") % 11

    def odd(k: int, value, usual):
        return F.when(kind == k, value).otherwise(usual)

    none = F.lit(None).cast("string")
    body = F.to_json(
        F.struct(
            odd(2, "abc", F.col("offer_id")).alias("offer_id"),
            odd(3, F.lit(0.0), F.col("quoted_price_ngn")).alias("quoted_price_ngn"),
            odd(4, F.lit("short"), none).alias("idempotency_key"),
            odd(1, F.lit("4111"), none).alias("card_number"),
            F.struct(
                odd(6, F.repeat(F.lit("x"), F.lit(61)), F.lit("Ada")).alias("given_name"),
                F.lit("Obi").alias("family_name"),
                odd(7, F.lit("not an address"), F.col("email")).alias("email"),
                odd(8, F.lit("1 May 1990"), F.lit("1990-05-01")).alias("born_on"),
                odd(9, F.lit("x"), F.lit("f")).alias("gender"),
                odd(5, F.lit("123"), none).alias("cvv"),
            ).alias("passenger"),
        )
    )
    checked = contract.check_booking_requests(
        v.booking_requests.select("request_id", body.alias("body"))
    )
    return checked.select("request_id", F.array_join("request_errors", "|").alias("errors"))


# ---------------------------------------------------------------- operations --

_LOG = """
WITH log AS (
  SELECT event_id AS request_id, make_timestamp(epoch_us(TIMESTAMP '2024-01-01 00:00:00')
      + CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 600) AS BIGINT))
      AS ts, CASE WHEN user_id % 4 <> 0 THEN '10.0.0.' || (user_id % 3) ELSE '127.0.0.1' END
      AS client, CASE WHEN event_type = 'purchase' THEN '/book'
        WHEN event_type IN ('click', 'signup') THEN '/search/nl'
        WHEN event_type = 'view' THEN '/search' ELSE '/health' END AS path, value AS duration_ms
  FROM events)"""


@question(
    "rate_limited",
    _LOG
    + """
  SELECT request_id, client, path FROM (SELECT *, row_number() OVER (PARTITION BY client, path,
      date_trunc('minute', ts) ORDER BY ts, request_id) AS n FROM log WHERE path <> '/health')
  WHERE n > CASE path WHEN '/book' THEN 10 WHEN '/search/nl' THEN 20 ELSE 120 END""",
)
def rate_limited(v):
    log = v.request_log.withColumn(
        "client", ops.client_key(F.col("forwarded"), F.col("peer"))
    )
    return ops.rate_limited(log).select("request_id", "client", "path")


@question(
    "latency_by_path",
    _LOG
    + """
  SELECT path, count(*) AS n_requests, round(avg(CAST(duration_ms > 100 AS DOUBLE)), 9)
      AS share_over_target, round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms
  FROM log GROUP BY 1""",
)
def latency_by_path(v):
    return ops.latency_by_path(v.request_log).withColumns(
        {"share_over_target": F.round("share_over_target", 9), "p95_ms": F.round("p95_ms", 6)}
    )


@question(
    "unknown_per_week",
    S.with_views(S.OBS)
    + """
  SELECT strftime(date_trunc('week', fetched_at), '%Y-%m-%d') AS week, carrier, count(*) AS n
  FROM obs WHERE event_type = 'view' AND event_id % 4 = 3 GROUP BY 1, 2""",
)
def unknown_per_week(v):
    """State changes as JSON log lines among other lines."""
    state = pick(["pending", "confirmed", "failed", "unknown"], F.col("event_id") % 4)
    line = F.to_json(
        F.struct(
            F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
            F.when(F.col("event_type") == "view", "booking.state_changed")
            .otherwise("http.request")
            .alias("event"),
            state.alias("state"),
            "carrier",
        )
    )
    out = ops.unknown_per_week(v.obs.select(line.alias("line")))
    return out.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@question(
    "error_messages",
    """
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Expired: offer ' || user_id || ' is gone'
    WHEN 1 THEN 'Expired: gone; ?: sold out ' || user_id WHEN 2 THEN 'Closed'
    WHEN 3 THEN '{"errors":[]}' WHEN 4 THEN 'gateway timeout ' || user_id
    ELSE 'no response body' END AS message
  FROM events""",
)
def error_messages(v):
    kind, u = F.col("event_id") % 6, F.col("user_id").cast("string")
    body = (
        F.when(
            kind == 0,
            F.concat(
                F.lit('{"errors":[{"title":"Expired","message":"offer '), u, F.lit(' is gone"}]}')
            ),
        )
        .when(
            kind == 1,
            F.concat(
                F.lit('{"errors":[{"title":"Expired","message":"gone"},{"message":"sold out '),
                u, F.lit('"}]}'),
            ),
        )
        .when(kind == 2, F.lit('{"errors":[{"title":"Closed","message":""}]}'))
        .when(kind == 3, F.lit('{"errors":[]}'))
        .when(kind == 4, F.concat(F.lit("gateway timeout "), u))
        .otherwise(F.lit(""))
    )
    return v.table("events").select("event_id", ops.error_message(body).alias("message"))
