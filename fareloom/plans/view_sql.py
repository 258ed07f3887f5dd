"""The SQL twins of ``views``: common table expressions over the driver tables."""

from __future__ import annotations

from fareloom.plans.views import (
    FAR_ENDS, KEYS, LISTING_NOW, OBS_NOW, TEXT_PLACES, TEXT_SHAPES,
)
from fareloom.sources.registry import CARRIERS, PLACES, ROUTES

OBS_AT = f"TIMESTAMP '{OBS_NOW}'"
LISTING_AT = f"TIMESTAMP '{LISTING_NOW}'"
ROUTE_LIST = ", ".join(f"'{a}-{b}', '{b}-{a}'" for a, b in ROUTES)
PLACE_LIST = ", ".join(f"'{p[0]}'" for p in PLACES)


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({_list(values)})[CAST({index} AS INTEGER) + 1]"


def _far(carrier: str, spread: str) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {pick(ends, f'({spread}) % {len(ends)}')}"
        for i, ends in enumerate(FAR_ENDS)
    )
    return f"CASE {carrier} {arms} END"


def ground(code: str) -> str:
    arms = " ".join(f"WHEN '{p[0]}' THEN {p[6]}" for p in PLACES)
    return f"CASE {code} {arms} END"


def _last_sunday(ts: str, month: int) -> str:
    end = f"make_date(year({ts}), {month}, 31)"
    last = f"CAST({end} AS TIMESTAMP) - to_days(CAST(dayofweek({end}) AS INTEGER))"
    if month == 10:  # in 1995 the clocks went back a week early
        last = f"CASE WHEN year({ts}) = 1995 THEN TIMESTAMP '1995-10-22' ELSE {last} END"
    return f"({last} + to_hours(1))"


def offset_hours(ts: str, place: str) -> str:
    """UTC offset at a place: Lagos is always +1, London +1 in summer."""
    summer = f"{ts} >= {_last_sunday(ts, 3)} AND {ts} < {_last_sunday(ts, 10)}"
    return f"(CASE WHEN {place} = 'LHR' THEN (CASE WHEN {summer} THEN 1 ELSE 0 END) ELSE 1 END)"


def local_text(ts: str, place: str, zero: str = "+00:00") -> str:
    off = offset_hours(ts, place)
    shown = f"strftime({ts} + to_hours(CAST({off} AS INTEGER)), '%Y-%m-%dT%H:%M:%S')"
    return f"({shown} || CASE WHEN {off} = 0 THEN '{zero}' ELSE '+01:00' END)"


def utc_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def id_of(key: str, mode: str, origin: str, dest: str, ts: str) -> str:
    return (
        f"({key} || '-' || {mode} || '-' || {origin} || '-' || {dest} || '-' || "
        f"strftime({ts}, '%Y%m%dT%H%MZ'))"
    )


_NAMES = [c[1] for c in CARRIERS]
_MODES = [c[2] for c in CARRIERS]

OBS = f"""
obs0 AS (
  SELECT event_id, user_id, event_type, {pick(KEYS, 'user_id % 8')} AS carrier_key,
    {pick(_NAMES, 'user_id % 8')} AS carrier, {pick(_MODES, 'user_id % 8')} AS mode,
    {_far('user_id % 8', 'user_id // 8')} AS far, (user_id // 48) % 2 = 0 AS outbound,
    TIMESTAMP '2024-01-10 00:00:00' + to_seconds(
      (user_id % 100) * 86400 + (user_id * 7 % 24) * 3600 + (user_id % 4) * 900) AS depart_time,
    CAST(round(value * 100) AS DOUBLE) + 100 AS price_ngn,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS seats_left,
    ts AS fetched_at, value
  FROM events),
obs1 AS (
  SELECT *, CASE WHEN outbound THEN 'LOS' ELSE far END AS origin,
    CASE WHEN outbound THEN far ELSE 'LOS' END AS destination,
    CAST(CASE WHEN mode = 'road' THEN 300 + (user_id % 30) * 6
      ELSE 60 + (user_id % 4) * 15 END AS INTEGER) AS duration_min
  FROM obs0),
obs AS (
  SELECT *, 'https://' || carrier_key || '.example/book?o=' || origin || '&d=' || destination
      AS booking_url,
    {id_of('carrier_key', 'mode', 'origin', 'destination', 'depart_time')} AS offer_id
  FROM obs1)"""

LISTING = f"""
lst0 AS (
  SELECT {pick(KEYS, 's_nationkey % 8')} AS carrier_key, {pick(_NAMES, 's_nationkey % 8')}
      AS carrier, {pick(_MODES, 's_nationkey % 8')} AS mode,
    {_far('s_nationkey % 8', 'l_partkey')} AS far, l_suppkey % 2 = 0 AS outbound,
    CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS depart_at,
    CAST(o_orderdate AS TIMESTAMP) + to_minutes(l_orderkey % 1440) AS seen_at,
    l_partkey, l_extendedprice AS price_ngn, CAST(l_quantity AS INTEGER) AS seats_left
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
lst1 AS (
  SELECT *, CASE WHEN outbound THEN 'LOS' ELSE far END AS origin,
    CASE WHEN outbound THEN far ELSE 'LOS' END AS destination,
    CAST(CASE WHEN mode = 'road' THEN 300 + l_partkey % 420 ELSE 55 + l_partkey % 90 END
      AS INTEGER) AS duration_min
  FROM lst0 WHERE seen_at <= {LISTING_AT}),
listing AS (
  SELECT {id_of('carrier_key', 'mode', 'origin', 'destination', 'depart_at')} AS offer_id,
    carrier, mode, origin, destination, {local_text('depart_at', 'origin')} AS depart_time,
    duration_min, price_ngn, seats_left,
    'https://' || carrier_key || '.example/book?o=' || origin || '&d=' || destination
      AS booking_url,
    {utc_text('seen_at')} AS fetched_at, depart_at, seen_at
  FROM lst1),
latest AS (
  SELECT * FROM listing QUALIFY row_number() OVER (PARTITION BY offer_id
    ORDER BY seen_at DESC, duration_min DESC, price_ngn DESC, seats_left DESC) = 1)"""

LATEST_OBS = """
latest_obs AS (
  SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY offer_id
    ORDER BY fetched_at DESC) = 1)"""

# What search adds to an offer; the stale limit is the demo's 90 days.
DOOR = (
    f"CAST(CASE WHEN mode = 'road' THEN duration_min ELSE duration_min + {ground('origin')} "
    f"+ {ground('destination')} END AS INTEGER)"
)
SALE = f"""
sale AS (
  SELECT *, {DOOR} AS door_to_door_min,
    CAST(epoch_us({LISTING_AT}) - epoch_us(seen_at) AS DOUBLE) / 1000000 AS age_seconds,
    epoch_us({LISTING_AT}) - epoch_us(seen_at) > 90 * 86400 * 1000000::BIGINT AS stale,
    substr(depart_time, 1, 10) AS board_date
  FROM latest WHERE depart_at > {LISTING_AT})"""

_ENDS = ["LOS", "ABV", "LOS", "ONI", "LOS", "PHC", "LOS", "LHR", "ABV", "LOS"]
_BACK = ["ABV", "LOS", "ONI", "LOS", "PHC", "LOS", "LHR", "LOS", "PHC", "XXX"]
REQUESTS = f"""
requests AS (
  SELECT c_custkey AS request_id, {pick(_ENDS, 'c_custkey % 10')} AS origin,
    {pick(_BACK, 'c_custkey % 10')} AS destination,
    CASE WHEN (c_custkey // 10) % 5 <> 0 THEN strftime(DATE '1998-09-01'
      + CAST((c_custkey // 10) % 90 AS INTEGER), '%Y-%m-%d') END AS date,
    CASE WHEN c_custkey % 7 <> 0 THEN CAST(1 + c_custkey % 20 AS INTEGER) ELSE 10 END AS lim
  FROM customer),
checked AS (
  SELECT *, CASE WHEN origin NOT IN ({PLACE_LIST}) OR destination NOT IN ({PLACE_LIST})
      THEN 'unknown_place'
    WHEN origin || '-' || destination NOT IN ({ROUTE_LIST}) THEN 'out_of_scope'
    ELSE 'ok' END AS status
  FROM requests)"""

TEXTS = f"""
texts AS (
  SELECT c_custkey AS query_id, c_custkey % {len(TEXT_SHAPES)} AS shape,
    {pick(TEXT_PLACES, f'(c_custkey // 15) % {len(TEXT_PLACES)}')} AS p,
    {pick(TEXT_PLACES, f'(c_custkey // 90) % {len(TEXT_PLACES)}')} AS q,
    DATE '1998-09-01' + CAST(c_custkey % 11 AS INTEGER) AS today
  FROM customer),
coded AS (
  SELECT *, CASE p WHEN 'Abuja' THEN 'ABV' WHEN 'port harcourt' THEN 'PHC'
      WHEN 'ONITSHA' THEN 'ONI' WHEN 'London' THEN 'LHR' WHEN 'Lagos' THEN 'LOS' END AS pc,
    CASE q WHEN 'Abuja' THEN 'ABV' WHEN 'port harcourt' THEN 'PHC'
      WHEN 'ONITSHA' THEN 'ONI' WHEN 'London' THEN 'LHR' WHEN 'Lagos' THEN 'LOS' END AS qc
  FROM texts)"""

BOOKING_REQUESTS = """
breq AS (
  SELECT event_id AS request_id, fetched_at AS requested_at,
    CASE WHEN event_id % 29 = 0 THEN 'gone-' || offer_id ELSE offer_id END AS offer_id,
    CAST(floor(price_ngn / 20000) * 20000 + 5000 AS DOUBLE) AS quoted_price_ngn,
    CASE WHEN event_id % 2 = 0 THEN ' Pat' || user_id || '@Example.COM '
      ELSE 'pat' || user_id || '@example.com' END AS email,
    CASE WHEN event_id % 7 = 0 THEN 'given-key-' || (user_id % 80) END AS given_key
  FROM obs WHERE event_type IN ('purchase', 'signup')),
keyed AS (
  SELECT *, coalesce(given_key, 'auto-v1-' || substr(sha256(offer_id || '|'
    || lower(trim(email)) || '|' || printf('%.2f', quoted_price_ngn)), 1, 16)) AS idempotency_key
  FROM breq)"""

LEDGER = """
ledger AS (
  SELECT CASE WHEN event_id % 5 = 0 AND user_id % 80 < 40 THEN 'given-key-' || (user_id % 80)
      ELSE 'k-' || event_id END AS idempotency_key, offer_id, carrier,
    (['pending', 'confirmed', 'failed', 'unknown'])[CAST(event_id % 4 AS INTEGER) + 1] AS state,
    CASE WHEN event_id % 4 = 1 THEN 'REF' || event_id END AS provider_reference,
    CASE WHEN event_id % 4 = 2 THEN 'rejected: sold out' END AS last_error,
    fetched_at AS created_at, event_id
  FROM obs WHERE event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY CASE WHEN event_id % 5 = 0
    AND user_id % 80 < 40 THEN 'given-key-' || (user_id % 80) ELSE 'k-' || event_id END
    ORDER BY fetched_at DESC) = 1)"""

PROBABILITY = "(CAST(event_id * 7919 % 10001 AS DOUBLE) / 10000)"
PREDICTIONS = f"""
predictions AS (
  SELECT offer_id, fetched_at + to_seconds(420) AS predicted_at, {PROBABILITY} >= 0.5 AS will_rise,
    {PROBABILITY} AS probability, price_ngn AS price_at_prediction
  FROM obs),
outcomes AS (
  SELECT p.*, o.price_ngn AS later_price, o.fetched_at AS scored_at
  FROM predictions p LEFT JOIN LATERAL (
    SELECT price_ngn, fetched_at FROM obs WHERE obs.offer_id = p.offer_id
      AND obs.fetched_at >= p.predicted_at + to_hours(24)
      AND obs.fetched_at <= p.predicted_at + to_hours(36)
    ORDER BY fetched_at LIMIT 1) o ON true),
resolved AS (
  SELECT *, later_price > price_at_prediction AS actual_rose FROM outcomes)"""

SCORED = f"""
scored AS (
  SELECT {PROBABILITY} AS probability,
    CAST(price_ngn + {PROBABILITY} * 8000 > 8000 AS INTEGER) AS label
  FROM obs)"""


def _frame(low: int, high: int) -> str:
    return (
        "OVER (PARTITION BY offer_id ORDER BY epoch_us(fetched_at) RANGE BETWEEN "
        f"{_edge(low)} AND {_edge(high)})"
    )


def _edge(us: int) -> str:
    return f"{abs(us)} PRECEDING" if us < 0 else f"{us} FOLLOWING"


H = 3600 * 1_000_000


def _nearest(hours: int) -> str:
    """Both neighbours of t - hours, as (price, distance) pairs."""
    lag, reach = hours * H, hours * H // 2
    back, ahead = _frame(-lag - reach, -lag), _frame(-lag, -lag + reach)
    return f"""
    last(price_ngn) {back} AS bp{hours}, last(epoch_us(fetched_at)) {back} AS bt{hours},
    first(price_ngn) {ahead} AS fp{hours}, first(epoch_us(fetched_at)) {ahead} AS ft{hours}"""


def _delta(hours: int) -> str:
    target = f"(epoch_us(fetched_at) - {hours * H})"
    past = (
        f"CASE WHEN ft{hours} IS NOT NULL AND (bt{hours} IS NULL OR ft{hours} - {target} < "
        f"{target} - bt{hours}) THEN fp{hours} ELSE bp{hours} END"
    )
    return f"coalesce((price_ngn - {past}) / {past}, 0.0)"


FEATURES = f"""
framed AS (
  SELECT *, {_nearest(6)}, {_nearest(12)}, {_nearest(24)},
    first(price_ngn) {_frame(24 * H, 36 * H)} AS future_price
  FROM obs),
deltas AS (
  SELECT *, {_delta(6)} AS price_delta_6h, {_delta(12)} AS price_delta_12h,
    {_delta(24)} AS price_delta_24h
  FROM framed),
features AS (
  SELECT *, CAST(epoch_us(depart_time) - epoch_us(fetched_at) AS DOUBLE) / 86400000000
      AS days_to_departure,
    CAST(hour(depart_time + to_hours(1)) AS INTEGER) AS hour_of_day,
    CAST(isodow(depart_time + to_hours(1)) - 1 AS INTEGER) AS day_of_week,
    origin || '-' || destination AS route,
    CAST(future_price > price_ngn AS INTEGER) AS will_rise
  FROM deltas WHERE future_price IS NOT NULL)"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)
