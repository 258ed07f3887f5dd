"""The ledger as a stored table, and whole outcomes of booking requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.operators import bookings, ledger
from fareloom.plans import view_sql as S
from fareloom.plans.registry import question
from fareloom.plans.views import pick
from fareloom.session import new_path

_MIDWAY = "2024-01-15 00:00:00"
_VALUES = ["pending", "confirmed", "failed", "unknown", "refunded"]

_CHANGES_SQL = f"""
claimed AS (
  SELECT k.idempotency_key, k.offer_id, l.carrier, k.quoted_price_ngn, k.requested_at
  FROM keyed k JOIN latest_obs l USING (offer_id)
  QUALIFY row_number() OVER (PARTITION BY k.idempotency_key
    ORDER BY k.requested_at, k.request_id) = 1),
booked AS (
  SELECT idempotency_key, offer_id, carrier, state, provider_reference, last_error, created_at
  FROM ledger
  UNION ALL SELECT idempotency_key, offer_id, carrier, 'pending', NULL, NULL, requested_at
  FROM claimed WHERE idempotency_key NOT IN (SELECT idempotency_key FROM ledger)),
changed AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'given-key-' || (user_id % 80)
      ELSE 'k-' || (event_id // 2) END AS idempotency_key, fetched_at AS moved, event_id,
    CASE event_type WHEN 'view' THEN 'state' WHEN 'click' THEN 'offer_id'
      WHEN 'signup' THEN 'attempts' ELSE 'last_error' END AS column_name,
    CASE event_type WHEN 'signup' THEN CAST(event_id % 5 AS VARCHAR)
      ELSE {S.pick(_VALUES, 'event_id % 5')} END AS new_value
  FROM obs),
folded AS (
  SELECT idempotency_key, max(moved) AS moved,
    arg_max(new_value, {{'a': moved, 'e': event_id}}) FILTER (column_name = 'state') AS state,
    arg_max(new_value, {{'a': moved, 'e': event_id}}) FILTER (column_name = 'attempts') AS attempts,
    arg_max(new_value, {{'a': moved, 'e': event_id}}) FILTER (column_name = 'last_error') AS last_error
  FROM changed JOIN booked b USING (idempotency_key)
  WHERE moved >= b.created_at AND column_name <> 'offer_id'
    AND NOT (column_name = 'state' AND new_value = 'refunded')
  GROUP BY 1)"""

_BOOKINGS = S.with_views(S.OBS, S.LATEST_OBS, S.BOOKING_REQUESTS, S.LEDGER, _CHANGES_SQL)
_AFTER = """
  SELECT b.idempotency_key, b.offer_id, b.carrier, coalesce(f.state, b.state) AS state,
    coalesce(CAST(f.attempts AS INTEGER), 0) AS attempts,
    coalesce(f.last_error, b.last_error) AS last_error, b.provider_reference,
    epoch_us(b.created_at) AS created_us, epoch_us(coalesce(f.moved, b.created_at)) AS updated_us
  FROM booked b LEFT JOIN folded f USING (idempotency_key)"""


def _claims(v):
    offers = v.latest_obs.select("offer_id", "carrier")
    return bookings.with_key(v.booking_requests).join(offers, "offer_id")


def _changes(v):
    """Every event as a change of some booking; a third of them may not be made."""
    e, kind = F.col("event_id"), F.col("event_type")
    return v.obs.select(
        F.when(e % 3 == 0, F.concat(F.lit("given-key-"), (F.col("user_id") % 80).cast("string")))
        .otherwise(F.concat(F.lit("k-"), F.floor(e / 2).cast("string")))
        .alias("idempotency_key"),
        F.col("fetched_at").alias("at"),
        e.alias("number"),
        F.when(kind == "view", "state")
        .when(kind == "click", "offer_id")
        .when(kind == "signup", "attempts")
        .otherwise("last_error")
        .alias("column_name"),
        F.when(kind == "signup", (e % 5).cast("string")).otherwise(pick(_VALUES, e % 5)).alias("new_value"),
    )


def _after(v):
    """The stored ledger after all claims and changes, in two deliveries, the second twice."""
    path = new_path(v.spark, "ledger")
    ledger.write_ledger(v.ledger, path, buckets=8)
    claims, changes = _claims(v), _changes(v)
    early = F.col("at") < v.at(_MIDWAY)
    for part in (early, ~early, ~early):
        ledger.bring_up_to_date(v.spark, path, claims, changes.filter(part), buckets=8)
    return ledger.read_ledger(v.spark, path)


@question("ledger_after", _BOOKINGS + _AFTER)
def ledger_after(v):
    return _after(v).select(
        "idempotency_key", "offer_id", "carrier", "state", "attempts", "last_error",
        "provider_reference", F.unix_micros("created_at").alias("created_us"),
        F.unix_micros("updated_at").alias("updated_us"),
    )


@question(
    "ledger_oldest_first",
    S.with_views(S.OBS, S.LEDGER)
    + """
  SELECT idempotency_key, offer_id, state, epoch_us(created_at) AS created_us,
    CAST(row_number() OVER (PARTITION BY offer_id ORDER BY created_at, idempotency_key) AS INTEGER)
      AS place
  FROM ledger""",
)
def ledger_oldest_first(v):
    """The bookings of every offer in the order they were made."""
    return ledger.oldest_first(v.ledger, v.obs).select(
        "idempotency_key", "offer_id", "state", F.unix_micros("created_at").alias("created_us"),
        "place",
    )


@question(
    "ledger_refused",
    _BOOKINGS
    + """
  SELECT event_id AS number, concat_ws('|',
      CASE WHEN column_name = 'offer_id' THEN 'not_updatable' END,
      CASE WHEN column_name = 'state' AND new_value = 'refunded' THEN 'invalid_state' END,
      CASE WHEN b.idempotency_key IS NULL THEN 'no_booking' END) AS problems
  FROM changed LEFT JOIN booked b USING (idempotency_key)
  WHERE column_name = 'offer_id' OR (column_name = 'state' AND new_value = 'refunded')
    OR b.idempotency_key IS NULL""",
)
def ledger_refused(v):
    """Changes that may not be made: of a fixed column, to no legal state, of no booking."""
    changes = _changes(v)
    booked = ledger.ledger_after(v.ledger, _claims(v), changes.limit(0))
    return ledger.refused(booked, changes).select(
        "number", F.array_join("problems", "|").alias("problems")
    )


_LINK = f"""booking_url || '&from=' || origin || '&to=' || destination || '&date='
      || substr({S.local_text('depart_time', 'origin')}, 1, 10) || '&depart='
      || substr({S.local_text('depart_time', 'origin')}, 12, 2) || '%3A'
      || substr({S.local_text('depart_time', 'origin')}, 15, 2) || '&passengers=1&class=economy'"""


@question(
    "booking_outcomes",
    S.with_views(S.OBS, S.LATEST_OBS, S.BOOKING_REQUESTS, S.LEDGER)
    + f"""
  SELECT request_id, idempotency_key, is_new, state,
    CASE WHEN is_new AND state = 'failed' THEN 'The fare has risen '
      || printf('%.1f', (price_ngn - quoted_price_ngn) / quoted_price_ngn * 100)
      || '% since you saw it - from NGN ' || format('{{:,}}', CAST(quoted_price_ngn AS BIGINT))
      || ' to NGN ' || format('{{:,}}', CAST(price_ngn AS BIGINT))
      || '. Nothing was booked. Search again to accept the new price.' END AS told,
    CASE WHEN is_new AND state = 'pending' THEN CASE mode WHEN 'air' THEN 'carrier_api'
      ELSE 'deeplink' END END AS provider,
    CASE WHEN is_new AND state = 'pending' AND mode <> 'air' THEN link END AS handoff_url
  FROM (SELECT *, CASE WHEN held_state IS NOT NULL THEN held_state WHEN first_moved THEN 'failed'
      ELSE 'pending' END AS state
    FROM (SELECT k.request_id, k.idempotency_key, k.quoted_price_ngn, l.price_ngn, l.mode,
        {_LINK.replace("booking_url", "l.booking_url")} AS link, g.state AS held_state,
        g.state IS NULL AND row_number() OVER w = 1 AS is_new,
        first_value(l.price_ngn > k.quoted_price_ngn * 1.01::DOUBLE) OVER w AS first_moved
      FROM keyed k JOIN latest_obs l USING (offer_id) LEFT JOIN ledger g USING (idempotency_key)
      WINDOW w AS (PARTITION BY k.idempotency_key ORDER BY k.requested_at, k.request_id)))
  UNION ALL SELECT request_id, NULL, false, 'no_offer', NULL, NULL, NULL FROM breq
  WHERE offer_id NOT IN (SELECT offer_id FROM latest_obs)""",
)
def booking_outcomes(v):
    """What every caller is told: of a rise by how much, else who books and where to go on."""
    latest = v.as_text(v.latest_obs)
    out = ledger.outcomes(v.booking_requests, latest, v.ledger, api_enabled=True)
    return out.select(
        "request_id", "idempotency_key", "is_new", "state",
        F.when(F.col("is_new"), F.col("detail")).alias("told"), "provider", "handoff_url",
    )
