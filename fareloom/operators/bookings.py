"""Bookings as data: keys, claims, price checks, attempts, reconciliation.

What a request handler does one call at a time is a set operation here. A key
that is hammered (a retry storm) is reduced by aggregates before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.identity import idempotency_key
from fareloom.functions.urls import deep_link

# The price tolerance in percent and the retry limit.
TOLERANCE_PCT = 1.0
MAX_ATTEMPTS = 3

# Fixed value: stored in the ledger as it is.
RECONCILED_ABSENT = "reconciled: no order carrying this key exists at the carrier"


def with_key(requests: DataFrame) -> DataFrame:
    """Requests with an idempotency key, derived where the caller gave none."""
    derived = idempotency_key(F.col("offer_id"), F.col("email"), F.col("quoted_price_ngn"))
    return requests.withColumn(
        "idempotency_key", F.coalesce(F.col("idempotency_key"), derived)
    )


def claims(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each request with ``is_new`` and, for a replay, the state it replays.

    Exactly one request wins a key that the ledger does not hold: the earliest,
    by request id among equals. The others replay that claim, or the ledger row.
    """
    keyed = with_key(requests)
    first = keyed.groupBy("idempotency_key").agg(
        F.min(F.struct("requested_at", "request_id")).alias("_first")
    )
    held = ledger.select(
        "idempotency_key",
        F.lit(True).alias("_held"),
        F.col("state").alias("_state"),
        F.col("provider_reference").alias("_reference"),
        F.col("last_error").alias("_error"),
    )
    known = first.join(held, "idempotency_key", "left")
    me = F.struct("requested_at", "request_id")
    is_new = F.col("_held").isNull() & (me == F.col("_first"))
    return (
        keyed.join(known, "idempotency_key")
        .withColumn("is_new", is_new)
        .withColumn("replayed", ~is_new)
        .withColumn(
            "state", F.when(is_new, "pending").otherwise(F.coalesce("_state", F.lit("pending")))
        )
        .withColumn(
            "detail",
            F.when(
                ~is_new, replay_detail(F.col("state"), F.col("_reference"), F.col("_error"))
            ),
        )
        .select(*keyed.columns, "is_new", "replayed", "state", "detail")
    )


def replay_detail(state: Column, reference: Column, error: Column) -> Column:
    """What a repeated request is told, by the state of the booking it repeats."""
    return (
        F.when(state == "confirmed", F.concat(F.lit("already booked: "), reference))
        .when(state == "pending", F.lit("already started, waiting at the carrier's checkout"))
        .when(state == "failed", F.concat(F.lit("already failed, not retried: "), error))
        .when(state == "unknown", F.lit("outcome unknown, not retried, needs reconciling"))
    )


def price_guard(
    requests: DataFrame, latest: DataFrame, tolerance_pct: float = TOLERANCE_PCT
) -> DataFrame:
    """Requests against live prices: refuse a rise beyond the tolerance, never a fall."""
    live = latest.select("offer_id", F.col("price_ngn").cast("double").alias("live_price_ngn"))
    quoted, now = F.col("quoted_price_ngn"), F.col("live_price_ngn")
    moved = now > quoted * (1 + tolerance_pct / 100)
    whole = "%.0f"
    return (
        requests.join(live, "offer_id", "left")
        .withColumn(
            "status",
            F.when(now.isNull(), "no_offer").when(moved, "price_changed").otherwise("ok"),
        )
        .withColumn("rise_pct", F.round((now - quoted) / quoted * 100, 2))
        .withColumn(
            "last_error",
            F.when(
                moved,
                F.concat(
                    F.lit("price_changed: quoted "), F.format_string(whole, quoted),
                    F.lit(", now "), F.format_string(whole, now),
                ),
            ),
        )
    )


def book_requests(requests: DataFrame, latest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests resolved in one go: the offer exists, the claim, the price, the answer.

    A request for an offer that is not there takes no key (``state`` is no_offer). The
    winner of a key is ``failed`` if the price rose, else ``pending``; the others replay
    the winner, or the booking the ledger holds.
    """
    checked = price_guard(requests, latest)
    found = checked.filter("status <> 'no_offer'")
    claimed = claims(found, ledger)
    new_state = F.when(F.col("status") == "price_changed", "failed").otherwise("pending")
    winners = claimed.filter("is_new").select(
        "idempotency_key",
        new_state.alias("_state"),
        F.col("last_error").alias("_error"),
    )
    told = claimed.join(winners, "idempotency_key", "left")
    repeated = replay_detail(F.col("_state"), F.lit(None).cast("string"), F.col("_error"))
    booked = told.select(
        "request_id",
        "idempotency_key",
        "is_new",
        F.coalesce("_state", "state").alias("state"),
        F.when(F.col("is_new"), F.col("last_error"))
        .when(F.col("_state").isNotNull(), repeated)
        .otherwise(F.col("detail"))
        .alias("detail"),
    )
    gone = checked.filter("status = 'no_offer'").select(
        "request_id",
        F.lit(None).cast("string").alias("idempotency_key"),
        F.lit(False).alias("is_new"),
        F.lit("no_offer").alias("state"),
        F.lit(None).cast("string").alias("detail"),
    )
    return booked.unionByName(gone)


def booking_status(asked: DataFrame, ledger: DataFrame) -> DataFrame:
    """The booking behind each asked ``idempotency_key``; ``state`` is none if there is none."""
    keys = asked.select("idempotency_key").filter("idempotency_key is not null").distinct()
    held = ledger.select("idempotency_key", "offer_id", "state", "provider_reference")
    return keys.join(held, "idempotency_key", "left").withColumn(
        "state", F.coalesce("state", F.lit("none"))
    )


# ---------------------------------------------------------------- attempts --


def error_kind(outcome: Column, status: Column, read_only: Column) -> Column:
    """The kind of failure one call had; null when it succeeded.

    ``outcome`` is ok, unreadable, connect_error, timeout, transport_error or
    http (then ``status`` decides).
    """
    return (
        F.when(outcome == "ok", F.lit(None).cast("string"))
        .when(outcome == "unreadable", F.when(read_only, "unavailable").otherwise("timeout"))
        .when(outcome.isin("connect_error", "transport_error"), "unreachable")
        .when(outcome == "timeout", F.when(read_only, "unreachable").otherwise("timeout"))
        .when(status.isin(401, 403), "misconfigured")
        .when((status == 429) | (status >= 500), "unavailable")
        .when(status.between(200, 299), F.lit(None).cast("string"))
        .otherwise("rejected")
    )


def is_ambiguous(kind: Column) -> Column:
    """Might the carrier have booked anyway?"""
    return kind.isin("unavailable", "timeout")


def is_retryable(kind: Column) -> Column:
    """Is asking again safe?"""
    return kind.isin("unreachable", "unavailable")


def attempt_outcomes(
    attempts: DataFrame, success_state: str = "confirmed", max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Final state per key: an attempt log folded with one aggregate.

    The log counts up to the first success or non-retryable failure, and never
    past ``max_attempts``. The last counted failure decides.
    """
    kinds = attempts.filter(F.col("attempt").between(1, max_attempts)).withColumn(
        "_kind", error_kind(F.col("outcome"), F.col("status"), F.col("read_only"))
    )
    # One slot per allowed attempt, so the state per key has a fixed size.
    slots = kinds.groupBy("idempotency_key").agg(
        *[
            F.min(
                F.when(F.col("attempt") == i, F.coalesce("_kind", F.lit("success")))
            ).alias(f"_a{i}")
            for i in range(1, max_attempts + 1)
        ]
    )
    log = F.filter(F.array(*[F.col(f"_a{i}") for i in range(1, max_attempts + 1)]),
                   lambda k: k.isNotNull())
    stops = F.transform(log, lambda k, i: F.when(~is_retryable(k), i + 1))
    stop = F.coalesce(F.array_min(stops), F.size(log))
    counted = slots.withColumn("_log", log).withColumn("attempts", stop.cast("int")).withColumn(
        "_log", F.slice("_log", 1, F.col("attempts"))
    )
    last = F.element_at("_log", -1)
    return counted.select(
        "idempotency_key",
        "attempts",
        F.when(last == "success", F.lit(success_state))
        .when(is_ambiguous(last), "unknown")
        .otherwise("failed")
        .alias("state"),
        F.when(last != "success", last).alias("last_error"),
        F.exists("_log", is_ambiguous).alias("any_ambiguous"),
    )


def reconcile(ledger: DataFrame, orders: DataFrame) -> DataFrame:
    """Resolve ``unknown`` bookings against the carrier's own orders."""
    booked = orders.select(
        F.get_json_object("metadata", "$.idempotency_key").alias("idempotency_key"),
        F.coalesce("booking_reference", "id").alias("_reference"),
    ).filter(F.col("idempotency_key").isNotNull())
    found = booked.groupBy("idempotency_key").agg(F.min("_reference").alias("_reference"))
    unknown = ledger.filter("state = 'unknown'")
    hit = F.col("_reference").isNotNull()
    return unknown.join(found, "idempotency_key", "left").select(
        "idempotency_key",
        "offer_id",
        F.when(hit, "confirmed").otherwise("failed").alias("state"),
        F.col("_reference").alias("provider_reference"),
        F.when(~hit, RECONCILED_ABSENT).alias("last_error"),
    )


def counts_by_state(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("state").agg(F.count("*").alias("n"))


def for_offers(ledger: DataFrame, offers: DataFrame) -> DataFrame:
    """Ledger rows of the given departures; order by created_at to present them."""
    return ledger.join(offers.select("offer_id").distinct(), "offer_id", "left_semi")


# ----------------------------------------------------------------- routing --


def routing(offers: DataFrame, api_enabled: bool = False) -> DataFrame:
    """How each offer would be booked, and why."""
    air = F.col("mode") == "air"
    by_api = air & F.lit(api_enabled)
    return offers.select(
        "offer_id",
        "carrier",
        F.when(by_api, "carrier_api").otherwise("deeplink").alias("provider"),
        by_api.alias("books_via_api"),
        F.when(~air, "no booking API for road carriers")
        .when(~by_api, "the booking API is not enabled")
        .otherwise("held through the booking API, no payment")
        .alias("reason"),
    )


def with_deep_link(offers: DataFrame) -> DataFrame:
    return offers.withColumn(
        "deep_link",
        deep_link(
            F.col("booking_url"), F.col("origin"), F.col("destination"), F.col("depart_time")
        ),
    )


def pick_holdable(requests: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per request, the cheapest quote that can be held, same carrier first.

    One aggregate: the smallest (other carrier, amount, id). A missing flag
    counts as instant payment, a missing amount as the dearest.
    """
    holdable = ~F.coalesce(F.col("requires_instant_payment"), F.lit(True))
    asked = requests.select("request_id", F.lower("carrier").alias("_wanted"))
    amount = F.col("total_amount").try_cast("double")
    offered = quotes.join(asked, "request_id").withColumn(
        "_other",
        ~F.coalesce(
            (F.col("_wanted") != "") & F.contains(F.lower("owner_name"), F.col("_wanted")),
            F.lit(False),
        ),
    )
    preferred = F.struct(
        F.col("_other").alias("other"),
        F.coalesce(amount, F.lit(float("inf"))).alias("amount"),
        F.col("quote_id").alias("quote_id"),
    )
    best = offered.groupBy("request_id").agg(
        F.min(F.when(holdable, preferred)).alias("_best"), F.count("*").alias("_n")
    )
    return requests.join(best, "request_id", "left").select(
        *requests.columns,
        F.col("_best.quote_id").alias("quote_id"),
        (~F.col("_best.other")).alias("same_carrier"),
        F.when(F.col("_n").isNull(), "no_quotes")
        .when(F.col("_best").isNull(), "instant_payment_only")
        .otherwise("ok")
        .alias("status"),
    )
