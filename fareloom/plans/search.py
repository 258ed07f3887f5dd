"""Tables of searches, text queries and offer ids answered against the latest offers.

A search is fully described by route, date and limit, and a limit is at most
50. So instead of pairing every search with every offer of its route, the best
50 offers of each (route, date) are kept on a *board*, and a search picks its
rows from there. The work is one pass over the offers plus the size of the
answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import times
from fareloom.operators import contract, intents
from fareloom.operators.ranking import (
    DEFAULT_LIMIT, MAX_LIMIT, STALE_AFTER_SECONDS, annotate, cut, top_lists, upcoming,
)
from fareloom.sources.registry import known_place, supported_route

ANY_DATE = "any"
DATE = r"^\d{4}-\d{2}-\d{2}$"
ROUTE_DATE = ["origin", "destination", "board_date"]


def on_sale(latest: DataFrame, now: Column, stale_after: int = STALE_AFTER_SECONDS) -> DataFrame:
    """Upcoming offers, annotated, with their local departure date."""
    return annotate(upcoming(latest, now), now, stale_after).withColumn(
        "board_date", times.local_date(F.col("depart_time"))
    )


def board(sale: DataFrame, limit: int = MAX_LIMIT) -> DataFrame:
    """Both lists per route and date, and per route over all dates.

    The all-dates lists are cut from the per-date lists, so they cost nothing
    like a second pass over the offers.
    """
    per_date = top_lists(sale, ROUTE_DATE, limit)
    overall = per_date.drop("rank").withColumn("board_date", F.lit(ANY_DATE))
    return per_date.unionByName(cut(overall, ["kind", *ROUTE_DATE], limit)).drop("_k1", "_k2")


def availability(sale: DataFrame) -> DataFrame:
    """Offers and stale offers per route and date, and over all dates."""
    per_date = sale.groupBy(*ROUTE_DATE).agg(
        F.count("*").alias("count"), F.count_if("stale").alias("stale_count")
    )
    overall = (
        per_date.groupBy("origin", "destination")
        .agg(F.sum("count").alias("count"), F.sum("stale_count").alias("stale_count"))
        .withColumn("board_date", F.lit(ANY_DATE))
    )
    return per_date.unionByName(overall)


def checked(requests: DataFrame) -> DataFrame:
    """Requests with a ``status``.

    ``invalid_request`` (a code that is not three letters long, a date that is
    none, a limit outside 1 to 50), ``unknown_place``, ``out_of_scope`` or ``ok``.
    """
    origin, dest = F.upper("origin"), F.upper("destination")
    limit = F.coalesce(F.col("limit"), F.lit(DEFAULT_LIMIT))
    date = F.col("date").cast("string")
    well_formed = (
        (F.length(origin) == 3)
        & (F.length(dest) == 3)
        & limit.between(1, MAX_LIMIT)
        & (date.isNull() | (date.rlike(DATE) & date.try_cast("date").isNotNull()))
    )
    status = (
        F.when(~F.coalesce(well_formed, F.lit(False)), "invalid_request")
        .when(~(known_place(origin) & known_place(dest)), "unknown_place")
        .when(~supported_route(origin, dest), "out_of_scope")
        .otherwise("ok")
    )
    return requests.withColumns(
        {
            "origin": origin,
            "destination": dest,
            "status": status,
            "limit": limit,
            "board_date": F.coalesce(date, F.lit(ANY_DATE)),
        }
    )


def search_lists(
    requests: DataFrame, latest: DataFrame, now: Column, stale_after: int = STALE_AFTER_SECONDS
) -> DataFrame:
    """The ranked rows of every search: (request_id, kind, rank, offer...)."""
    sale = on_sale(latest, now, stale_after)
    asked = checked(requests).filter("status = 'ok'").select(
        "request_id", "limit", *ROUTE_DATE
    )
    return (
        asked.join(board(sale), ROUTE_DATE)
        .filter(F.col("rank") <= F.col("limit"))
        .drop("limit", "board_date")
    )


def search_envelope(
    requests: DataFrame, latest: DataFrame, now: Column, stale_after: int = STALE_AFTER_SECONDS
) -> DataFrame:
    """One row per search: status, count before the limit, and staleness."""
    counts = availability(on_sale(latest, now, stale_after))
    zero = F.lit(0).cast("bigint")
    found = checked(requests).join(counts, ROUTE_DATE, "left")
    is_ok = F.col("status") == "ok"
    return found.select(
        "request_id", "origin", "destination", "date", "status",
        F.when(is_ok, F.coalesce("count", zero)).alias("count"),
        F.when(is_ok, F.coalesce("stale_count", zero)).alias("stale_count"),
        F.when(
            is_ok,
            F.coalesce((F.col("count") > 0) & (F.col("stale_count") == F.col("count")),
                       F.lit(False)),
        ).alias("stale"),
        times.render_utc(now).alias("searched_at"),
    )


def search_text(
    texts: DataFrame,
    latest: DataFrame,
    now: Column,
    limit: int = DEFAULT_LIMIT,
    stale_after: int = STALE_AFTER_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """(what was understood, with its envelope; the ranked rows) per text query."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be 1 to {MAX_LIMIT}")
    understood = intents.parse(texts)
    requests = (
        understood.filter(F.size("problems") == 0)
        .select(
            F.col("query_id").alias("request_id"), "origin", "destination", "date",
            F.lit(limit).alias("limit"),
        )
    )
    envelope = search_envelope(requests, latest, now, stale_after).select(
        F.col("request_id").alias("query_id"), "status", "count", "stale_count", "stale"
    )
    answer = understood.join(envelope, "query_id", "left").withColumn(
        "status", F.coalesce("status", F.lit("not_understood"))
    )
    return answer, search_lists(requests, latest, now, stale_after)


def offer_detail(
    ids: DataFrame, latest: DataFrame, now: Column, stale_after: int = STALE_AFTER_SECONDS
) -> DataFrame:
    """Each asked id with its offer, annotations and contract verdict."""
    asked = ids.select("offer_id").distinct()
    found = latest.join(asked, "offer_id", "left_semi")
    rows = contract.check_offers(annotate(found, now, stale_after))
    return asked.join(rows, "offer_id", "left").withColumn(
        "status", F.when(F.col("carrier").isNull(), "not_found").otherwise("ok")
    )


def with_predictions(offers: DataFrame, predictions: DataFrame) -> DataFrame:
    """Offers with their prediction, if any; none is lost for want of one."""
    return offers.join(
        predictions.select("offer_id", "will_rise", "probability"), "offer_id", "left"
    )


def live_count(latest: DataFrame, now: Column) -> DataFrame:
    return latest.agg(F.count("*").alias("offers_cached")).withColumn(
        "offers_counted_at", times.render_utc(now)
    )
