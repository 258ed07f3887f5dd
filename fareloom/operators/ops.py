"""Request logs, rate limits and structured log questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.operators.joins import join_groups
from fareloom.operators.ordered import quantiles

# Requests allowed per minute, and the paths never limited.
LIMITS = {("POST", "/book"): 10, ("GET", "/search/nl"): 20}
DEFAULT_LIMIT = 120
EXEMPT = ["/health", "/docs", "/openapi.json", "/redoc"]
TARGET_MS = 100


def client_key(forwarded: Column, peer: Column) -> Column:
    """The first forwarded address, else the peer."""
    first = F.when(forwarded != "", F.trim(F.split(forwarded, ",")[0]))
    return F.coalesce(first, peer, F.lit("unknown"))


def allowance(method: Column, path: Column) -> Column:
    limit = F.lit(DEFAULT_LIMIT)
    for (m, p), n in LIMITS.items():
        limit = F.when((method == m) & (path == p), n).otherwise(limit)
    return limit


def rate_limited(
    requests: DataFrame, window: str = "1 minute", order: tuple[str, ...] = ("ts", "request_id")
) -> DataFrame:
    """The requests beyond their client's allowance in a fixed window.

    Only the largest allowance's worth of rows of each group is ranked, a cut
    Spark applies before the shuffle, so one client flooding one path never
    gathers in one task. Everything after the last allowed row is over.
    """
    counted = requests.filter(~F.col("path").isin(EXEMPT)).withColumn(
        "window_start", F.window("ts", window)["start"]
    ).withColumn("_limit", allowance(F.col("method"), F.col("path")))
    group = ["client", "path", "window_start", "_limit"]
    place = F.struct(*order)
    ranks = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    last_allowed = (
        counted.select(*group, *order)
        .withColumn("_n", ranks)
        .filter(F.col("_n") <= max(DEFAULT_LIMIT, *LIMITS.values()))
        .filter(F.col("_n") == F.col("_limit"))
        .select(*group, place.alias("_last_allowed"))
    )
    over = counted.join(last_allowed, group)
    return over.filter(place > F.col("_last_allowed")).select(
        *requests.columns, "window_start", F.col("_limit").alias("allowed")
    )


def latency_by_path(requests: DataFrame) -> DataFrame:
    """Requests, 95th percentile and share slower than the target, per path."""
    tail = quantiles(requests, "duration_ms", {"p95_ms": 0.95}, ("path",))
    share = requests.groupBy("path").agg(
        F.count("*").alias("n_requests"),
        F.avg((F.col("duration_ms") > TARGET_MS).cast("double")).alias("share_over_target"),
    )
    return join_groups(share, tail, ["path"])


def unknown_per_week(lines: DataFrame, body: str = "line") -> DataFrame:
    """Bookings that reached ``unknown``, by week and carrier, from JSON log lines."""
    event = F.from_json(
        body,
        "ts timestamp, event string, state string, carrier string, idempotency_key string",
    )
    hits = lines.select(event.alias("e")).select("e.*").filter(
        (F.col("event") == "booking.state_changed") & (F.col("state") == "unknown")
    )
    week = F.to_date(F.date_trunc("week", "ts"))
    return hits.groupBy(week.alias("week"), "carrier").agg(F.count("*").alias("n"))


def feed_volume(messages: DataFrame) -> DataFrame:
    return messages.groupBy("feed").agg(F.count("*").alias("n_messages"))


def error_message(body: Column) -> Column:
    """A carrier's error list as one line of at most 400 characters."""
    errors = F.from_json(
        F.get_json_object(body, "$.errors"), "array<struct<title: string, message: string>>"
    )
    parts = F.transform(
        errors,
        lambda e: F.regexp_replace(
            F.concat(
                F.coalesce(e["title"], F.lit("?")), F.lit(": "), F.coalesce(e["message"], F.lit(""))
            ),
            "^[: ]+|[: ]+$",
            "",
        ),
    )
    plain = F.when(F.length(body) > 0, F.substring(body, 1, 200))
    readable = F.json_object_keys(body).isNotNull()
    fallback = F.when(readable, "no error detail").otherwise("no response body")
    return F.when(
        readable & (F.size(errors) > 0), F.substring(F.array_join(parts, "; "), 1, 400)
    ).otherwise(F.coalesce(plain, fallback))
