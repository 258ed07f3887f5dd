"""Price history and latest state: what to keep of each observation.

Both reductions keep at most one row per key and map task, so a departure that
is redelivered or observed far more often than any other is reduced before it is
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["offer_id", "fetched_at"]


def newest(df: DataFrame, key: str | list[str], order: str | Column) -> DataFrame:
    """One row per key, the one with the greatest ``order``.

    Rows that tie on ``order`` are told apart by their whole content, so the
    answer does not depend on how the input was split. Each map task keeps one
    row per key before the shuffle.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.col(order) if isinstance(order, str) else order
    best_first = Window.partitionBy(*keys).orderBy(
        F.desc("_rank"), *[F.desc(c) for c in df.columns if c not in keys]
    )
    numbered = df.withColumn("_rank", rank).withColumn("_n", F.row_number().over(best_first))
    return numbered.filter(F.col("_n") == 1).select(*df.columns)


def latest_offers(offers: DataFrame, observed: str | Column = "fetched_at") -> DataFrame:
    """The current offer of each departure, by observation time and not by arrival."""
    return newest(offers, "offer_id", observed)


def merge_latest(current: DataFrame, arrivals: DataFrame, observed="fetched_at") -> DataFrame:
    """Latest state after some arrivals. An old replay cannot undo a newer price."""
    return latest_offers(current.unionByName(arrivals.select(current.columns)), observed)


def facts(observations: DataFrame) -> DataFrame:
    """One row per (offer, moment) with ``deliveries`` and ``conflicting``.

    Redelivery of the same fact collapses. Different facts under one key are
    flagged; the row shown is then the smallest, whatever the delivery order.
    """
    payload = [c for c in observations.columns if c not in KEY]
    row = F.struct(*payload)
    grouped = observations.groupBy(*KEY).agg(
        F.min(row).alias("_low"), F.max(row).alias("_high"), F.count("*").alias("deliveries")
    )
    return grouped.select(
        *KEY, "_low.*", "deliveries", (~F.col("_low").eqNullSafe(F.col("_high"))).alias(
            "conflicting")
    )


def split_conflicts(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history rows, keys quarantined because their deliveries disagree)."""
    merged = facts(observations)
    good = merged.filter(~F.col("conflicting")).select(*observations.columns)
    return good, merged.filter("conflicting")


def new_facts(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """The arrivals whose (offer, moment) the history does not hold, once each.

    Where deliveries of one key disagree, the one ``facts`` shows is kept;
    ``split_conflicts`` lists such keys.
    """
    fresh = facts(arrivals).select(*arrivals.columns)
    return fresh.join(history.select(*KEY), KEY, "left_anti")


def totals(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("offer_id").alias("n_departures"),
        F.count_distinct("fetched_at").alias("n_moments"),
    )


def profile(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("offer_id").alias("n_departures"),
        F.min("fetched_at").alias("first_fetch"),
        F.max("fetched_at").alias("last_fetch"),
        F.count_distinct("carrier").alias("n_carriers"),
        F.count_distinct("origin").alias("n_origins"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def feed_freshness(latest: DataFrame, now: Column, stale_after: int = 900) -> DataFrame:
    """Per carrier: newest observation, its age, and whether the whole feed is stale."""
    age = (F.unix_micros(now) - F.unix_micros("newest")) / F.lit(1e6)
    per_carrier = latest.groupBy("carrier").agg(
        F.max("fetched_at").alias("newest"), F.count("*").alias("n_offers")
    )
    return per_carrier.withColumn("age_seconds", F.bround(age, 1)).withColumn(
        "stale", age > stale_after
    )
