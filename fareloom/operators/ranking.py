"""Door-to-door time, staleness, and the cheapest and fastest orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions import money, times
from fareloom.sources.registry import ground_minutes

STALE_AFTER_SECONDS = 900
MAX_LIMIT = 50
DEFAULT_LIMIT = 10

# The order of each list; the last columns only settle full ties.
ORDERS = {
    "cheapest": ["price_ngn", "door_to_door_min", "carrier", "offer_id"],
    "fastest": ["door_to_door_min", "price_ngn", "carrier", "offer_id"],
}


def door_to_door(
    mode: Column, origin: Column, destination: Column, duration: Column
) -> Column:
    """Scheduled minutes, plus the ground time at both ends unless by road."""
    ground = ground_minutes(origin) + ground_minutes(destination)
    return F.when(mode == "road", duration).otherwise(duration + ground).cast("int")


def annotate(
    offers: DataFrame, now: Column, stale_after: int = STALE_AFTER_SECONDS
) -> DataFrame:
    """Add door-to-door minutes, age and the stale flag. Nothing is filtered."""
    fetched = times.instant(F.col("fetched_at"))
    age = times.seconds_between(now, fetched)
    return offers.withColumns(
        {
            "door_to_door_min": door_to_door(
                F.col("mode"), F.col("origin"), F.col("destination"), F.col("duration_min")
            ),
            "age_seconds": F.bround(age, 1),
            "stale": age > stale_after,
        }
    )


def upcoming(offers: DataFrame, now: Column) -> DataFrame:
    """Offers that have not left yet, compared as instants."""
    return offers.filter(times.instant(F.col("depart_time")) > now)


def ranked(offers: DataFrame, kind: str, limit: int | None = None) -> DataFrame:
    """One list over all offers, best first."""
    out = offers.orderBy(*ORDERS[kind])
    return out if limit is None else out.limit(limit)


def top_lists(offers: DataFrame, by: list[str], limit: int = MAX_LIMIT) -> DataFrame:
    """Both lists of every group: the best ``limit`` offers with ``kind`` and ``rank``.

    One scan and one shuffle serve both orders. The row_number cut is applied
    inside each map task before that shuffle, so a popular route sends at most
    ``limit`` rows per task and list.
    """
    price, door = F.col("price_ngn"), F.col("door_to_door_min").cast("double")
    keys = F.array(
        F.struct(F.lit("cheapest").alias("kind"), price.alias("_k1"), door.alias("_k2")),
        F.struct(F.lit("fastest").alias("kind"), door.alias("_k1"), price.alias("_k2")),
    )
    return cut(offers.select("*", F.inline(keys)), ["kind", *by], limit)


def cut(keyed: DataFrame, by: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group of a keyed list."""
    order = Window.partitionBy(*by).orderBy("_k1", "_k2", "carrier", "offer_id")
    return keyed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def offer_labels(annotated: DataFrame) -> DataFrame:
    """The card texts of annotated offers."""
    return annotated.select(
        "offer_id",
        money.naira_label(F.col("price_ngn")).alias("price_label"),
        times.local_clock(F.col("depart_time")).alias("departs"),
        money.duration_label(F.col("door_to_door_min")).alias("journey_label"),
        money.duration_label(F.col("duration_min")).alias("scheduled_label"),
        (F.col("door_to_door_min") != F.col("duration_min")).alias("has_ground_time"),
        F.when(F.col("mode") == "air", "Flight").otherwise("Coach").alias("mode_label"),
        F.when(
            F.col("stale"),
            F.concat(
                F.lit("Last updated "),
                F.floor(F.col("age_seconds") / 60 + 0.5).cast("string"),
                F.lit(" minutes ago"),
            ),
        ).alias("stale_label"),
    )
