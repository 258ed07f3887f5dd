"""The dashboard's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import times
from fareloom.operators.joins import join_groups
from fareloom.operators.ordered import quantiles

PRICE = "price_ngn"


def _price() -> Column:
    return F.col(PRICE).cast("double")


def route_history(
    history: DataFrame, origin: str, destination: str, now: Column, days: int
) -> DataFrame:
    since = now - F.expr(f"INTERVAL {int(days)} DAYS")
    return history.filter(
        (F.col("origin") == origin)
        & (F.col("destination") == destination)
        & (F.col("fetched_at") >= since)
    )


def daily_price(history: DataFrame) -> DataFrame:
    """Mean price per UTC day and carrier."""
    return history.groupBy(F.to_date("fetched_at").alias("day"), "carrier").agg(
        F.avg(_price()).alias("price")
    )


def price_spread(history: DataFrame, by: tuple[str, ...] = ("carrier",)) -> DataFrame:
    """Box-plot figures per group: quartiles, whiskers, and how many lie outside."""
    priced = history.select(*by, _price().alias(PRICE))
    box = _quartiles(priced, by)
    inside = F.col(PRICE).between(F.col("fence_low"), F.col("fence_high"))
    placed = join_groups(priced, box, list(by))
    return placed.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(PRICE))).alias("whisker_low"),
        F.max(F.when(inside, F.col(PRICE))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def price_outliers(history: DataFrame, by: tuple[str, ...] = ("carrier",)) -> DataFrame:
    """The rows beyond the whiskers."""
    box = _quartiles(history.select(*by, _price().alias(PRICE)), by)
    inside = _price().between(F.col("fence_low"), F.col("fence_high"))
    return join_groups(history, box, list(by)).filter(~inside).select(*history.columns)


def _quartiles(priced: DataFrame, by: tuple[str, ...]) -> DataFrame:
    box = quantiles(priced, PRICE, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return box.withColumn("fence_low", F.col("q1") - reach).withColumn(
        "fence_high", F.col("q3") + reach
    )


def carrier_summary(history: DataFrame) -> DataFrame:
    """Observations, cheapest, typical and dearest price, by typical price."""
    by = ("carrier", "mode")
    priced = history.select(*by, _price().alias(PRICE))
    middle = quantiles(priced, PRICE, {"typical": 0.5}, by)
    ends = priced.groupBy(*by).agg(
        F.count("*").alias("observations"),
        F.min(PRICE).alias("cheapest"),
        F.max(PRICE).alias("dearest"),
    )
    return join_groups(ends, middle, list(by)).orderBy("typical", "carrier")


def urgency_curve(history: DataFrame) -> DataFrame:
    """Mean price by whole days ahead (halves to even) and mode, 0 to 30 days."""
    days = F.bround(times.days_between(F.col("depart_time"), F.col("fetched_at")))
    placed = history.select(days.cast("int").alias("days_ahead"), "mode", _price().alias(PRICE))
    return (
        placed.filter(F.col("days_ahead").between(0, 30))
        .groupBy("days_ahead", "mode")
        .agg(F.avg(PRICE).alias("price"))
    )


def prediction_counts(predictions: DataFrame) -> DataFrame:
    known = F.col("actual_rose").isNotNull()
    right = (F.col("will_rise") == F.col("actual_rose")).cast("double")
    return predictions.agg(
        F.count("*").alias("n_predictions"),
        F.count_if(known).alias("n_known"),
        (F.avg(F.when(known, right)) * 100).alias("percent_correct"),
    )


def daily_accuracy(predictions: DataFrame) -> DataFrame:
    return (
        predictions.filter(F.col("actual_rose").isNotNull())
        .groupBy(F.to_date("predicted_at").alias("day"))
        .agg(
            F.avg((F.col("will_rise") == F.col("actual_rose")).cast("double")).alias("accuracy"),
            F.count("*").alias("n"),
        )
    )


def prediction_label(probability: Column, will_rise: Column) -> Column:
    """40 to 60 percent, after rounding, is too close to call."""
    percent = F.floor(probability * 100 + 0.5)
    shown = F.concat(F.lit(" ("), percent.cast("string"), F.lit("%)"))
    return F.concat(
        F.when(percent.between(40, 60), "Could go either way")
        .when(will_rise, "Likely to rise")
        .otherwise("Unlikely to rise"),
        shown,
    )
