"""Prices as text and as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the fallback pound rate.
GBP_NGN = 2050.0


def digits_as_double(text: Column) -> Column:
    """Digits and dots only, as a number; null when that is not a number."""
    return F.regexp_replace(text, "[^0-9.]", "").try_cast("double")


def digits_as_int(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")


def parse_price(text: Column) -> Column:
    """A scraped price. Several dots are separators; nothing positive gives null."""
    kept = F.regexp_replace(text, r"[^\d.]", "")
    dots = F.length(kept) - F.length(F.replace(kept, F.lit("."), F.lit("")))
    plain = F.when(dots > 1, F.replace(kept, F.lit("."), F.lit(""))).otherwise(kept)
    value = plain.try_cast("double")
    return F.when(value > 0, value)


def to_ngn(amount: Column, currency: Column, rate: float = GBP_NGN) -> Column:
    """Naira to two decimals; null for other currencies or non-positive input."""
    code = F.upper(F.trim(currency))
    naira = F.when(code == "NGN", amount)
    if rate > 0:
        naira = naira.when(code == "GBP", amount * F.lit(float(rate)))
    return F.when(amount > 0, F.round(naira, 2))


def naira_label(amount: Column) -> Column:
    return F.concat(F.lit("NGN "), F.format_number(F.floor(amount + 0.5), 0))


def duration_label(minutes: Column) -> Column:
    hours, rest = F.floor(minutes / 60), minutes % 60
    return F.when(hours > 0, F.format_string("%dh %02dm", hours, rest)).otherwise(
        F.format_string("%dm", rest)
    )
