"""Instants, zones and their text forms, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.sources.registry import place_zone

SECOND = 1_000_000  # microseconds
HOUR = 3600 * SECOND
DAY = 24 * HOUR

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
# Whole text when it is a timestamp that carries an offset, or one that does not.
_CLOCK = r"\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
_ZONED = rf"^\s*(\d{{4}}-\d{{2}}-\d{{2}}[T ]{_CLOCK}(?:Z|[+-]\d{{2}}:?\d{{2}}))\s*$"
_NAIVE = rf"^\s*(\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]{_CLOCK})?)\s*$"


# Expressions here mention their input as few times as possible: Catalyst copies
# an input expression into every mention when it merges projections and filters.


def instant(text: Column) -> Column:
    """The instant an offset-carrying timestamp names; null for anything naive."""
    return F.regexp_extract(text, _ZONED, 1).try_cast("timestamp")


def wall_clock_instant(text: Column, place: Column) -> Column:
    """A naive wall-clock time at a place; null when it already has an offset."""
    naive = F.regexp_extract(text, _NAIVE, 1).try_cast("timestamp")
    return F.to_utc_timestamp(naive, place_zone(place))


def parse_local(text: Column, pattern: str, zone: str) -> Column:
    """Text in a fixed pattern, read as local time in ``zone``."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(pattern)), zone)


def render_local(ts: Column, zone: Column | str, zero: str = "+00:00") -> Column:
    """Local time with its UTC offset; ``zero`` is how no offset is written."""
    local = F.from_utc_timestamp(ts, zone)
    offset = F.unix_seconds(local) - F.unix_seconds(ts)
    size = F.date_format(F.timestamp_seconds(F.abs(offset)), "HH:mm")
    sign = F.substring(F.lit("-++"), F.signum(offset).cast("int") + 2, F.lit(1))
    shown = F.concat(F.date_format(local, ISO_SECONDS), sign, size)
    return shown if zero == "+00:00" else F.regexp_replace(shown, r"[+]00:00$", zero)


def render_departure(ts: Column, place: Column) -> Column:
    return render_local(ts, place_zone(place))


def render_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS + "'Z'")


def render_id_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmm'Z'")


def local_date(depart_time: Column) -> Column:
    return F.substring(depart_time, 1, 10)


def local_clock(depart_time: Column) -> Column:
    return F.substring(depart_time, 12, 5)


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def seconds_between(later: Column, earlier: Column) -> Column:
    return micros_between(later, earlier) / F.lit(float(SECOND))


def days_between(later: Column, earlier: Column) -> Column:
    return micros_between(later, earlier) / F.lit(float(DAY))


def departure_hour(depart: Column, true_zone_of: Column | None = None) -> Column:
    """Hour at departure. A fixed +1 h unless the origin's own zone is asked for."""
    return F.hour(_shifted(depart, true_zone_of))


def departure_weekday(depart: Column, true_zone_of: Column | None = None) -> Column:
    """Monday is 0."""
    return F.weekday(_shifted(depart, true_zone_of))


def _shifted(depart: Column, true_zone_of: Column | None) -> Column:
    if true_zone_of is None:
        return depart + F.expr("INTERVAL 1 HOUR")
    return F.from_utc_timestamp(depart, place_zone(true_zone_of))
