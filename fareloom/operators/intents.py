"""Free-text travel queries read with rules, as expressions over a text column.

Every answer is a native expression of (text, today): the batch form of a
search box, with no Python per row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.staging import evaluated_once
from fareloom.sources.registry import lookup

# The spellings understood for each place.
PLACE_WORDS = {
    "lagos": "LOS", "eko": "LOS", "los": "LOS", "ikeja": "LOS",
    "abuja": "ABV", "abv": "ABV", "fct": "ABV",
    "onitsha": "ONI", "oni": "ONI",
    "port harcourt": "PHC", "portharcourt": "PHC", "phc": "PHC",
    "port-harcourt": "PHC", "ph": "PHC",
    "london": "LHR", "lhr": "LHR", "heathrow": "LHR", "uk": "LHR",
}
# The words that ask for speed or for a low price.
FAST_WORDS = [
    "fastest", "quickest", "quick", "fast", "soonest", "shortest",
    "in a hurry", "asap", "least time", "get there quick",
]
CHEAP_WORDS = [
    "cheapest", "cheap", "budget", "affordable", "least expensive",
    "lowest", "save money", "economical",
]
# Weekday and month names.
WEEKDAYS = {
    "monday": 0, "tuesday": 1, "wednesday": 2, "thursday": 3, "friday": 4, "saturday": 5,
    "sunday": 6, "mon": 0, "tue": 1, "tues": 1, "wed": 2, "thu": 3, "thur": 3, "thurs": 3,
    "fri": 4, "sat": 5, "sun": 6,
}
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7,
    "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9,
    "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}
MIN_TEXT, MAX_TEXT = 2, 300


def _any(words) -> str:
    """An alternation in which no word can shadow a longer one."""
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


# (?U) makes word boundaries know letters beyond ASCII.
_PLACE = rf"(?U)\b({_any(PLACE_WORDS)})\b"
_AFTER = r"(?U)\b{word}\s+(?:the\s+)?({places})\b"
# How the published date phrases are written.
_ISO = r"(?U)\b(\d{4}-\d{2}-\d{2})\b"
_WEEKDAY = rf"(?U)\b(next|this|coming)?\s*({_any(WEEKDAYS)})\b"
_DAY_MONTH = rf"(?U)\b(\d{{1,2}})(?:st|nd|rd|th)?\s+({_any(MONTHS)})\b"
_MONTH_DAY = rf"(?U)\b({_any(MONTHS)})\s+(\d{{1,2}})(?:st|nd|rd|th)?\b"
_NTH = r"(?U)\bthe (\d{1,2})(?:st|nd|rd|th)\b"


def _clean(text: Column) -> Column:
    return F.trim(F.lower(text))


def places_named(text: Column) -> Column:
    """Codes of the places a text names, in order of appearance."""
    words = F.regexp_extract_all(_clean(text), F.lit(_PLACE), 1)
    return F.transform(words, lambda w: lookup(PLACE_WORDS, w))


def place_after(text: Column, word: str) -> Column:
    pattern = _AFTER.format(word=word, places=_any(PLACE_WORDS))
    return lookup(PLACE_WORDS, F.regexp_extract(_clean(text), pattern, 1))


def _step(today: Column, days: Column | int) -> Column:
    return F.date_format(F.date_add(today, days), "yyyy-MM-dd")


def _next_occurrence(today: Column, month: Column, day: Column) -> Column:
    """That calendar day this year, or next year when already past.

    Null when this year has no such day, even if another year does.
    """

    def in_year(ahead: int) -> Column:
        return F.format_string("%04d-%02d-%02d", F.year(today) + ahead, month, day).try_cast(
            "date"
        )

    this, following = in_year(0), in_year(1)
    picked = F.when(this.isNull(), F.lit(None).cast("date")).when(this >= today, this)
    return F.date_format(picked.otherwise(following), "yyyy-MM-dd")


def _date_parts(text: Column) -> dict[str, Column]:
    """What the text says about a date; empty text or null where it says nothing."""
    t = _clean(text)
    found = F.regexp_extract

    def mentions(*phrases: str) -> Column:
        return reduce(or_, [F.contains(t, F.lit(p)) for p in phrases])

    return {
        "_iso": found(t, _ISO, 1),
        "_plain": F.when(mentions("day after tomorrow"), 2)
        .when(mentions("today", "tonight"), 0)
        .when(mentions("tomorrow"), 1),
        "_weekday": lookup(WEEKDAYS, found(t, _WEEKDAY, 2)),
        "_is_next": found(t, _WEEKDAY, 1) == "next",
        "_dm_month": lookup(MONTHS, found(t, _DAY_MONTH, 2)),
        "_dm_day": found(t, _DAY_MONTH, 1).try_cast("int"),
        "_md_month": lookup(MONTHS, found(t, _MONTH_DAY, 1)),
        "_md_day": found(t, _MONTH_DAY, 2).try_cast("int"),
        "_nth": found(t, _NTH, 1).try_cast("int"),
        "_next_week": mentions("next week"),
    }


def _date_from(part: dict[str, Column], today: Column) -> Column:
    """The day the parts mean. The first kind of phrase that matches decides."""
    gap = F.pmod(part["_weekday"] - F.weekday(today), F.lit(7))
    ahead = F.when(gap == 0, 7).when(part["_is_next"], gap + 7).otherwise(gap)
    return (
        F.when(part["_iso"] != "", part["_iso"])
        .when(part["_plain"].isNotNull(), _step(today, part["_plain"]))
        .when(part["_weekday"].isNotNull(), _step(today, ahead))
        .when(
            part["_dm_month"].isNotNull(),
            _next_occurrence(today, part["_dm_month"], part["_dm_day"]),
        )
        .when(
            part["_md_month"].isNotNull(),
            _next_occurrence(today, part["_md_month"], part["_md_day"]),
        )
        .when(part["_nth"].isNotNull(), _next_occurrence(today, F.month(today), part["_nth"]))
        .when(part["_next_week"], _step(today, 7))
    )


def travel_date(text: Column, today: Column) -> Column:
    """The day a text asks for, as yyyy-MM-dd text; null when it names none."""
    return _date_from(_date_parts(text), today)


def _first_at(text: Column, words: list[str]) -> Column:
    """Where the earliest of the words starts; null when none occurs."""
    return F.least(*[F.nullif(F.instr(text, w), F.lit(0)) for w in words])


def preference(text: Column) -> Column:
    t = _clean(text)
    fast, cheap = _first_at(t, FAST_WORDS), _first_at(t, CHEAP_WORDS)
    return F.when(fast.isNotNull() & (cheap.isNull() | (fast < cheap)), "fastest").otherwise(
        "cheapest"
    )


def with_route(queries: DataFrame, text: str = "text") -> DataFrame:
    """Add ``named``, ``origin`` and ``destination`` (empty when not understood)."""
    named, start, end = F.col("named"), F.col("_from"), F.col("_to")
    first, many = F.get("named", F.lit(0)), F.size("named") >= 2

    def other_than(code: Column) -> Column:
        return F.get(F.filter(named, lambda p: p != code), F.lit(0))

    # Words before places beat the order of places; Lagos is the default end.
    origin = F.coalesce(
        F.when(end.isNotNull(), F.coalesce(start, other_than(end), F.lit("LOS"))),
        F.when(many, F.coalesce(start, first)),
        F.lit("LOS"),
    )
    second = F.when(start.isNull(), F.get("named", F.lit(1))).otherwise(other_than(start))
    destination = F.coalesce(
        end,
        F.when(many, F.coalesce(second, F.lit(""))),
        F.nullif(first, F.lit("LOS")),
        F.lit(""),
    )
    staged = evaluated_once(
        queries,
        {
            "named": places_named(F.col(text)),
            "_from": place_after(F.col(text), "from"),
            "_to": place_after(F.col(text), "to"),
        },
    )
    return evaluated_once(staged, {"origin": origin, "destination": destination}).drop(
        "_from", "_to"
    )


def parse(queries: DataFrame, text: str = "text", today: str = "today") -> DataFrame:
    """Each text as a search: route, date, preference, confidence, notes, problems."""
    parts = _date_parts(F.col(text))
    staged = with_route(queries, text).withColumns(parts)
    routed = evaluated_once(
        staged,
        {
            "date": _date_from({name: F.col(name) for name in parts}, F.col(today)),
            "preference": preference(F.col(text)),
            "_written": F.col("_iso") != "",
        },
    ).drop(*parts)
    origin, dest, count = F.col("origin"), F.col("destination"), F.size("named")
    lost = dest == ""
    notes = F.concat_ws(
        "; ",
        F.when(lost & (count == 0), "no place could be identified"),
        F.when(
            lost & (count > 0), "only Lagos was named, so the destination is unknown"
        ),
        F.when(
            F.col("date").isNull(),
            "no date was given, so all upcoming departures are searched",
        ),
    )
    problems = F.concat_ws(
        "|",
        F.when(
            ~F.length(text).between(MIN_TEXT, MAX_TEXT), "text must be 2 to 300 characters"
        ),
        F.when(lost, "no destination could be identified"),
        F.when(origin == dest, "origin and destination are the same place"),
        # Only a date written out can be wrong; the others are computed.
        F.when(
            F.col("_written")
            & F.col("date").try_cast("date").isNull(),
            "date is not a calendar date",
        ),
    )
    return (
        routed.withColumn("note", notes)
        .withColumn("problems", F.array_remove(F.split(problems, r"\|"), ""))
        .withColumn("confident", ~lost)
        .drop("named", "_written")
    )
