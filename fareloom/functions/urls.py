"""Query-string editing without losing the order of the parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pair(name: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), value.alias("value"))


def _decoded(text: Column) -> Column:
    return F.try_url_decode(text)


def with_params(url: Column, params: dict[str, Column]) -> Column:
    """Set query parameters on a URL, keeping the others and every position.

    A repeated parameter keeps its first position and its last value, blank
    values are dropped, and the fragment stays at the end.
    """
    no_fragment = F.substring_index(url, "#", 1)
    fragment = F.when(F.instr(url, "#") > 0, F.regexp_extract(url, "(#.*)$", 1)).otherwise("")
    base = F.substring_index(no_fragment, "?", 1)
    query = F.when(F.instr(no_fragment, "?") > 0, F.regexp_extract(no_fragment, r"\?(.*)$", 1))
    raw = F.filter(
        F.split(F.coalesce(query, F.lit("")), "&"),
        lambda p: p.rlike("^[^=]*=.+"),
    )
    existing = F.transform(
        raw,
        lambda p: _pair(
            _decoded(F.substring_index(p, "=", 1)), _decoded(F.regexp_extract(p, "=(.*)$", 1))
        ),
    )
    added = F.array(*[_pair(F.lit(name), value) for name, value in params.items()])
    # A one-element transform names the pairs, so they are split and decoded once.
    merged = F.get(F.transform(F.array(F.concat(existing, added)), _encoded), F.lit(0))
    return F.concat(base, F.lit("?"), F.array_join(merged, "&"), fragment)


def _encoded(pairs: Column) -> Column:
    """Each name once, in first position, with its last value, as name=value."""
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    return F.transform(
        names,
        lambda n: F.concat(
            F.url_encode(n),
            F.lit("="),
            F.url_encode(F.element_at(F.filter(pairs, lambda p: p["name"] == n), -1)["value"]),
        ),
    )


def deep_link(offer_url: Column, origin: Column, dest: Column, depart_time: Column) -> Column:
    """The carrier's own page with the journey filled in, and no personal data."""
    return with_params(
        offer_url,
        {
            "from": origin,
            "to": dest,
            "date": F.substring(depart_time, 1, 10),
            "depart": F.substring(depart_time, 12, 5),
            "passengers": F.lit("1"),
            "class": F.lit("economy"),
        },
    )
