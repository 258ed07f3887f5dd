"""Deterministic keys: offer ids, route keys, idempotency keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.functions.times import render_id_stamp
from fareloom.sources.registry import carrier_key


def _dashed(*parts: Column) -> Column:
    """Null if any part is null, unlike concat_ws."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("-"), part)
    return joined


def offer_id_from_key(key: Column, mode: Column, origin: Column, dest: Column, depart: Column):
    return _dashed(key, mode, origin, dest, render_id_stamp(depart))


def offer_id(carrier: Column, mode: Column, origin: Column, dest: Column, depart: Column):
    """Identity of one physical departure; null for an unknown carrier."""
    return offer_id_from_key(
        carrier_key(carrier),
        F.lower(F.trim(mode)),
        F.upper(F.trim(origin)),
        F.upper(F.trim(dest)),
        depart,
    )


def route_label(origin: Column, dest: Column) -> Column:
    return _dashed(origin, dest)


def route_key(origin: Column, dest: Column) -> Column:
    """Lagos-first key shared by both directions; null unless Lagos is one end."""
    return (
        F.when(origin == dest, F.lit(None).cast("string"))
        .when(origin == "LOS", F.concat(F.lit("LOS-"), dest))
        .when(dest == "LOS", F.concat(F.lit("LOS-"), origin))
    )


def idempotency_key(offer: Column, email: Column, price: Column) -> Column:
    """Same trip, traveller and quoted price give the same key."""
    material = F.concat(
        offer, F.lit("|"), F.lower(F.trim(email)), F.lit("|"),
        F.format_string("%.2f", price.cast("double")),
    )
    return F.concat(F.lit("auto-v1-"), F.substring(F.sha2(material, 256), 1, 16))
