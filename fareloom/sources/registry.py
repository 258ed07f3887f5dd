"""Places, routes and carriers: three tiny fixed tables.

They are small by definition (5, 4 and 8 rows), so per-row lookups are literal
maps inside the projection and cost no join. The DataFrame forms exist for the
questions that ask about the dimension itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code, name, kind, zone, country, has_airport, ground minutes.
PLACES = [
    ("LOS", "Lagos", "iata", "Africa/Lagos", "NG", True, 150),
    ("ABV", "Abuja", "iata", "Africa/Lagos", "NG", True, 90),
    ("PHC", "Port Harcourt", "iata", "Africa/Lagos", "NG", True, 90),
    ("LHR", "London Heathrow", "iata", "Europe/London", "GB", True, 120),
    ("ONI", "Onitsha", "internal", "Africa/Lagos", "NG", False, 0),
]

# Each in-scope route, listed once.
ROUTES = [("LOS", "LHR"), ("LOS", "ABV"), ("LOS", "ONI"), ("LOS", "PHC")]

# Key, name, mode, routes, access, refresh seconds.
CARRIERS = [
    ("gigm", "GIGM", "road", ["LOS-ABV", "LOS-ONI", "LOS-PHC"], "scrape", 900),
    ("abctransport", "ABC Transport", "road", ["LOS-ABV", "LOS-ONI", "LOS-PHC"], "scrape", 900),
    ("crosscountry", "Cross Country", "road", ["LOS-ABV", "LOS-ONI"], "simulate", 900),
    ("chisco", "CHISCO", "road", ["LOS-ONI", "LOS-PHC"], "scrape", 900),
    ("airpeace", "Air Peace", "air", ["LOS-ABV", "LOS-PHC"], "poll", 300),
    ("ibomair", "Ibom Air", "air", ["LOS-ABV", "LOS-PHC"], "poll", 300),
    ("arik", "Arik Air", "air", ["LOS-ABV", "LOS-PHC"], "poll", 300),
    ("britishairways", "British Airways", "air", ["LOS-LHR"], "poll", 600),
]

PLACE_SCHEMA = (
    "code string, name string, kind string, timezone string, country string, "
    "has_airport boolean, airport_ground_minutes int"
)
CARRIER_SCHEMA = (
    "key string, name string, mode string, routes array<string>, access string, "
    "refresh_seconds int"
)


def literal_map(values: Mapping) -> Column:
    """A fixed mapping as one constant; its values are plain words and numbers."""
    return F.expr("map(" + ", ".join(repr(x) for pair in values.items() for x in pair) + ")")


def lookup(values: Mapping, key: Column) -> Column:
    """The value of a small fixed mapping, null when the key is not in it."""
    return F.try_element_at(literal_map(values), key)


def places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLACES, PLACE_SCHEMA)


def carriers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CARRIERS, CARRIER_SCHEMA)


def routes(spark: SparkSession) -> DataFrame:
    """Every supported (origin, destination), both directions, once each."""
    one_way = spark.createDataFrame(ROUTES, "origin string, destination string")
    back = one_way.select(
        F.col("destination").alias("origin"), F.col("origin").alias("destination")
    )
    return one_way.union(back).distinct()


def carrier_directions(spark: SparkSession) -> DataFrame:
    """One row per carrier and direction it runs."""
    legs = carriers(spark).select(
        F.col("key").alias("carrier_key"),
        "mode",
        F.explode("routes").alias("route"),
    )
    ends = F.split("route", "-")
    out = legs.select("carrier_key", "mode", ends[0].alias("origin"), ends[1].alias("destination"))
    back = legs.select("carrier_key", "mode", ends[1].alias("origin"), ends[0].alias("destination"))
    return out.union(back)


def known_place(code: Column) -> Column:
    return code.isin([p[0] for p in PLACES])


def place_zone(code: Column) -> Column:
    return lookup({p[0]: p[3] for p in PLACES}, code)


def has_airport(code: Column) -> Column:
    return lookup({p[0]: p[5] for p in PLACES}, code)


def ground_minutes(code: Column) -> Column:
    return lookup({p[0]: p[6] for p in PLACES}, code)


def supported_route(origin: Column, destination: Column) -> Column:
    pairs = [f"{a}-{b}" for a, b in ROUTES] + [f"{b}-{a}" for a, b in ROUTES]
    return F.concat_ws("-", origin, destination).isin(pairs)


def mode_possible(code: Column, mode: Column) -> Column:
    """Air needs an airport; null for flights at a place not in the registry."""
    return (mode != "air") | has_airport(code)


def carrier_key(carrier: Column) -> Column:
    """Key of a carrier given by display name or by key; null when unknown."""
    text = F.trim(carrier)
    by_name = lookup({c[1]: c[0] for c in CARRIERS}, text)
    lowered = F.lower(text)
    return F.coalesce(by_name, F.when(lowered.isin([c[0] for c in CARRIERS]), lowered))
