"""The offer contract and the other row rules, as arrays of problem codes.

A rule is a boolean that is true for a good row; a null verdict counts as
broken. Every problem of a row is listed, in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import times
from fareloom.functions.identity import offer_id
from fareloom.functions.staging import evaluated_once
from fareloom.sources import registry
from fareloom.sources.schemas import OFFER, OFFER_COLUMNS

# The published limits of the canonical offer.
OFFER_ID_PATTERN = "^[a-z]+-(road|air)-[A-Z]{3}-[A-Z]{3}-[0-9]{8}T[0-9]{4}Z$"
PLACE_PATTERN = "^[A-Z]{3}$"
MAX_DURATION_MIN = 4320
MAX_PRICE_NGN = 100_000_000
MAX_SEATS = 1000

BOOKING_STATES = ["pending", "confirmed", "failed", "unknown"]
UPDATABLE = [
    "state", "price_ngn_at_book", "provider", "provider_reference", "attempts", "last_error",
]


def _codes(rules: dict[str, Column]) -> Column:
    """Codes of the rules a row breaks, joined with a bar."""
    broken = [
        F.when(~F.coalesce(good, F.lit(False)), F.lit(code)) for code, good in rules.items()
    ]
    return F.concat_ws("|", *broken)


def _as_array(codes: Column) -> Column:
    return F.array_remove(F.split(codes, r"\|"), "")


def problems(rules: dict[str, Column]) -> Column:
    """Codes of the rules a row breaks, as an array."""
    return _as_array(_codes(rules))


def _if_present(good: Column) -> Column:
    """A rule that says nothing about a missing value, for which it is null."""
    return F.coalesce(good, F.lit(True))


def _shape_rules(row: str | None) -> dict[str, Column]:
    c = _getter(row)
    rules = {f"required:{name}": c(name).isNotNull() for name in OFFER_COLUMNS}
    rules |= {
        "pattern:offer_id": _if_present(c("offer_id").rlike(OFFER_ID_PATTERN)),
        "length:carrier": _if_present(F.length(c("carrier")).between(2, 40)),
        "enum:mode": _if_present(c("mode").isin("road", "air")),
        "pattern:origin": _if_present(c("origin").rlike(PLACE_PATTERN)),
        "pattern:destination": _if_present(c("destination").rlike(PLACE_PATTERN)),
        "range:duration_min": _if_present(c("duration_min").between(1, MAX_DURATION_MIN)),
        "range:price_ngn": _if_present(
            (c("price_ngn") > 0) & (c("price_ngn") <= MAX_PRICE_NGN)
        ),
        "range:seats_left": _if_present(c("seats_left").between(0, MAX_SEATS)),
        "length:booking_url": _if_present(F.length(c("booking_url")) > 0),
    }
    return rules


def _meaning_rules(row: str | None) -> dict[str, Column]:
    c = _getter(row)
    origin, dest, mode = c("origin"), c("destination"), c("mode")
    depart, fetched = F.col("_depart"), F.col("_fetched")
    expected = offer_id(c("carrier"), mode, origin, dest, depart)
    known = registry.known_place(origin) & registry.known_place(dest)
    return {
        "same_place": origin != dest,
        "unsupported_route": (origin == dest) | registry.supported_route(origin, dest),
        "unknown_place": known,
        "impossible_mode:origin": _if_present(registry.mode_possible(origin, mode)),
        "impossible_mode:destination": _if_present(registry.mode_possible(dest, mode)),
        "no_offset:depart_time": depart.isNotNull(),
        "no_offset:fetched_at": fetched.isNotNull(),
        "already_departed": _if_present(depart > fetched),
        "unknown_carrier": registry.carrier_key(c("carrier")).isNotNull(),
        "wrong_offer_id": _if_present(c("offer_id") == expected),
    }


def _getter(row: str | None):
    return (lambda name: F.col(name)) if row is None else (lambda name: F.col(f"{row}.{name}"))


def _checked(frame: DataFrame, row: str | None, raw: Column) -> DataFrame:
    """Add ``contract_errors``: raw and shape problems, else those of meaning.

    Built in steps, so the instants and the shape verdict are computed once.
    """
    c = _getter(row)
    staged = frame.withColumns(
        {
            "_depart": times.instant(c("depart_time")),
            "_fetched": times.instant(c("fetched_at")),
            "_shape": F.concat_ws("|", F.nullif(raw, F.lit("")), _codes(_shape_rules(row))),
        }
    )
    meaning = F.when(F.col("_shape") == "", _codes(_meaning_rules(row)))
    errors = {"contract_errors": _as_array(F.coalesce(meaning, "_shape"))}
    return evaluated_once(staged, errors).drop("_depart", "_fetched", "_shape")


def check_offers(offers: DataFrame) -> DataFrame:
    """Add ``contract_valid`` and ``contract_errors``."""
    checked = _checked(offers, None, F.lit(""))
    return checked.withColumn("contract_valid", F.size("contract_errors") == 0)


# The JSON type of each field of the published offer.
JSON_TYPES = {
    **{name: "string" for name in OFFER_COLUMNS},
    "duration_min": "integer", "seats_left": "integer", "price_ngn": "number",
}
_NUMERIC = r"^(?:BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _typed(message: Column, name: str) -> tuple[Column, Column]:
    """A field's value if it has its JSON type, and whether it is there with another one.

    A whole number may be written with a fraction of zero; a number in quotes is a string.
    A JSON null counts as missing.
    """
    wanted, at = JSON_TYPES[name], f"$.{name}"
    kind = F.schema_of_variant(F.try_variant_get(message, at, "variant"))
    there = kind.isNotNull() & (kind != "VOID")
    if wanted == "string":
        good = kind == "STRING"
        value = F.try_variant_get(message, at, "string")
    else:
        value = F.try_variant_get(message, at, "double")
        good = kind.rlike(_NUMERIC) & value.isNotNull()
        if wanted == "integer":
            good = good & (value == F.floor(value))
            value = value.try_cast("int")
    return F.when(good, value), there & ~F.coalesce(good, F.lit(False))


def check_messages(messages: DataFrame, body: str = "value") -> DataFrame:
    """Check raw JSON offers: unknown fields and wrong types are problems too.

    Each message is parsed once, as a VARIANT, and its fields are looked at by path. A field of
    another type than the published one is a problem of its own and counts as missing. What is
    no JSON object has no other problem than that. Adds ``offer`` and ``contract_errors``.
    """
    parsed = evaluated_once(messages, {"_v": F.try_parse_json(body)})
    fields = {name: _typed(F.col("_v"), name) for name in OFFER_COLUMNS}
    unknown = F.transform(
        F.array_except(
            F.coalesce(F.json_object_keys(body), F.array().cast("array<string>")),
            F.array(*[F.lit(n) for n in OFFER_COLUMNS]),
        ),
        lambda name: F.concat(F.lit("unexpected:"), name),
    )
    mistyped = [F.when(wrong, F.lit(f"type:{name}")) for name, (_, wrong) in fields.items()]
    parsed = evaluated_once(
        parsed,
        {
            "offer": F.struct(*[value.alias(name) for name, (value, _) in fields.items()]),
            "_raw": F.concat_ws("|", unknown, *mistyped),
            "_object": F.schema_of_variant("_v").startswith("OBJECT"),
        },
    )
    checked = _checked(parsed, "offer", F.col("_raw"))
    errors = F.when(F.col("_object"), F.col("contract_errors")).otherwise(
        F.array(F.lit("not_an_object"))
    )
    return checked.withColumn("contract_errors", errors).drop("_v", "_raw", "_object")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their reasons)."""
    good = checked.filter(F.size("contract_errors") == 0)
    return good, checked.filter(F.size("contract_errors") > 0)


def history_problems() -> Column:
    """What the history table itself refuses."""
    return problems(
        {
            "mode": F.col("mode").isin("road", "air"),
            "duration_min": F.col("duration_min") > 0,
            "price_ngn": F.col("price_ngn") > 0,
            "seats_left": F.col("seats_left") >= 0,
        }
        | {
            f"null:{name}": F.col(name).isNotNull()
            for name in ("offer_id", "carrier", "origin", "destination", "depart_time",
                         "booking_url", "fetched_at")
        }
    )


def prediction_problems() -> Column:
    return problems({"probability": F.col("probability").between(0, 1)})


def booking_problems() -> Column:
    return problems({"state": F.col("state").isin(BOOKING_STATES)})


def update_problems() -> Column:
    """A change log entry: only some columns may change, and only to legal states."""
    return problems(
        {
            "not_updatable": F.col("column_name").isin(UPDATABLE),
            "invalid_state": (F.col("column_name") != "state")
            | F.col("new_value").isin(BOOKING_STATES),
        }
    )


# What a booking request may contain.
REQUEST_FIELDS = ["offer_id", "quoted_price_ngn", "passenger", "idempotency_key"]
PASSENGER_FIELDS = [
    "given_name", "family_name", "email", "born_on", "phone", "title", "gender",
]
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
REQUEST_SCHEMA = (
    "offer_id string, quoted_price_ngn double, idempotency_key string, "
    "passenger struct<given_name: string, family_name: string, email: string, "
    "born_on: string, phone: string, title: string, gender: string>"
)


def check_booking_requests(messages: DataFrame, body: str = "body") -> DataFrame:
    """Validate JSON booking requests; anything not expected is refused."""
    parsed = messages.withColumn("request", F.from_json(body, REQUEST_SCHEMA))
    r = _getter("request")
    p = _getter("request.passenger")

    def long_enough(value: Column, low: int, high: int) -> Column:
        return F.length(value).between(low, high)

    extra = F.size(
        F.array_except(
            F.json_object_keys(body), F.array(*[F.lit(n) for n in REQUEST_FIELDS])
        )
    )
    extra_person = F.size(
        F.array_except(
            F.json_object_keys(F.get_json_object(body, "$.passenger")),
            F.array(*[F.lit(n) for n in PASSENGER_FIELDS]),
        )
    )
    rules = {
        "unexpected_field": extra == 0,
        "offer_id": long_enough(r("offer_id"), 5, 120),
        "quoted_price_ngn": r("quoted_price_ngn") > 0,
        "idempotency_key": _if_present(long_enough(r("idempotency_key"), 8, 120)),
        "passenger": r("passenger").isNotNull(),
        "passenger_unexpected_field": extra_person == 0,
        "given_name": long_enough(p("given_name"), 1, 60),
        "family_name": long_enough(p("family_name"), 1, 60),
        "email_length": long_enough(p("email"), 3, 200),
        "email": F.trim(p("email")).rlike(EMAIL_PATTERN),
        "born_on": _if_present(p("born_on").rlike(r"^\d{4}-\d{2}-\d{2}$")),
        "phone": _if_present(F.length(p("phone")) <= 20),
        "title": _if_present(F.length(p("title")) <= 10),
        "gender": _if_present(p("gender").rlike("^[mf]$")),
    }
    return parsed.withColumn("request_errors", problems(rules))
