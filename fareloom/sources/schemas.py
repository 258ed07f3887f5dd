"""Declared schemas. Nothing in this package infers one."""

from __future__ import annotations

# The columns each carrier publishes.
FEED_SCHEMAS = {
    "gigm": (
        "operator string, from_city string, to_city string, dep_date string, dep_time string, "
        "fare string, seats string, travel_hours double, booking_link string, scraped_at string"
    ),
    "abctransport": (
        "company string, origin_terminal string, destination_terminal string, departs string, "
        "amount double, seats_available int, journey_minutes int, url string, ts string"
    ),
    "crosscountry": (
        "carrier_code string, start string, `end` string, epoch_departure bigint, "
        "price_kobo bigint, seats int, duration_secs int, deeplink string, captured_at_epoch bigint"
    ),
    "chisco": (
        "line string, board string, alight string, `when` string, cost string, open_seats int, "
        "hours double, link string, pulled string"
    ),
    "airpeace": (
        "airline string, flight_number string, dep_airport string, arr_airport string, std string, "
        "cabin string, total_fare struct<amount: double, currency: string>, seats_remaining int, "
        "duration_minutes int, deep_link string, fetched string"
    ),
    "ibomair": (
        "carrier string, `from` string, `to` string, departure_utc string, fare_ngn double, "
        "seats int, block_minutes int, booking_url string, as_of string"
    ),
    "arik": (
        "op_carrier string, board_point string, off_point string, flight_date string, "
        "dep_minutes_after_midnight int, fare_amount double, fare_currency string, avail int, "
        "elapsed_minutes int, url string, extracted_at string"
    ),
    "britishairways": (
        "marketingCarrier string, origin string, destination string, departureDateTime string, "
        "cabinClass string, totalPrice double, currencyCode string, availableSeats int, "
        "journeyDurationMinutes int, bookingUrl string, timestamp string"
    ),
}

OFFER = (
    "offer_id string, carrier string, mode string, origin string, destination string, "
    "depart_time string, duration_min int, price_ngn double, seats_left int, "
    "booking_url string, fetched_at string"
)
OFFER_COLUMNS = [
    "offer_id", "carrier", "mode", "origin", "destination", "depart_time",
    "duration_min", "price_ngn", "seats_left", "booking_url", "fetched_at",
]
# The stored form: instants instead of text, two decimals of money.
HISTORY = (
    "offer_id string, carrier string, mode string, origin string, destination string, "
    "depart_time timestamp, duration_min int, price_ngn decimal(12,2), seats_left int, "
    "booking_url string, fetched_at timestamp"
)
BOOKING = (
    "idempotency_key string, offer_id string, carrier string, state string, "
    "price_ngn_quoted decimal(12,2), price_ngn_at_book decimal(12,2), provider string, "
    "provider_reference string, attempts int, last_error string, created_at timestamp, "
    "updated_at timestamp"
)
PREDICTION = (
    "offer_id string, predicted_at timestamp, will_rise boolean, probability double, "
    "model_version string, price_at_prediction decimal(12,2), actual_rose boolean, "
    "scored_at timestamp"
)
