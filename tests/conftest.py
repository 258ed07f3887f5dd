from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fareloom.session import build_local  # noqa: E402

# A fixed "now" for every behaviour case.
NOW = "2026-09-13 12:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return build_local("tests", "8", 4, shared=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def now():
    from pyspark.sql import functions as F

    return F.lit(NOW).cast("timestamp")


@pytest.fixture
def offers(spark):
    """Canonical offers from keyword overrides of one usual offer."""
    from fareloom.sources.schemas import OFFER, OFFER_COLUMNS

    usual = {
        "offer_id": "gigm-road-LOS-ABV-20260914T0600Z",
        "carrier": "GIGM",
        "mode": "road",
        "origin": "LOS",
        "destination": "ABV",
        "depart_time": "2026-09-14T07:00:00+01:00",
        "duration_min": 600,
        "price_ngn": 25000.0,
        "seats_left": 12,
        "booking_url": "https://gigm.example/booking?trip=LOSABV",
        "fetched_at": "2026-09-13T12:00:00Z",
    }

    def make(*changes):
        full = [{**usual, **c} for c in changes]
        return spark.createDataFrame([[r[c] for c in OFFER_COLUMNS] for r in full], OFFER)

    return make


@pytest.fixture
def one(spark):
    """Evaluate expressions over one row of named values."""

    def evaluate(expression, **values):
        frame = spark.range(1)
        from pyspark.sql import functions as F

        for name, value in values.items():
            frame = frame.withColumn(name, F.lit(value))
        return frame.select(expression.alias("x")).first()["x"]

    return evaluate
