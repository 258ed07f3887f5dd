"""The booking ledger as a stored table: claims, changes, and what offers have booked.

A key is claimed once; the earliest claim makes the row. A change sets one column of a row
that exists, if it is not older than what the row has seen. Of several changes to one
column the last counts, so folding them is an aggregate that every map task begins: a key
that is hammered costs no more than its distinct columns.

The table is laid out by a hash of the key. Bringing it up to date rewrites the buckets of
the keys concerned, and doing so twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.operators import bookings
from fareloom.operators.contract import UPDATABLE, update_problems
from fareloom.session import stored
from fareloom.sources.tables import is_folder

LEDGER = (
    "idempotency_key string, offer_id string, carrier string, state string, "
    "price_ngn_quoted double, price_ngn_at_book double, provider string, "
    "provider_reference string, attempts int, last_error string, created_at timestamp, "
    "updated_at timestamp"
)
TYPES = dict(c.split() for c in LEDGER.split(", "))
KEY = "idempotency_key"
BUCKETS = 64


def as_ledger(rows: DataFrame) -> DataFrame:
    """Exactly the ledger's columns. A row that was never changed was changed when made."""
    made = {"updated_at": F.col("created_at"), "attempts": F.lit(0)}
    lacking = {c: made.get(c, F.lit(None)) for c in TYPES if c not in rows.columns}
    return rows.withColumns(lacking).select(*[F.col(c).cast(t).alias(c) for c, t in TYPES.items()])


def ledger_after(ledger: DataFrame, claims: DataFrame, changes: DataFrame) -> DataFrame:
    """The ledger after some claims and changes, in whatever order they are given.

    ``claims`` are requests with their key, ``carrier``, ``quoted_price_ngn``, ``requested_at``
    and ``request_id``; a null key claims nothing, a key that is held stays as it is.
    ``changes`` are rows of a key, ``at``, ``number`` (tells changes of one moment apart),
    ``column_name`` and ``new_value`` as text. What ``refused`` lists has no effect.
    """
    held = as_ledger(ledger)
    first = claims.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.min(F.struct("requested_at", "request_id", "offer_id", "carrier", "quoted_price_ngn")).alias("c")
    )
    new = as_ledger(
        first.join(held.select(KEY), KEY, "left_anti").select(
            KEY, "c.offer_id", "c.carrier", F.lit("pending").alias("state"),
            F.col("c.quoted_price_ngn").alias("price_ngn_quoted"),
            F.col("c.requested_at").alias("created_at"),
        )
    )
    rows = held.unionByName(new)
    seen = rows.select(KEY, F.col("updated_at").alias("_seen"))
    legal = changes.filter(F.size(update_problems()) == 0)
    valid = legal.join(seen, KEY).filter(F.col("at") >= F.col("_seen"))
    last = {
        c: F.max(F.when(F.col("column_name") == c, F.struct("at", "number", "new_value")))
        for c in UPDATABLE
    }
    folded = valid.groupBy(KEY).agg(
        *[value.alias(f"_{c}") for c, value in last.items()], F.max("at").alias("_at")
    )

    def column(name: str) -> Column:
        if name == "updated_at":
            return F.coalesce("_at", "updated_at").alias(name)
        if name not in UPDATABLE:
            return F.col(name)
        change = F.col(f"_{name}")
        value = change["new_value"].try_cast(TYPES[name])
        return F.when(change.isNotNull(), value).otherwise(F.col(name)).alias(name)

    return rows.join(folded, KEY, "left").select(*[column(c) for c in TYPES])


def refused(ledger: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes that may not be made, with ``problems``: their own, and ``no_booking``.

    ``ledger`` is the one after the claims. A change older than its row has seen is no
    problem, it just comes too late.
    """
    known = ledger.select(KEY, F.lit(True).alias("_known")).distinct()
    told = changes.withColumn("problems", update_problems()).join(known, KEY, "left")
    lost = F.when(F.col("_known").isNull(), F.array(F.lit("no_booking"))).otherwise(
        F.array().cast("array<string>")
    )
    return (
        told.withColumn("problems", F.concat("problems", lost))
        .drop("_known")
        .filter(F.size("problems") > 0)
    )


# -------------------------------------------------------------- stored table --


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int").alias("bucket")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not is_folder(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(f"{LEDGER}, bucket int").parquet(path).select(*TYPES)


def write_ledger(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A new table of given bookings, one row per key."""
    placed = as_ledger(rows).select("*", _bucket(buckets))
    placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)


def bring_up_to_date(
    spark: SparkSession, path: str, claims: DataFrame, changes: DataFrame, buckets: int = BUCKETS
) -> None:
    """Fold claims and changes into the table at ``path``; only their buckets are rewritten.

    The new buckets are made whole in the shared folder first and then replace the old ones.
    ``buckets`` may not change during the life of a table.
    """
    keys = claims.select(KEY).unionAll(changes.select(KEY)).filter(F.col(KEY).isNotNull())
    touched = [r["bucket"] for r in keys.select(_bucket(buckets)).distinct().collect()]
    if not touched:
        return
    held = spark.createDataFrame([], LEDGER)
    if is_folder(spark, path):
        table = spark.read.schema(f"{LEDGER}, bucket int").parquet(path)
        held = table.filter(F.col("bucket").isin(touched)).select(*TYPES)
    after = ledger_after(held, claims, changes).select("*", _bucket(buckets))
    (
        stored(after, "ledger")
        .hint("rebalance", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(path)
    )


def oldest_first(ledger: DataFrame, offers: DataFrame) -> DataFrame:
    """Bookings of the given offers with their ``place`` among those of the offer, from 1."""
    order = Window.partitionBy("offer_id").orderBy("created_at", KEY)
    return bookings.for_offers(ledger, offers).withColumn("place", F.row_number().over(order))


# ------------------------------------------------------------ whole outcomes --


def outcomes(
    requests: DataFrame, latest: DataFrame, ledger: DataFrame, api_enabled: bool = False
) -> DataFrame:
    """Requests resolved as by ``bookings.book_requests``, with all that the caller is told.

    A new booking whose price rose is told by how much; one that goes ahead has its provider
    and, unless that holds seats itself, the link where the traveller finishes it.
    """
    told = bookings.book_requests(requests, latest, ledger)
    price = bookings.price_guard(requests, latest).select(
        "request_id", "offer_id", "quoted_price_ngn", "live_price_ngn", "status", "last_error"
    )
    quoted, live = F.col("quoted_price_ngn"), F.col("live_price_ngn")
    rise = F.format_string("%.1f", F.bround((live - quoted) / quoted * 100, 1))
    # Fixed text: what a caller is told of a fare that rose.
    risen = F.concat(
        F.lit("The fare has risen "), rise, F.lit("% since you saw it - from NGN "),
        F.format_number(F.bround(quoted), 0), F.lit(" to NGN "), F.format_number(F.bround(live), 0),
        F.lit(". Nothing was booked. Search again to accept the new price."),
    )
    routes = bookings.routing(latest, api_enabled).select("offer_id", "provider", "books_via_api")
    links = bookings.with_deep_link(latest).select("offer_id", "deep_link")
    ways = routes.join(links, "offer_id").select(
        "offer_id",
        F.col("provider").alias("_provider"),
        F.when(~F.col("books_via_api"), F.col("deep_link")).alias("_link"),
    )
    goes_ahead = F.col("is_new") & (F.col("state") == "pending")
    return (
        told.join(price, "request_id")
        .join(ways, "offer_id", "left")
        .select(
            "request_id", KEY, "offer_id", "is_new", "state",
            F.when(F.col("is_new") & (F.col("status") == "price_changed"), risen)
            .otherwise(F.col("detail"))
            .alias("detail"),
            "live_price_ngn",
            "last_error",
            F.when(goes_ahead, F.col("_provider")).alias("provider"),
            F.when(goes_ahead, F.col("_link")).alias("handoff_url"),
        )
    )


def changes_of(outcome: DataFrame, at: str = "at") -> DataFrame:
    """The changes an outcome makes to its own booking, as ``ledger_after`` takes them.

    A refused booking fails at the price of the moment; one that goes ahead has a provider.
    """
    new = outcome.filter("is_new")
    made = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), value.cast("string").alias("new_value"))
            for c, value in {
                "state": F.col("state"),
                "price_ngn_at_book": F.when(F.col("state") == "failed", F.col("live_price_ngn")),
                "provider": F.col("provider"),
                "last_error": F.when(F.col("state") == "failed", F.col("last_error")),
            }.items()
        ]
    )
    return (
        new.select(KEY, F.col(at).alias("at"), F.lit(0).alias("number"), F.inline(made))
        .filter(F.col("new_value").isNotNull())
    )
