"""The batch operators on unbounded feeds.

Each flow keeps its progress in a checkpoint, so a restart or a lost executor
resumes without repeating what is already written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.functions import times
from fareloom.operators import history as hist
from fareloom.operators.contract import history_problems
from fareloom.operators.normalise import to_history, unify, unify_messages
from fareloom.sources import tables
from fareloom.sources.schemas import OFFER, OFFER_COLUMNS


def union_feeds(feeds: Mapping[str, DataFrame], unknown_place: str | None = "PHC") -> DataFrame:
    """The eight feeds as one stream of canonical offers; stateless, append only."""
    return unify(feeds, unknown_place)


def union_messages(messages: DataFrame, unknown_place: str | None = "PHC") -> DataFrame:
    """The same from one stream of messages that name their feed: the source is read once."""
    return unify_messages(messages, unknown_place)


def running_latest(offers: DataFrame) -> DataFrame:
    """Latest offer per departure as a running aggregate (update or complete mode)."""
    observed = times.instant(F.col("fetched_at")).alias("at")
    best = F.max(F.struct(observed, F.struct(*OFFER_COLUMNS).alias("row")))
    return offers.groupBy("offer_id").agg(best.alias("best")).select("best.row.*")


def each_batch(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], once: bool = False
) -> StreamingQuery:
    """Run ``each`` on every micro-batch and its number. A batch that failed keeps its number.

    A restart repeats a batch that was not finished, with the same rows, so what ``each``
    writes under the batch's number is written once.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_history(
    offers: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Append the stream to the history table, each fact once, however late it comes.

    There is no watermark: what the table already holds decides what is new.
    A row the table may not hold stops the stream, unless ``quarantine`` names a
    place for it. Keys whose deliveries disagree are listed beside it, under
    ``<quarantine>-conflicts``; the history then keeps one of them.
    """

    def append(batch: DataFrame, number: int) -> None:
        # Read several times: to set rows aside, for their days, and to append.
        rows = to_history(batch).withColumn("problems", history_problems()).persist()
        try:
            good = rows
            if quarantine:
                slot = f"batch={number}"
                good = rows.filter(F.size("problems") == 0)
                rows.filter(F.size("problems") > 0).write.mode("overwrite").parquet(
                    f"{quarantine}/{slot}"
                )
                conflicts = tables.conflicts(good.drop("problems"), path)
                conflicts.write.mode("overwrite").parquet(f"{quarantine}-conflicts/{slot}")
            tables.append_history(good, path)
        finally:
            rows.unpersist()

    return each_batch(offers, checkpoint, append, once)


def write_latest(
    offers: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write each batch's latest offers as its own slice under ``path``.

    A batch costs its own size, not the size of the state. A repeated batch
    rewrites its own slice, so it changes nothing.
    """

    def slice_of(batch: DataFrame, number: int) -> None:
        stamped = batch.withColumn("observed_at", times.instant(F.col("fetched_at")))
        hist.latest_offers(stamped, "observed_at").write.mode("overwrite").parquet(
            f"{path}/batch={number}"
        )

    return each_batch(offers, checkpoint, slice_of, once)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Latest offers over all slices; an old replay cannot undo a newer price."""
    slices = spark.read.schema(f"{OFFER}, observed_at timestamp").parquet(path)
    return hist.latest_offers(slices, "observed_at").select(*OFFER_COLUMNS)


def compact_latest(spark: SparkSession, path: str, target: str) -> None:
    """Merge all slices into the single slice of a new table."""
    slices = spark.read.schema(f"{OFFER}, observed_at timestamp").parquet(path)
    hist.latest_offers(slices, "observed_at").write.mode("overwrite").parquet(
        f"{target}/batch=0"
    )


def write_offers(
    offers: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """The canonical offers as Parquet files, exactly once."""
    writer = (
        offers.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_topic(offers: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    """The canonical offers as JSON on the ``offers`` topic. Needs the Kafka package."""
    messages = offers.select(
        F.col("offer_id").alias("key"), F.to_json(F.struct(*OFFER_COLUMNS)).alias("value")
    )
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", "offers")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
