"""Reading carrier feeds, as files or from a message broker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.schemas import FEED_SCHEMAS


def topic(feed: str) -> str:
    if feed not in FEED_SCHEMAS:
        raise KeyError(f"unknown feed {feed!r}")
    return f"raw.{feed}"


def read_json(
    spark: SparkSession, feed: str, path: str, streaming: bool = False, strict: bool = False
) -> DataFrame:
    """A feed stored as JSON lines. ``strict`` stops on the first bad record.

    A file stream starts with every file already there.
    """
    reader = spark.readStream if streaming else spark.read
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return reader.schema(FEED_SCHEMAS[feed]).option("mode", mode).json(path)


def decode(messages: DataFrame, feed: str, value: str | Column = "value") -> DataFrame:
    """Message bodies (text or bytes) as the feed's columns."""
    body = F.col(value) if isinstance(value, str) else value
    parsed = F.from_json(body.cast("string"), FEED_SCHEMAS[feed])
    return messages.select(parsed.alias("_r")).select("_r.*")


def read_kafka(spark: SparkSession, feed: str, servers: str, streaming: bool = True) -> DataFrame:
    """A feed from its topic, replayed from the start. Needs the Kafka package."""
    reader = spark.readStream if streaming else spark.read
    messages = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic(feed))
        .option("startingOffsets", "earliest")
        .load()
    )
    return decode(messages, feed)
