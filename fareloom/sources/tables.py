"""Stored tables: the price history, the latest offers, bulk loads.

History is laid out by UTC fetch day, the column every time filter can prune
on. Latest offers are laid out by route, so one route reads one directory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.contract import history_problems
from fareloom.operators.history import KEY, facts, new_facts
from fareloom.sources.schemas import HISTORY, OFFER_COLUMNS as HISTORY_COLUMNS

DAY = "fetch_day"


def read_history(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """History, with the day filter applied to the directories as well."""
    table = spark.read.schema(f"{HISTORY}, {DAY} date").parquet(path)
    if since is not None:
        table = table.filter((F.col(DAY) >= F.to_date(since)) & (F.col("fetched_at") >= since))
    return table.select(*HISTORY_COLUMNS)


def as_history(rows: DataFrame) -> DataFrame:
    """Exactly the stored columns, in their stored types."""
    types = {"price_ngn": "decimal(12,2)", "duration_min": "int", "seats_left": "int",
             "depart_time": "timestamp", "fetched_at": "timestamp"}
    return rows.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in HISTORY_COLUMNS]
    )


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def _days_of(rows: DataFrame) -> list:
    """The distinct UTC days of the rows: as many values as the calendar has."""
    return [r["day"] for r in rows.select(F.to_date("fetched_at").alias("day")).distinct().collect()]


def _held(spark: SparkSession, path: str, days: list) -> DataFrame | None:
    """The stored facts of those days, read from their folders only."""
    if not is_folder(spark, path):
        return None
    stored = spark.read.schema(f"{HISTORY}, {DAY} date").parquet(path)
    return stored.filter(F.col(DAY).isin(days)).select(*HISTORY_COLUMNS)


def conflicts(arrivals: DataFrame, path: str) -> DataFrame:
    """Keys whose deliveries disagree, among themselves or with the stored history.

    One row per key with the smallest fact, the deliveries counted and ``conflicting``.
    """
    fresh = as_history(arrivals)
    days = _days_of(fresh)
    held = _held(arrivals.sparkSession, path, days) if days else None
    seen = fresh
    if held is not None:
        touched = held.join(fresh.select(*KEY).distinct(), KEY, "left_semi")
        seen = fresh.unionByName(as_history(touched))
    return facts(seen).filter("conflicting")


def append_history(arrivals: DataFrame, path: str) -> None:
    """Append the facts the history does not hold. Redelivery changes nothing.

    A row the table may not hold stops the append before anything is written. The
    arrivals are computed once, and only the days they touch are read back. Where a fact
    disagrees with a stored one, the stored one stays; ``conflicts`` lists such keys.
    """
    spark = arrivals.sparkSession
    fresh = as_history(arrivals).persist()  # spills to disk
    try:
        refused = fresh.filter(F.size(history_problems()) > 0).count()
        if refused:
            raise ValueError(f"{refused} rows break the rules of the history table")
        days = _days_of(fresh)
        if not days:
            return
        held = _held(spark, path, days)
        new = new_facts(fresh.limit(0) if held is None else held, fresh)
        # Rebalancing gathers the rows of a small day and splits those of a large one.
        new.withColumn(DAY, F.to_date("fetched_at")).hint("rebalance", DAY).write.mode(
            "append"
        ).partitionBy(DAY).parquet(path)
    finally:
        fresh.unpersist()


def write_latest(latest: DataFrame, path: str) -> None:
    route = ["origin", "destination"]
    latest.hint("rebalance", *route).write.mode("overwrite").partitionBy(*route).parquet(path)


def route_latest(latest: DataFrame, origin: str, destination: str) -> DataFrame:
    return latest.filter(
        (F.col("origin") == origin) & (F.col("destination") == destination)
    )


def read_tsv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A tab-separated history export. A malformed line stops the load."""
    return (
        spark.read.schema(HISTORY)
        .option("sep", "\t")
        .option("mode", "FAILFAST" if strict else "DROPMALFORMED")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")
        .csv(path)
    )


def write_tsv(history: DataFrame, path: str) -> None:
    (
        as_history(history)
        .write.option("sep", "\t")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )
