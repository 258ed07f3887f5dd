"""The latest offer of every departure as a kept table, continuously brought up to date.

Each micro-batch brings the offers whose latest price may have changed, from a running
aggregate in update mode. A batch is written as a small delta, and every few batches the
deltas are merged into a new version of the base. All of it is laid out by a hash of the
offer id, so a look-up of some offers reads their buckets only.

``<path>/base/version=V``    the whole state after batch V
``<path>/delta/batch=N``     what batch N changed
``<path>/current/version=V`` written last: base V is complete, later deltas come on top

A batch that is repeated after a failure rewrites its own delta, and its own version if it
merges; readers follow ``current`` and never see a half-written version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.functions import times
from fareloom.operators import history as hist
from fareloom.sources.schemas import OFFER, OFFER_COLUMNS
from fareloom.sources.tables import is_folder
from fareloom.streaming.flows import running_latest

BUCKETS = 64
MERGE_EVERY = 8
_ROW = f"{OFFER}, observed_at timestamp, bucket int"


def _bucket(offer_id, buckets: int):
    return F.pmod(F.xxhash64(offer_id), F.lit(buckets)).cast("int")


def write_state(
    offers: DataFrame,
    path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    merge_every: int = MERGE_EVERY,
    once: bool = False,
) -> StreamingQuery:
    """Keep the table at ``path`` in step with the stream.

    ``buckets`` may not change during the life of a table.
    """

    def bring(batch: DataFrame, number: int) -> None:
        stamped = batch.withColumns(
            {
                "observed_at": times.instant(F.col("fetched_at")),
                "bucket": _bucket(F.col("offer_id"), buckets),
            }
        )
        _write(stamped, f"{path}/delta/batch={number}")
        if (number + 1) % merge_every == 0:
            merge(batch.sparkSession, path, number)

    writer = (
        running_latest(offers)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(bring)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _write(rows: DataFrame, target: str) -> None:
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)


def _version(spark: SparkSession, path: str) -> int:
    """The newest complete base, -1 if there is none. Reads one small folder."""
    if not is_folder(spark, f"{path}/current"):
        return -1
    rows = spark.read.schema("upto bigint, version bigint").parquet(f"{path}/current")
    return rows.agg(F.max("upto")).first()[0]


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Base and the deltas after it, as rows that may repeat an offer."""
    version = _version(spark, path)
    rows = None
    if version >= 0:
        rows = spark.read.schema(_ROW).parquet(f"{path}/base/version={version}")
    if is_folder(spark, f"{path}/delta"):
        deltas = spark.read.schema(f"{_ROW}, batch bigint").parquet(f"{path}/delta")
        deltas = deltas.filter(F.col("batch") > version)
        if upto is not None:
            deltas = deltas.filter(F.col("batch") <= upto)
        deltas = deltas.drop("batch")
        rows = deltas if rows is None else rows.unionByName(deltas)
    return spark.createDataFrame([], _ROW) if rows is None else rows


def merge(spark: SparkSession, path: str, upto: int) -> None:
    """A new base from the old one and the deltas up to a batch.

    Offers are grouped within their bucket; each task keeps one row per offer before the
    shuffle, and an older observation cannot replace a newer one.
    """
    if _version(spark, path) >= upto:
        return
    merged = hist.newest(_parts(spark, path, upto), ["bucket", "offer_id"], "observed_at")
    _write(merged, f"{path}/base/version={upto}")
    mark = spark.createDataFrame([(upto,)], "upto bigint")
    mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/current/version={upto}")


def read_state(
    spark: SparkSession, path: str, offer_ids: list[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The latest offers, all or those asked for; of those only their buckets are read."""
    rows = _parts(spark, path)
    if offer_ids is not None:
        asked = spark.createDataFrame([(i,) for i in offer_ids], "offer_id string")
        wanted = [r["b"] for r in asked.select(_bucket(F.col("offer_id"), buckets).alias("b")).distinct().collect()]
        rows = rows.filter(F.col("bucket").isin(wanted) & F.col("offer_id").isin(offer_ids))
    return hist.newest(rows, ["bucket", "offer_id"], "observed_at").select(*OFFER_COLUMNS)
