"""What the operators of this subpackage share: tables, words, batches, stored results."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import stored

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# A word is a run of anything but ASCII white space; bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch: long texts must not add up to a batch beyond a task's memory.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and this library on the path of the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            [ROOT, *[p for p in paths if p]]
        )
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, from which group counts follow."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def numbered(docs: DataFrame) -> tuple[DataFrame, Callable[[str], str]]:
    """The same columns named c0, c1, ..., and what a given name is called now.

    No name that an operator adds is among them, whatever the table's own names are.
    """
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), lambda c: f"c{names.index(c)}"


def unused(docs: DataFrame, prefix: str) -> str:
    """``prefix``, lengthened until no column's name begins with it."""
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(
            pa.compute.cast(pa.compute.binary_length(batch.column(text)), pa.int64()), 0
        ).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


__all__ = [
    "BATCH_ROWS",
    "WORD",
    "appended",
    "numbered",
    "partitions",
    "pieces",
    "prepare",
    "stored",
    "table",
    "text_bytes",
    "unused",
    "words",
]
