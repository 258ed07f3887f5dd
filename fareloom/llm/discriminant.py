"""Quality score by a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics. Per class, one pass of partial
sums gives the mean and the covariance, which is shrunk towards the pooled covariance
and a multiple of the identity. The score is the logistic of the difference of the two
log densities, with squared Mahalanobis distances from Cholesky factors that are
computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, prepare, stored, words
from fareloom.llm.ngrams import repeated_lines, repeated_words

STATISTICS = (
    "words",
    "word length",
    "symbols",
    "exclamations",
    "stops",
    "capitals",
    "digits",
    "repeated lines",
    "words of repeated windows",
    "equal neighbours",
    "distinct words",
    "words a line",
)
POOLED = 0.3  # share of the pooled covariance in each class covariance
RIDGE = 0.02  # share of the identity, scaled by the mean variance
PART_BYTES = 1 << 20

# Kinds of bytes: other, capital, digit, symbol, exclamation, stop, line break.
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[list(b"#*$%&|<>{}[]^~_=\\@+")] = 3
_KIND[list(b"!?")] = 4
_KIND[list(b".,;:")] = 5
_KIND[10] = 6


def statistics(text: str | None) -> list[float]:
    """Transformed so that they are nearer to normal: logarithms and square roots of shares."""
    found = words(text)
    if not found:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=7) / len(raw)
    n = len(found)
    equal = sum(map(bytes.__eq__, found, found[1:]))
    lines = text.count("\n") + 1
    return [
        np.log1p(n),
        np.log(sum(map(len, found)) / n),
        *np.sqrt(kinds[[3, 4, 5, 1, 2]]).tolist(),
        np.sqrt(repeated_lines(text) / lines),
        np.sqrt(repeated_words(found) / n),
        np.sqrt(equal / n),
        np.sqrt(len(set(found)) / n),
        np.log1p(n / lines),
    ]


def described(docs: DataFrame) -> DataFrame:
    """doc_id, empty and the vector ``x`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PART_BYTES):
            rows = [statistics(t) for t in batch.column("text").to_pylist()]
            x = np.array(rows, np.float64).reshape(-1, len(STATISTICS))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))],
                names=["doc_id", "x"],
            )

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id bigint, x array<double>")


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a partition's vectors (with a leading 1) and of their products, by label."""
    d = len(STATISTICS) + 1
    sums = np.zeros((2, d, d))
    for batch in batches:
        x = np.asarray(batch.column("x").flatten()).reshape(-1, d - 1)
        x = np.hstack([np.ones((len(x), 1)), x])
        label = batch.column("label").to_numpy()
        for k in (0, 1):
            own = x[label == k]
            sums[k] += own.T @ own
    k, i = np.divmod(np.arange(sums.size), d * d)
    yield pa.RecordBatch.from_arrays(
        [pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(sums.ravel())],
        names=["label", "i", "total"],
    )


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and constants of the two classes."""

    means: np.ndarray
    whiteners: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = []
        for mean, whiten, constant in zip(self.means, self.whiteners, self.constants):
            z = (x - mean) @ whiten.T
            logs.append(constant - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -600, 600)))


def discriminant(sums: np.ndarray) -> Discriminant | None:
    """From each class's sum of (1, x)(1, x)'; None if a class has no document."""
    n = sums[:, 0, 0]
    if not n.all():
        return None
    means = sums[:, 0, 1:] / n[:, None]
    scatter = sums[:, 1:, 1:] - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / n.sum()
    d = len(pooled)
    ridge = RIDGE * max(np.trace(pooled) / d, 1e-9)
    whiteners, constants = [], []
    for k in (0, 1):
        cov = (1 - POOLED) * scatter[k] / n[k] + POOLED * pooled + ridge * np.eye(d)
        factor = np.linalg.cholesky((cov + cov.T) / 2)
        whiteners.append(np.linalg.inv(factor))
        constants.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(whiteners), np.array(constants))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(vectors: DataFrame, labels: DataFrame) -> Discriminant | None:
    """From the labelled vectors that are not held out.

    A document labelled twice counts as bad if one label says so; null labels and ids
    take no part. All labelled rows are used.
    """
    known = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("label"))
        .where(~held_out(F.col("doc_id")))
    )
    rows = (
        vectors.join(known, "doc_id")
        .select("label", "x")
        .mapInArrow(_partial, "label int, i int, total double")
        .groupBy("label", "i")
        .agg(F.sum("total").alias("total"))
        .collect()  # two squares of the number of statistics
    )
    d = len(STATISTICS) + 1
    sums = np.zeros((2, d * d))
    for r in rows:
        sums[r["label"], r["i"]] = r["total"]
    return discriminant(sums.reshape(2, d, d))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row's doc_id, held_out, score and predicted.

    Null and empty texts have the vector of no words and are scored like any other. Rows
    come back as often as given. A null id is not held out and never learned from.
    Without labels of both classes every score is 0.5. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    vectors = stored(described(docs), "vectors")
    model = fit(vectors, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, len(STATISTICS))
            score = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"]
            )

    return vectors.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
