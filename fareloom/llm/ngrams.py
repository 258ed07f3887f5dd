"""Quality rules: base rules on words and lines, then a hashed n-gram classifier.

The classifier is a logistic regression over hashed word 1- and 2-grams and
2-, 3- and 4-grams of characters (code points). A feature is the share of its bucket among the document's n-grams
of that kind, so long and short texts are scored alike. It is fitted on labelled rows,
calibrated on others by Platt's method, and applied in Arrow batches. A document stays
if it passes the base rules and its calibrated probability reaches a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from fareloom.llm.common import appended, pieces, prepare, words
from fareloom.llm.hashing import words_of
from fareloom.session import new_path

BITS = 15
KINDS = ("word 1", "word 2", "char 2", "char 3", "char 4")
SCALE = 10.0
LABELLED_ROWS = 6000  # the bound of the sample the classifier is fitted on
THRESHOLD = 0.5
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
PART_BYTES = 1 << 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(found: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice, the first included."""
    windows = list(zip(found, found[1:], found[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def base_counts(text: str | None, found: list[bytes]) -> tuple[int, ...]:
    if not text:
        return (0, 0, 0, 0, 0)
    return (
        len(found),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines(text),
        repeated_words(found),
    )


def base_fails(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def characters(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every UTF-8 character, made of its bytes, and where each begins."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    chars = raw[lead].astype(np.uint32)
    if len(lead) < len(raw):
        length = np.diff(lead, append=len(raw))
        for k in (1, 2, 3):
            longer = np.flatnonzero(length > k)
            chars[longer] = (chars[longer] << np.uint32(8)) | raw[lead[longer] + k]
    return chars, lead


def buckets(split: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: the bucket of every n-gram, and each document's number.

    A document's n-grams of a kind stand together, documents in order.
    """
    found = words_of(split)
    n = len(split)
    of_word = np.repeat(np.arange(n), found.counts)
    shift = np.uint64(64 - BITS)
    for size in (1, 2):
        at, h = found.windows(size)
        yield (h >> shift).astype(np.int64), np.bincount(of_word[at], minlength=n)
    # Characters with one space between words. No n-gram crosses a line break, which parts
    # documents.
    chars, lead = characters(found.buffer)
    first = np.zeros(n, np.int64)
    sizes = np.zeros(n, np.int64)
    full = found.counts > 0
    first[full] = np.searchsorted(lead, found.starts[found.first[full]])
    sizes[full] = np.searchsorted(lead, found.ends[(found.first + found.counts - 1)[full]])
    sizes -= first
    code = chars
    for size in (2, 3, 4):
        code = code[:-1] * np.uint32(2246822519) + chars[size - 1 :] if len(code) else code
        h = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        counts = np.maximum(sizes - size + 1, 0)
        whole = counts.sum()
        if whole == len(h):
            yield h, counts
            continue
        keep = np.ones(len(h), bool)
        for k in range(size):  # n-grams that hold the break after a document
            spot = (first + sizes - k)[full]
            spot = spot[(spot >= 0) & (spot < len(h))]
            keep[spot[chars[spot + k] == 10] if k else spot] = False
        yield h[keep], counts


def margins(weights: np.ndarray, split: list[list[bytes]]) -> np.ndarray:
    total = np.zeros(len(split))
    for kind, (h, counts) in enumerate(buckets(split)):
        if not len(h):
            continue
        value = np.take(weights[kind], h)
        some = np.flatnonzero(counts)
        begin = (np.cumsum(counts) - counts)[some]
        total[some] += SCALE * np.add.reduceat(value, begin) / counts[some]
    return total


def features(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    at, value = [], []
    for kind, (h, _) in enumerate(buckets([found])):
        if len(h):
            some, times = np.unique(h, return_counts=True)
            at.append(some.astype(np.int64) + (kind << BITS))
            value.append(SCALE * times / len(h))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(at), np.concatenate(value)


@dataclass
class Model:
    """Weights by kind and bucket, and the calibrated line over the margin."""

    weights: np.ndarray
    slope: float
    intercept: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.intercept, -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model | None:
    """A model from at most ``rows`` labelled documents, chosen by a hash of the id.

    ``docs`` and ``labels`` share doc_id; a document labelled both ways counts as bad.
    Rows without a label or with a null id take no part. None if a class is missing.
    """
    spark = prepare(docs.sparkSession)
    chosen = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("double")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    size = len(KINDS) << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PART_BYTES):
            found = [features(words(t)) for t in batch.column("text").to_pylist()]
            sparse = [
                pa.array(np.zeros(len(found), np.int8)),  # 0 marks a sparse vector
                pa.array(np.full(len(found), size, np.int32)),
                pa.array([at.astype(np.int32) for at, _ in found], pa.list_(pa.int32())),
                pa.array([value for _, value in found], pa.list_(pa.float64())),
            ]
            vectors = pa.StructArray.from_arrays(sparse, VectorUDT.sqlType().names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("held"), vectors],
                names=["label", "held", "features"],
            )

    # Vectors are written as the struct they are stored as and read back as vectors, so that
    # everything after the n-grams stays in the JVM.
    sample = sample.select(
        "text", "label", (F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)) == 0).alias("held")
    )
    kinds = [StructField("label", DoubleType()), StructField("held", BooleanType())]
    path = new_path(spark, "grams")
    sample.mapInArrow(
        run, StructType([*kinds, StructField("features", VectorUDT.sqlType())])
    ).write.parquet(path)
    folded = spark.read.schema(
        StructType([*kinds, StructField("features", VectorUDT())])
    ).parquet(path)
    train, rest = folded.where("not held"), folded.where("held")
    if min(x.select("label").distinct().count() for x in (train, rest)) < 2:
        return None
    learner = LogisticRegression(maxIter=40, regParam=2e-4, standardization=False)
    fitted = learner.fit(train.repartition(24))  # small parts: less memory in a task
    weights = fitted.coefficients.toArray()
    margin = vector_to_array("rawPrediction")[1] - F.lit(float(fitted.intercept))
    line = LogisticRegression(maxIter=100, regParam=1e-3).fit(
        fitted.transform(rest).select("label", array_to_vector(F.array(margin)).alias("features"))
    )
    return Model(
        weights.reshape(len(KINDS), -1).astype(np.float32),
        float(line.coefficients[0]),
        float(line.intercept),
    )


RESULT = [
    *[StructField(c, LongType()) for c in BASE],
    StructField("base_failed", BooleanType()),
    StructField("probability", DoubleType()),
    StructField("kept", BooleanType()),
]


def judged(
    docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, prefix: str = ""
) -> DataFrame:
    """``docs`` with the base counts, base_failed, probability and kept, names prefixed.

    A null text has no words and fails the base rules, as does an empty one. Every row is
    judged alone, so repeated rows and null ids are no special case. Without a model the
    base rules decide and the probability is null. Given columns of the results' names
    give way to them; ``prefix`` keeps both.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    names = [prefix + f.name for f in RESULT]
    clash = {n for n in names if n in docs.columns}
    docs = docs.drop(*clash)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in pieces(batches, "text", PART_BYTES):
            texts = batch.column("text").to_pylist()
            split = [words(t) for t in texts]
            counts = np.array(
                [base_counts(t, w) for t, w in zip(texts, split)], np.int64
            ).reshape(-1, len(BASE))
            failed = base_fails(counts[:, 0], counts[:, 4])
            if own is None:
                score, good = pa.nulls(len(texts), pa.float64()), ~failed
            else:
                p = own.probability(margins(own.weights, split))
                score, good = pa.array(p), ~failed & (p >= threshold)
            columns = [*counts.T, failed]
            made = [*[pa.array(np.ascontiguousarray(c)) for c in columns], score, pa.array(good)]
            yield appended(batch, **dict(zip(names, made)))

    fields = [StructField(n, f.dataType) for n, f in zip(names, RESULT)]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
