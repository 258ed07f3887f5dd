"""Importance resampling towards a target distribution of hashed word n-grams.

Features are runs of 1 to 3 words, hashed by CRC32 into buckets. One pass counts the
buckets of the corpus and of the target, a second sums the gain of every feature of a
document, and Gumbel noise made from the document's id turns the sums into a draw
without replacement.

Both passes run Arrow kernels on whole batches: ``ascii_lower``, ``split_pattern_regex``
and ``list_flatten`` give words, ``dictionary_encode`` gives word indices, a shifted copy
of them gives n-grams as pairs (shorter n-gram, next word), which are dictionary-encoded
again, so that only distinct pairs are hashed. ``take`` brings a pair's bucket or gain back
to its places and a sum per segment ends at the document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import partitions, pieces, prepare, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 3  # words of a feature
BUCKETS = 10000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PART_BYTES = 4 << 20
_SHORT = 256  # appended lengths below this are hashed by table, longer ones by zlib


def _zero_bytes(longest: int) -> np.ndarray:
    """[n, k, b]: what byte k of a CRC, of value b, becomes when n zero bytes follow."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    out = np.empty((longest, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, longest):
        out[n] = (out[n - 1] >> 8) ^ table[out[n - 1] & 255]
    return out


_ZEROS = _zero_bytes(_SHORT)


@dataclass
class Words:
    """The words of a batch of texts: distinct ones, and where each stands."""

    distinct: list[bytes]
    at: np.ndarray  # the index in ``distinct`` of every word
    doc: np.ndarray  # the row every word belongs to
    counts: np.ndarray  # words of every row


def words_of(texts: pa.Array) -> Words:
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    flat, doc = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(flat), 0)  # a text may begin or end with a separator
    flat, doc = flat.filter(real), doc.filter(real).to_numpy().astype(np.int64)
    coded = flat.dictionary_encode()
    return Words(
        coded.dictionary.cast(pa.binary()).to_pylist(),
        coded.indices.to_numpy().astype(np.int64),
        doc,
        np.bincount(doc, minlength=len(texts)),
    )


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: CRC32 of the distinct ones, index and row of each."""
    if not words.distinct:
        return
    crc = np.array([zlib.crc32(w) for w in words.distinct], np.uint32)
    yield crc, words.at, words.doc
    tails = [b" " + w for w in words.distinct]
    tail_crc = np.array([zlib.crc32(t) for t in tails], np.uint32)
    lengths = np.array([len(t) for t in tails], np.int64)
    at, doc, texts = words.at, words.doc, None
    for n in range(2, LONGEST + 1):
        # The run of n - 1 words at i and the word at i + n - 1, both of one row.
        inside = words.doc[n - 1 :] == doc[: len(words.doc) - n + 1]
        shorter, next_word = at[: len(inside)], words.at[n - 1 :]
        pair = np.where(inside, shorter * len(tails) + next_word, -1)
        coded = pa.array(pair).dictionary_encode()
        distinct = coded.dictionary.to_numpy()
        first, last = distinct // len(tails), distinct % len(tails)
        made = tail_crc[last].copy()
        old = crc[first]
        shift = np.minimum(lengths[last], _SHORT - 1)
        for k in range(4):
            made ^= _ZEROS[shift, k, (old >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(lengths[last] >= _SHORT):
            made[i] = zlib.crc32(tails[last[i]], int(old[i]))
        at, doc, crc = coded.indices.to_numpy().astype(np.int64), doc[: len(inside)], made
        yield crc, at[inside], doc[inside]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts. A task sends a row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in pieces(batches, "text", PART_BYTES):
            for crc, at, _ in features(words_of(batch.column("text"))):
                each = np.bincount(at, minlength=len(crc))
                n += np.bincount(crc % buckets, each, buckets).astype(np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])

    found = docs.select("text").mapInArrow(count, "bucket bigint, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths: log of target share over corpus share."""

    def counts(texts: DataFrame) -> list[int]:
        out = [0] * buckets
        for row in bucket_counts(texts, buckets).collect():  # a row per bucket
            out[row["bucket"]] = row["n"]
        return out

    s, t = counts(docs), counts(target)
    up, down = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array(
        [math.floor(1000 * math.log((b + 1) * up / ((a + 1) * down))) for a, b in zip(s, t)],
        np.float64,
    )


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PART_BYTES):
            words = words_of(batch.column("text"))
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for crc, at, doc in features(words):
                # Whole numbers far below 2**53: sums of doubles are exact in any order.
                total += np.bincount(doc, gain[crc % len(gain)][at], batch.num_rows)
                n += np.bincount(doc, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(n),
                    pa.array(total.astype(np.int64)),
                ],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def _ranked(rows: DataFrame, most: int) -> DataFrame:
    """Rows with their place by falling score, smaller doc_id first; null beyond ``most``.

    Rows are dealt by range and sorted within their part; the parts' sizes give where each
    part's numbers begin, so no task sorts the whole table.
    """
    parts = partitions(rows.sparkSession)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Where ids and scores repeat without end, the other columns share the rows out.
    spread = F.xxhash64(*rows.columns, F.monotonically_increasing_id())
    dealt = (
        rows.withColumn("spread", spread)
        .repartitionByRange(parts, *order, "spread")
        .sortWithinPartitions(*order, "spread")
        .drop("spread")
        .withColumn("place", F.monotonically_increasing_id())
    )
    # That number is the part, shifted by 33 bits, and the row's place in it.
    dealt = stored(dealt, "dealt")
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(  # a row per part
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin")
    )
    rank = F.col("begin") + F.col("place") + 1
    return (
        dealt.withColumns({"part": part, "place": place})
        .join(begins, "part")
        .withColumn("rank", F.when(rank <= most, rank))
        .drop("part", "place", "begin")
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``.

    ``docs`` and ``target`` need a text, ``docs`` a doc_id; other columns are not read. A
    null or empty text has no feature and weighs 0. A null id takes its noise from an empty
    text and comes last among equal scores. Repeated rows each count, and each has a rank of
    its own; their noise is that of their id. Rows of fewer than ``least_words`` words are
    scored, never drawn. An empty target or corpus is a distribution of no features; an
    empty corpus gives no row.
    """
    spark = prepare(docs.sparkSession)
    gain = gains(docs, target, buckets)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stored(
        weighed(docs, gain).withColumn("score", (F.col("weight") + noise).cast("bigint")), "scored"
    )
    able = F.col("n_words") >= least_words
    most = percent * scored.where(able).count() // 100
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return _ranked(scored.where(able), most).unionByName(rest)


def query(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
