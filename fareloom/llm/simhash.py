"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are dealt out by the bits they share with a possible partner: of four
16-bit blocks two at least are equal in any two fingerprints that differ in two bits or
fewer, so each fingerprint goes to six buckets, one per pair of blocks. (For a distance
d, d + 2 blocks in pairs.) A bucket's codes are sorted by Gray rank, which puts codes
with long common patterns side by side. Runs of neighbours get a node that holds the
bits all of them share, as a mask and a value; runs of nodes get nodes above. A search
walks down from the bucket's root, adds up the differences on the bits that each node
newly fixes and drops the whole group once they exceed the distance.

Equal fingerprints are one code, so thousands of copies are searched once. A bucket
returns a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fareloom.llm.common import appended, numbered, pieces, stored, words
from fareloom.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
FANOUT = 8
PART_BYTES = 1 << 20  # of text that is Python strings at once
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of every shingle's XXH64 (seed 42); no words: zero."""
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found).translate(_LOWER)
    if len(found) <= size:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[: len(found) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], ">u8")
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 4096):
        some = np.unpackbits(hashes[part : part + 4096].view(np.uint8)).reshape(-1, 64)
        ones += some.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")



def with_fingerprint(docs: DataFrame, name: str, text: str = "text", size: int = SHINGLE_WORDS):
    """``docs`` with the fingerprint as a signed 64-bit column ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, PART_BYTES):
            found = [fingerprint(t, size) for t in batch.column(text).to_pylist()]
            yield appended(batch, **{name: pa.array(np.array(found, np.uint64).view(np.int64))})

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in the reflected Gray sequence.

    As a signed long: the halves of the sequence swap, neighbours stay neighbours.
    """
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


def forest(bucket: np.ndarray, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes linked inside their bucket, each with the first code of its linked group.

    ``bucket`` is sorted; within a bucket ``codes`` are distinct and in Gray order.
    """
    n = len(codes)
    if not n:
        return codes, codes
    full = np.full(n, ~np.uint64(0))
    # levels[0] are the codes, levels[-1] one root per bucket: mask, value, children from..to.
    levels = [(full, codes, None, None, bucket)]
    while True:
        mask, value, _, _, of = levels[-1]
        new = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        rank = np.arange(len(of)) - np.repeat(new, np.diff([*new, len(of)]))
        if not rank.any():
            break
        begin = np.flatnonzero(rank % FANOUT == 0)
        size = np.diff([*begin, len(of)])
        parent = np.repeat(np.arange(len(begin)), size)
        unlike = (value ^ value[begin][parent]) | ~mask
        shared = ~np.bitwise_or.reduceat(unlike, begin)
        levels.append((shared, value[begin] & shared, begin, begin + size, of[begin]))
    if len(levels) == 1:
        return codes[:0], codes[:0]
    root_of = np.searchsorted(levels[-1][4], bucket)
    label = np.arange(n)
    work = [
        (len(levels) - 1, np.arange(s, min(s + 65536, n)), root_of[s : s + 65536], None)
        for s in range(0, n, 65536)
    ]
    while work:
        level, query, node, spent = work.pop()
        mask, value, begin, end, _ = levels[level]
        fresh = mask[node]
        if spent is not None:
            fresh = fresh & ~spent[1]
        differ = np.bitwise_count((codes[query] ^ value[node]) & fresh).astype(np.int64)
        if spent is not None:
            differ = differ + spent[0]
        near = differ <= distance
        query, node, differ = query[near], node[near], differ[near]
        if level == 0:
            ahead = query < node
            _unite(label, query[ahead], node[ahead])
            continue
        size = end[node] - begin[node]
        steps = max(1, int(np.ceil(size.sum() / 2_000_000)))
        for some in np.array_split(np.arange(len(node)), steps):
            if len(some):
                times = size[some]
                first = np.cumsum(times) - times
                child = np.arange(times.sum()) - np.repeat(first - begin[node[some]], times)
                held = (np.repeat(differ[some], times), np.repeat(mask[node[some]], times))
                work.append((level - 1, np.repeat(query[some], times), child, held))
    root = _roots(label)
    linked = np.flatnonzero(root != np.arange(n))
    return codes[linked], codes[root[linked]]


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the groups of a[i] and b[i] in place."""
    while len(a):
        label[:] = _roots(label)
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def links(codes: DataFrame, distance: int = MAX_BITS) -> DataFrame:
    """Distinct codes (a long column ``fp``) to links (a, b) that span each linked group."""
    blocks = distance + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]

    def block_mask(pair: tuple[int, ...]) -> int:
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in pair)
        return mask - (1 << 64) if mask >> 63 else mask

    keys = F.array(
        *[
            F.struct(F.lit(i).alias("w"), F.col("fp").bitwiseAND(F.lit(block_mask(p))).alias("k"))
            for i, p in enumerate(combinations(range(blocks), 2))
        ]
    )
    dealt = (
        codes.select("fp", gray_rank(F.col("fp")).alias("gray"), F.explode(keys).alias("key"))
        .select("fp", "gray", "key.w", "key.k")
        .repartition("w", "k")
        .sortWithinPartitions("w", "k", "gray")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def done(last: bool):
            nonlocal held, rows
            w, k, fp = (np.concatenate([h[i] for h in held]) for i in range(3))
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (k[1:] != k[:-1])])
            # The last bucket may go on in the next batch.
            stop = len(w) if last else int(np.flatnonzero(new)[-1])
            bucket, codes = np.cumsum(new)[:stop], fp[:stop].view(np.uint64)
            held, rows = [(w[stop:], k[stop:], fp[stop:])], len(w) - stop
            shared = np.flatnonzero(np.bincount(bucket)[bucket] > 1)  # alone: nothing to find
            a, b = forest(bucket[shared], codes[shared], distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("w", "k", "fp")))
            rows += batch.num_rows
            if rows >= 200_000:
                yield done(last=False)
        if rows:
            yield done(last=True)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every row's ``doc_id``, ``fingerprint`` and ``component_id``.

    Null and word-less texts have fingerprint zero and are linked like any other. Rows
    repeated under one id come back as often. A null id is never a component's smallest
    unless the component has no other; then the component's id is null. An empty table
    gives an empty result; further columns are ignored.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = stored(
        with_fingerprint(slim, "fp", size=options.get("size", SHINGLE_WORDS)).drop("text"), "prints"
    )
    roots = rooted(marked.select("fp").distinct(), options.get("distance", MAX_BITS))
    named = stored(
        marked.join(roots, "fp", "left").select(
            "doc_id", "fp", F.coalesce("root", "fp").alias("root")
        ),
        "named",
    )
    # Written first: a join splits a hot component only if neither side is made from the other's
    # shuffle.
    least = stored(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return named.join(least, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def rooted(codes: DataFrame, distance: int = MAX_BITS) -> DataFrame:
    """(fp, root) of the codes that have a link."""
    return components(links(codes, distance)).select(F.col("node").alias("fp"), "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component with all its columns: the smallest id (nulls last), then text.

    Fully repeated rows are copies, of which one stays. Columns may have any name.
    """
    given, name = numbered(docs)
    marked = with_fingerprint(given, "fp", name(text), options.get("size", SHINGLE_WORDS))
    marked = stored(marked, "marked")
    roots = rooted(marked.select("fp").distinct(), options.get("distance", MAX_BITS))
    named = marked.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    order = Window.partitionBy("root").orderBy(
        F.col(name(doc_id)).asc_nulls_last(), F.col(name(text)).asc_nulls_last()
    )
    best = named.withColumn("n", F.row_number().over(order)).where("n = 1")
    return best.select(*given.columns).toDF(*docs.columns)
