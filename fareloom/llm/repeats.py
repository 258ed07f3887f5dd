"""Removal of long repeated word sequences through fixed-block anchors.

A window of ``2 * block - 1`` words holds one whole aligned block of its document,
whatever its offset. So it is enough to index the aligned, non-overlapping blocks and to
probe the index with every rolling window of block length: two equal windows always meet
in an indexed block. A block that nothing else meets ends there. Where something does,
the hits are extended to the windows around them, and those are compared by their own
hash, so a repeat comes out at its full length.

Documents are dealt into groups of two megabytes or so and hashes into buckets. A group
counts its own repeats first and sends each bucket one row with its distinct hashes, and
the bucket answers with one bit per hash. No position travels, no pair is made, and a
passage in every document costs a bucket one hash per group, however often the group
holds it. The exchange of the documents is used three times: to probe, to extend and to
remove.

Probe hashes have 32 bits beside the bucket; a false hit only offers windows that the
extension refuses. Windows are compared by 64 bits and a bucket taken from another hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareloom.llm.common import numbered, partitions, prepare, stored, text_bytes, words
from fareloom.llm.hashing import Words, words_of

WINDOW = 35
GROUP_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20  # of text, whose hashes meet in one bucket
PART_BYTES = 1 << 19
ROW_BYTES = 200  # of a row beside its text, about
COPIES = 4096  # rows that one row worked on may stand for

MESSAGE = "bucket int, g int, kind int, hashes binary, many binary, marks binary"


def _ordered(table: pa.Table, text: str) -> pa.Table:
    """Rows in the same order in every pass; rows that tie have the same words."""
    return table.sort_by([("__k", "ascending"), (text, "ascending")])


def _parts(table: pa.Table, text: str) -> Iterator[tuple[list[list[bytes]], Words]]:
    """The group's documents as words, a megabyte at a time."""
    part, held = [], 0
    for value in table.column(text):
        found = words(value.as_py())
        part.append(found)
        held += sum(map(len, found)) + len(found)
        if held >= PART_BYTES:
            yield part, words_of(part)
            part, held = [], 0
    if part:
        yield part, words_of(part)


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _runs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the places, buckets in a row, and where in it each distinct place begins."""
    order = np.argsort(place, kind="stable")
    told = place[order]
    return order, np.flatnonzero(np.r_[True, told[1:] != told[:-1]][: len(told)])


def _packed(bits: np.ndarray, edges: np.ndarray, full: np.ndarray) -> pa.Array:
    return pa.array(
        [np.packbits(bits[edges[b] : edges[b + 1]]).tobytes() for b in full], pa.binary()
    )


def _sent(g: int, kind: int, place: np.ndarray, values: np.ndarray, marks, n: int) -> pa.Table:
    """One row per bucket: its distinct values, which of them occur more than once in the
    group, and which are marked anywhere in it. ``place`` tells the bucket and the order."""
    order, begins = _runs(place)
    edges = np.searchsorted(_buckets(place[order[begins]], n), np.arange(n + 1))
    values = values[order[begins]]
    many = np.diff(np.r_[begins, len(order)]) > 1
    full = np.flatnonzero(np.diff(edges))
    if marks is None:
        told = pa.nulls(len(full), pa.binary())
    else:
        some = np.logical_or.reduceat(marks[order], begins) if len(begins) else marks
        told = _packed(some, edges, full)
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "g": pa.array(np.full(len(full), g), pa.int32()),
            "kind": pa.array(np.full(len(full), kind), pa.int32()),
            "hashes": pa.array([values[edges[b] : edges[b + 1]].tobytes() for b in full], "binary"),
            "many": _packed(many, edges, full),
            "marks": told,
        }
    )


def _received(answers: pa.Table, kind: int, place: np.ndarray, n: int) -> np.ndarray:
    """The buckets' bits, back in reading order; a bucket that found nothing sent nothing."""
    order, begins = _runs(place)
    edges = np.searchsorted(_buckets(place[order[begins]], n), np.arange(n + 1))
    hit = np.zeros(len(begins), bool)
    for b, k, bits in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "marks"))):
        if k == kind:
            hit[edges[b] : edges[b + 1]] = _bits(bits, edges[b + 1] - edges[b])
    found = np.zeros(len(order), bool)
    found[order] = np.repeat(hit, np.diff(np.r_[begins, len(order)]))
    return found


def _bits(packed: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=count).astype(bool)


class Repeats:
    """The passes over one table, with ``parts`` buckets of hashes."""

    def __init__(self, text: str, window: int, parts: int):
        self.text, self.window, self.parts = text, window, parts
        self.block = (window + 1) // 2

    def _probes(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        return found.windows(self.block)

    def probe(self, table: pa.Table) -> pa.Table:
        g = table.column("__g")[0].as_py()
        hashes, marks = [], []
        for _, found in _parts(_ordered(table, self.text), self.text):
            at, h = self._probes(found)
            hashes.append(h)
            marks.append(found.rank()[at] % self.block == 0)
        h, marks = np.concatenate(hashes), np.concatenate(marks)
        return _sent(g, 0, h, h.astype(np.uint32), marks, self.parts)

    def _candidates(self, found: Words, at: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """First words of the windows that hold a hit block and fit into their document."""
        back = self.window - self.block
        rank = found.rank()
        total = np.repeat(found.counts, found.counts)
        where = at[hit]
        # +1 where the run of windows around a hit begins, -1 after its end.
        edge = np.zeros(len(rank) + 1, np.int64)
        np.add.at(edge, where - np.minimum(rank[where], back), 1)
        np.add.at(edge, where + 1, -1)
        near = np.cumsum(edge[:-1]) > 0
        return np.flatnonzero(near & (total - rank >= self.window))

    def _extended(self, table: pa.Table, answers: pa.Table):
        """Each part's documents, number of words, candidate windows and their two hashes."""
        parts = list(_parts(_ordered(table, self.text), self.text))
        probes = [self._probes(found) for _, found in parts]
        hits = _received(answers, 0, np.concatenate([h for _, h in probes]), self.parts)
        done = 0
        parts.reverse()  # taken from the end, so that each part is freed once it is done
        for at, h in probes:
            docs, found = parts.pop()
            near = self._candidates(found, at, hits[done : done + len(h)])
            done += len(h)
            first = found.hashes(near, self.window) if len(near) else np.zeros(0, np.uint64)
            second = found.hashes(near, self.window, 1) if len(near) else first
            yield docs, len(found.starts), near, first, second

    def extend(self, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return pa.schema(_MESSAGE).empty_table()
        g = table.column("__g")[0].as_py()
        found = [f[3:] for f in self._extended(table, answers)]
        first, second = (np.concatenate(h) for h in zip(*found))
        return _sent(g, 1, second, first, None, self.parts)

    def answer(self, table: pa.Table) -> pa.Table:
        """One bit per hash of a bucket: does it repeat (and, for probes, meet a block)?"""
        rows = table.combine_chunks()
        kind = rows.column("kind")[0].as_py()
        blobs = rows.column("hashes").to_pylist()
        values = [np.frombuffer(b, np.uint64 if kind else np.uint32) for b in blobs]
        sizes = [len(v) for v in values]

        def flags(column: str) -> np.ndarray:
            return np.concatenate([_bits(m, s) for m, s in zip(rows.column(column).to_pylist(), sizes)])

        _, code, count = np.unique(
            np.concatenate(values), return_inverse=True, return_counts=True
        )
        good = count > 1
        good[code[flags("many")]] = True
        if not kind:
            indexed = np.zeros(len(count), bool)
            indexed[code[flags("marks")]] = True
            good &= indexed
        hit = np.split(good[code], np.cumsum(sizes)[:-1])
        told = [i for i, h in enumerate(hit) if h.any()]
        return pa.table(
            {
                "bucket": rows.column("bucket").take(pa.array(told, pa.int64())),
                "g": rows.column("g").take(pa.array(told, pa.int64())),
                "kind": rows.column("kind").take(pa.array(told, pa.int64())),
                "hashes": pa.nulls(len(told), pa.binary()),
                "many": pa.nulls(len(told), pa.binary()),
                "marks": pa.array([np.packbits(hit[i]).tobytes() for i in told], "binary"),
            }
        )

    def remove(self, table: pa.Table, answers: pa.Table) -> pa.Table:
        """The rows with the kept words as text, and the counts of words and removed ones."""
        if not table.num_rows:
            return table.append_column("__n", pa.array([], pa.int64())).append_column(
                "__r", pa.array([], pa.int64())
            )
        rows = _ordered(table, self.text)
        found = list(self._extended(table, answers))
        again = _received(answers, 1, np.concatenate([f[4] for f in found]), self.parts)
        kept, n, r, done = [], [], [], 0
        for docs, size, near, _, _ in found:
            first = near[again[done : done + len(near)]]
            done += len(near)
            edge = np.zeros(size + 1, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + self.window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            begin = 0
            for doc in docs:
                mine = gone[begin : begin + len(doc)]
                begin += len(doc)
                lost = int(mine.sum())
                left = [w for w, g in zip(doc, mine.tolist()) if not g] if lost else doc
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                n.append(len(doc))
                r.append(lost)
        at = rows.schema.get_field_index(self.text)
        return (
            rows.set_column(at, rows.schema.field(at), pa.array(kept, rows.schema.field(at).type))
            .append_column("__n", pa.array(n, pa.int64()))
            .append_column("__r", pa.array(r, pa.int64()))
        )


_MESSAGE = [
    ("bucket", pa.int32()),
    ("g", pa.int32()),
    ("kind", pa.int32()),
    ("hashes", pa.binary()),
    ("many", pa.binary()),
    ("marks", pa.binary()),
]


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    n_words: str = "n_words",
    n_removed: str = "n_removed",
) -> DataFrame:
    """``docs`` with ``text`` replaced by the kept words, joined by one space, and two counts.

    A word goes if a window of ``window`` words covers it whose sequence also starts
    anywhere else, in the same document or row included; so of fully repeated rows all
    lose their long sequences. Texts that are null, empty or shorter than the window
    keep all their words (null: none, the result is the empty text). Other columns come
    through unchanged, whatever their names; given columns called ``n_words`` or
    ``n_removed`` give way to the results. An empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    given, name = numbered(docs)
    own, text = text, name(text)
    size = text_bytes(given, text)
    n, buckets = (max(partitions(spark), -(-size // b)) for b in (GROUP_BYTES, BUCKET_BYTES))
    passes = Repeats(text, window, buckets)
    keyed = _few_copies(given, text)
    keyed = keyed.withColumn("__g", F.pmod("__k", F.lit(n)).cast("int"))
    # Plain functions: Spark tells from the number of arguments whether to pass the key.
    probe, answer = lambda t: passes.probe(t), lambda t: passes.answer(t)
    extend, remove = lambda t, a: passes.extend(t, a), lambda t, a: passes.remove(t, a)
    asked = keyed.groupBy("__g").applyInArrow(probe, MESSAGE)
    hits = asked.groupBy("bucket").applyInArrow(answer, MESSAGE)
    wide = keyed.groupBy("__g").cogroup(hits.groupBy("g")).applyInArrow(extend, MESSAGE)
    again = wide.groupBy("bucket").applyInArrow(answer, MESSAGE)
    schema = StructType(
        [
            *[
                StructField(f.name, StringType() if f.name == text else f.dataType)
                for f in keyed.schema.fields
            ],
            StructField("__n", LongType()),
            StructField("__r", LongType()),
        ]
    )
    out = (
        keyed.groupBy("__g")
        .cogroup(hits.unionAll(again).groupBy("g"))
        .applyInArrow(remove, schema)
    )
    every = out.select("*", F.explode(F.sequence(F.lit(1), F.col("__m"))).alias("__copy"))
    return every.select(
        *[F.col(name(c)).alias(c) for c in docs.columns if c not in (n_words, n_removed)],
        F.col("__n").alias(n_words),
        F.col("__r").alias(n_removed),
    )


def _few_copies(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with a hash of the row (``__k``) and the rows that it stands for (``__m``).

    Fully repeated rows meet in one group. Where they would fill one, they are written once
    for ``COPIES`` of them, twice at least: two such rows see the same repeats as a million
    do. Rows count as repeated if 128 bits of hash over values and nulls agree.
    """
    values = [_hashable(docs, c) for c in docs.columns]
    nulls = F.array(*[F.col(c).isNull() for c in docs.columns])
    marked = docs.withColumns({"__k": F.xxhash64(*values), "__l": F.xxhash64(nulls, *values)})
    size = F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES
    many = stored(
        marked.select("__k", "__l", size.alias("__size"))
        .groupBy("__k", "__l")
        .agg(F.count("*").alias("__all"), F.sum("__size").alias("__size"))
        .where(f"__all > 2 and __size > {GROUP_BYTES}")
        .drop("__size"),
        "many",
    )
    row = F.first(F.struct(*docs.columns)).alias("__row")
    some = stored(
        marked.join(many, ["__k", "__l"]).groupBy("__k", "__l", "__all").agg(row), "some"
    )
    each = F.least(F.lit(COPIES), F.ceil(F.col("__all") / 2)).alias("__each")
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("__all") - 1) / F.col("__each"))))
    spread = some.select("*", each).select("*", parts.alias("__at")).select(
        "__row.*",
        F.xxhash64("__k", "__at").alias("__k"),
        F.least("__each", F.col("__all") - F.col("__at") * F.col("__each")).alias("__m"),
    )
    others = marked.join(many, ["__k", "__l"], "left_anti").drop("__l")
    return others.withColumn("__m", F.lit(1).cast("bigint")).unionByName(spread)


def _hashable(docs: DataFrame, name: str) -> Column:
    kind = docs.schema[name].dataType.typeName()
    column = F.col(f"`{name}`")
    return F.to_json(F.struct(column)) if kind in ("map", "variant", "array", "struct") else column
