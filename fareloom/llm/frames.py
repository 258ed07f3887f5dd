"""Token ids on disk as independent zstandard frames with a trailing seek table.

A shard file is a row of zstandard frames, each with its own checksum; then a skippable
frame with the document index; then the seek table, a skippable frame too, in the public
seekable layout: for each frame its compressed size, decompressed size and the low 32
bits of the XXH64 of its content, then the number of frames, a flag byte and a magic
number. A plain zstandard decoder reads the ids alone. A reader that wants one document
reads the table and the index at the end, then only the frames that hold the document.

Documents are ranged by id over the shards, so shard after shard holds them in order.
A task writes a file of its own name and reports it; what a lost task wrote is never
reported, so a second attempt cannot mix with it.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, prepare, stored, text_bytes
from fareloom.session import new_path

VOCABULARY = "byte_bpe_50k.json"
END = 2
SHARD_BYTES = 16 << 20  # text of one shard, about
FRAME_IDS = 1 << 16
PART_BYTES = 4 << 20
KEPT = 500_000  # parts a worker remembers, about

INDEX_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


_GAP = re.compile(r"\s[ \n]")
_SPLIT = re.compile(r"(?<=\S)(?=[ \n])")
# A word and marks behind it: the library splits between the three, and nowhere else.
_PLAIN = re.compile(
    r"(\n?)( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)"
)


class ByteEncoder:
    """One vocabulary file of the byte-level kind, in one process.

    Its splits never join a character that is no space with a space after it, so a text
    can be cut there and the parts encoded once each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        self.added = [t.content for t in self.own.get_added_tokens_decoder().values()]
        self.memory: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        # The characters by which a byte-level vocabulary names bytes.
        named = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in named]
        self.names = {b: chr(256 + i) for i, b in enumerate(rest)}

    def stem(self, text: str) -> bytes:
        """The ids of what the library would not split, straight from its merges."""
        known = self.stems.get(text)
        if known is None:
            told = text.encode().decode("latin-1").translate(self.names)
            known = array("I", [t.id for t in self.own.model.tokenize(told)]).tobytes()
            if len(self.stems) < KEPT:
                self.stems[text] = known
        return known

    def parts(self, text: str) -> list[str]:
        if any(a in text for a in self.added):
            return [text]
        if _GAP.search(text):
            return [p for p in _SPLIT.split(text) if p]
        out = []
        for i, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            out.append("\n" + first if i else first)
            out += [" " + p for p in rest]
        return out if out[0] else out[1:]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.parts(t) if t else [] for t in texts]
        memory = self.memory
        found = [list(map(memory.get, own)) for own in split]
        fresh: dict[str, bytes] = {}
        other = []
        for own, codes in zip(split, found):
            if None not in codes:
                continue
            for p, c in zip(own, codes):
                if c is None and p not in fresh:
                    plain = _PLAIN.fullmatch(p)
                    fresh[p] = b"".join(map(self.stem, filter(None, plain.groups()))) if plain else b""
                    if not plain:
                        other.append(p)
        codes = self.own.encode_batch_fast(other, add_special_tokens=False) if other else []
        for p, e in zip(other, codes):
            fresh[p] = array("I", e.ids).tobytes()
        if len(memory) < KEPT:
            memory.update(fresh)
        return [
            b"".join([fresh[p] if c is None else c for p, c in zip(own, codes)])
            if None in codes
            else b"".join(codes)
            for own, codes in zip(split, found)
        ]


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def _place(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


class ShardWriter:
    """Frames of one file, then its index and seek table."""

    def __init__(self, sink):
        self.sink = sink
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.table: list[tuple[int, int, int]] = []
        self.ids: list[int] = []
        self.sizes: list[int] = []
        self.held: list[bytes] = []
        self.room = 4 * FRAME_IDS

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids) // 4)
        at = 0
        while len(ids) - at > self.room:  # a long document goes on in the next frame
            self.held.append(ids[at : at + self.room])
            at += self.room
            self.flush()
        self.held.append(ids[at:])
        self.room -= len(ids) - at
        if self.room < 2 * FRAME_IDS:  # at least half full: end it with the document
            self.flush()

    def flush(self) -> None:
        raw = b"".join(self.held)
        if raw:
            packed = self.packer.compress(raw)
            self.sink.write(packed)
            check = xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF
            self.table.append((len(packed), len(raw), check))
        self.held, self.room = [], 4 * FRAME_IDS

    def close(self) -> None:
        self.flush()
        known = np.array([i is not None for i in self.ids], np.uint8)
        index = self.packer.compress(
            struct.pack("<Q", len(self.ids))
            + np.array(self.sizes, "<u8").tobytes()
            + np.array([i or 0 for i in self.ids], "<i8").tobytes()
            + known.tobytes()
        )
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        rows = b"".join(struct.pack("<III", *row) for row in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", TABLE_MAGIC, len(rows) + len(footer)))
        self.sink.write(rows + footer)


@dataclass
class Entry:
    """A document of a shard: its id and which ids of the shard are its own."""

    doc_id: int | None
    start: int
    n_tokens: int


class ShardReader:
    """Random access to one shard file."""

    def __init__(self, uri: str):
        system, path = _place(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"no seek table at the end of {uri}")
        rows = self.file.read_at(12 * frames, size - 9 - 12 * frames)
        table = np.frombuffer(rows, "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.raw, self.checks = table.T
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.begins = (np.cumsum(self.raw) - self.raw) // 4
        at = int(self.sizes.sum())
        kind, length = struct.unpack("<II", self.file.read_at(8, at))
        if kind != INDEX_MAGIC:
            raise ValueError(f"no document index in {uri}")
        unpacker = zstandard.ZstdDecompressor()
        index = unpacker.decompress(self.file.read_at(length, at + 8))
        (n,) = struct.unpack_from("<Q", index)
        counts = np.frombuffer(index, "<u8", n, 8).astype(np.int64)
        ids = np.frombuffer(index, "<i8", n, 8 + 8 * n).tolist()
        known = np.frombuffer(index, np.uint8, n, 8 + 16 * n).tolist()
        starts = (np.cumsum(counts) - counts).tolist()
        self.entries = [
            Entry(i if k else None, s, c) for i, k, s, c in zip(ids, known, starts, counts.tolist())
        ]
        self.unpacker = unpacker
        self.frame: tuple[int, bytes] = (-1, b"")

    def _frame(self, i: int) -> bytes:
        if self.frame[0] != i:
            packed = self.file.read_at(int(self.sizes[i]), int(self.offsets[i]))
            raw = self.unpacker.decompress(packed)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[i]:
                raise ValueError(f"frame {i} does not match its checksum")
            self.frame = (i, raw)
        return self.frame[1]

    def read(self, entry: Entry) -> bytes:
        """The document's ids, from the frames that hold them."""
        at, end, out = entry.start, entry.start + entry.n_tokens, []
        i = int(np.searchsorted(self.begins, at, "right")) - 1
        while at < end:
            raw, begin = self._frame(i), int(self.begins[i])
            stop = min(end, begin + len(raw) // 4)
            out.append(raw[4 * (at - begin) : 4 * (stop - begin)])
            at, i = stop, i + 1
        return b"".join(out)

    def find(self, doc_id: int) -> list[bytes]:
        """Every document of that id; only their frames are read."""
        return [self.read(e) for e in self.entries if e.doc_id == doc_id]

    def close(self) -> None:
        self.file.close()


def write(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Write ``doc_id`` and ``text`` as shards below ``folder``; the shards, in order.

    Ascending ids, null ids first; rows of one id by text. Null and empty texts have the
    end id only. No rows, no shards. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    path = path or default_path()
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shards = max(1, -(-text_bytes(slim) // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    end = array("I", [END]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = encoder(path)
        system, base = _place(folder)
        system.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"shard-{part:06d}-{uuid.uuid4().hex}.zst"
        writer, sink = None, None
        for batch in pieces(batches, "text", PART_BYTES):
            if writer is None:
                # The frames are the compression; the name must not bring another.
                sink = system.open_output_stream(f"{base}/{name}", compression=None)
                writer = ShardWriter(sink)
            codes = own.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), codes):
                writer.add(doc_id, ids + end)
        if writer is None:
            return
        writer.close()
        sink.close()
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "file": [f"{folder}/{name}"],
                "n_docs": pa.array([len(writer.ids)], pa.int64()),
                "n_tokens": pa.array([sum(writer.sizes)], pa.int64()),
            }
        )

    # By the beginning of the text as well: rows without an id, or of one, are cut like others.
    begins = F.substring("text", 1, 64).asc_nulls_first()
    ranged = slim.repartitionByRange(shards, order[0], begins).sortWithinPartitions(*order)
    written = ranged.mapInArrow(run, "part int, file string, n_docs bigint, n_tokens bigint")
    return stored(written, "shards")


def read(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """Every document of the shards: doc_id, start among all ids, n_tokens and ids_crc32."""
    prepare(spark)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                shard = ShardReader(uri)
                rows = [
                    (e.doc_id, base + e.start, e.n_tokens, zlib.crc32(shard.read(e)))
                    for e in shard.entries
                ]
                shard.close()
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One row per shard and a task for each: a number given is not merged for being small.
    return based.repartitionByRange(max(1, shards.count()), "part").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def round_trip(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, new_path(spark, "tokens")))
