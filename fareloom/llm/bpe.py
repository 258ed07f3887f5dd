"""BPE encoding and decoding by tree concatenation.

A text is normalised once and cut into halves, the halves into halves, down to leaves of
``LEAF`` characters. The leaves of long texts are rows of their own, so they are encoded
in parallel. Two halves are joined by encoding a window around the cut: if the window
meets the left encoding in one place and the right one in another (the same ids over the
same bytes, two tokens in a row), then left tokens, window tokens and right tokens are
the encoding of the whole, since a merge order that is right for every pair of
neighbours is right. If it does not meet them, the window grows, up to both halves whole.

Inside a leaf, parts between spaces are encoded once per worker and remembered: a split
at white space is always a split of the tokenizer here, which drops white space.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, prepare, stored

VOCABULARY = "word_bpe_49k.json"
LEAF = 4096
PART_BYTES = 1 << 20
LONG = 65536  # characters from which leaves are dealt out
KEPT = 150_000  # parts a worker remembers, about; common ones come first
# Characters for which Python's idea of space, lower case or composition may differ.
_BEYOND = re.compile("[^\t-\r\x20-\x7e\xa1-\xff]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class TreeEncoder:
    """One vocabulary file of the word-end kind, in one process."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.parts = Tokenizer.from_file(path)
        self.parts.no_truncation()
        self.parts.no_padding()
        self.normalizer = self.parts.normalizer
        self.parts.normalizer = None  # parts come normalised
        self.leaf = leaf
        size = self.parts.get_vocab_size(with_added_tokens=True)
        names = [self.parts.id_to_token(i) for i in range(size)]
        self.names = [x if x is not None else "" for x in names]
        self.added = {t.content: i for i, t in self.parts.get_added_tokens_decoder().items()}
        # Bytes of each token: a character of its name is a byte, the word end is none.
        self.widths = np.array(
            [len(x.removesuffix("</w>") if x else "") for x in names], np.int64
        )
        self.memory: dict[str, tuple[bytes, str]] = {}
        self.fresh: dict[str, tuple[bytes, str]] = {}

    def normalised(self, text: str) -> str:
        """What the vocabulary file's normalizer makes of it, but for spaces at the ends.

        Composed, single spaces, lower case; for Latin-1 texts Python does the same faster.
        """
        if _BEYOND.search(text):
            return self.normalizer.normalize_str(text)
        return " ".join(text.lower().split())

    def segments(self, text: str) -> Iterator[str | int]:
        """Normalised text between added tokens, and the ids of those."""
        if not any(a in text for a in self.added):
            yield self.normalised(text)
            return
        at = 0
        while at < len(text):
            found = [(text.find(a, at), -len(a), i) for a, i in self.added.items()]
            found = [f for f in found if f[0] >= 0]
            if not found:
                break
            place, size, token = min(found)
            if place > at:
                yield self.normalised(text[at:place])
            yield token
            at = place - size
        if at < len(text):
            yield self.normalised(text[at:])

    def learn(self, parts: Iterable[str]) -> None:
        """Encode what is new among the parts, in one call. Remembered while there is room."""
        missing = list(set(parts).difference(self.memory))
        if not missing:
            return
        codes = self.parts.encode_batch_fast(missing, add_special_tokens=False)
        known = self.memory if len(self.memory) < KEPT else self.fresh
        for p, e in zip(missing, codes):
            ids = e.ids
            shown = " ".join([self.names[i] for i in ids])
            known[p] = (array("I", ids).tobytes(), shown)

    def recall(self, parts: list[str]) -> list[tuple[bytes, str]]:
        """Ids and decoded text of every part."""
        found = list(map(self.memory.get, parts))
        if None in found:
            spots = [i for i, f in enumerate(found) if f is None]
            self.learn(p for p in {parts[i] for i in spots} if p not in self.fresh)
            for i in spots:
                found[i] = self.fresh.get(parts[i]) or self.memory[parts[i]]
        return found

    def encode_leaf(self, text: str) -> np.ndarray:
        parts = [p for p in text.split(" ") if p]
        return np.frombuffer(b"".join([ids for ids, _ in self.recall(parts)]), "<u4")

    def cut(self, text: str) -> int:
        """The middle; if a space is near, there, where nothing needs joining."""
        half, slack = len(text) // 2, self.leaf // 8
        space = text.find(" ", half - slack, half + slack)
        return space if space > 0 else half

    def leaves(self, text: str) -> list[str]:
        if len(text) <= self.leaf:
            return [text]
        at = self.cut(text)
        return [*self.leaves(text[:at]), *self.leaves(text[at:])]

    def tree(self, text: str, leaves: Iterator[np.ndarray]) -> np.ndarray:
        """The ids of a normalised text from those of its leaves, in order."""
        if len(text) <= self.leaf:
            return next(leaves)
        at = self.cut(text)
        left = self.tree(text[:at], leaves)
        return self.join(text, at, left, self.tree(text[at:], leaves))

    def encode_segment(self, text: str) -> np.ndarray:
        return self.tree(text, map(self.encode_leaf, self.leaves(text)))

    def join(self, text: str, at: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if text[at - 1] == " " or text[at] == " ":
            return np.concatenate([left, right])
        size = 16
        while True:
            a, b = max(0, at - size), min(len(text), at + size)
            window = self.encode_leaf(text[a:b])
            # Byte places of token ends, counted from the cut; white space has none.
            begin = -_bytes(text[a:at])
            ends = begin + np.cumsum(self.widths[window])
            start = ends - self.widths[window]
            head = 0, len(left)  # window tokens from head[0] on follow left[:head[1]]
            if a > 0:
                head = self._meet(left, window, start, before=True)
            tail = len(window), 0
            if b < len(text):
                tail = self._meet(right, window, start, before=False)
            if a == 0:
                head = 0, 0
            if b == len(text):
                tail = len(window), len(right)
            if head and tail and head[0] <= tail[0]:
                return np.concatenate([left[: head[1]], window[head[0] : tail[0]], right[tail[1] :]])
            size *= 2

    def _meet(self, side: np.ndarray, window: np.ndarray, start: np.ndarray, before: bool):
        """(i, k): window tokens i, i+1 and side tokens k, k+1 are the same, on one side of the cut.

        The first such place on the left, the last on the right, so that the splice
        keeps as much of the window as agrees.
        """
        widths = self.widths[side]
        if before:
            some = min(len(side), len(window) + 2)
            own = np.cumsum(widths[len(side) - some :])
            own = own - widths[len(side) - some :] - own[-1] if some else own
            offset = len(side) - some
        else:
            some = min(len(side), len(window) + 2)
            own = np.cumsum(widths[:some]) - widths[:some]
            offset = 0
        places = {int(p): k + offset for k, p in enumerate(own.tolist())}
        order = range(len(window) - 1)
        for i in order if before else reversed(order):
            s = int(start[i])
            if (s >= 0) if before else (s < 0):
                continue
            k = places.get(s)
            if (
                k is not None
                and k + 1 < len(side)
                and side[k] == window[i]
                and side[k + 1] == window[i + 1]
                and (not before or int(start[i + 1]) + self.widths[window[i + 1]] <= 0)
            ):
                return i, k
        return None

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Each text's number of tokens, SHA-256 of its ids as little-endian 32-bit numbers
        and SHA-256 of its decoded text."""
        segments = [list(self.segments(t or "")) for t in texts]
        self.fresh.clear()
        known = self.memory
        self.learn(
            p
            for own in segments
            for s in own
            if isinstance(s, str)
            for p in s.split(" ")
            if p and p not in known
        )
        return map(self._digest, segments)

    def _digest(self, segments: list[str | int]) -> tuple[int, str, str]:
        ids, shown = hashlib.sha256(), hashlib.sha256()
        n = 0
        for segment in segments:
            if isinstance(segment, str) and len(segment) <= self.leaf:
                found = self.recall([p for p in segment.split(" ") if p])
                some = b"".join([f[0] for f in found])
                told = " ".join([f[1] for f in found if f[1]])
            else:
                one = isinstance(segment, int)
                code = np.array([segment], "<u4") if one else self.encode_segment(segment)
                some, told = code.tobytes(), self.decode(code)
            if some:
                ids.update(some)
                shown.update((b" " if n else b"") + told.encode())
                n += len(some) // 4
        return n, ids.hexdigest(), shown.hexdigest()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, leaves in this process."""
        found = [
            np.array([s], "<u4") if isinstance(s, int) else self.encode_segment(s)
            for s in self.segments(text or "")
        ]
        return np.concatenate(found) if found else np.zeros(0, "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes without a decoder: the tokens' names, by single spaces."""
        return " ".join([self.names[i] for i in ids.tolist()])


def _bytes(text: str) -> int:
    return len(text.replace(" ", "").encode("utf-8", "surrogatepass"))


@lru_cache(maxsize=2)
def encoder(path: str, leaf: int = LEAF) -> TreeEncoder:
    return TreeEncoder(path, leaf)


def digests(docs: DataFrame, path: str | None = None, leaf: int = LEAF, long: int = LONG) -> DataFrame:
    """Every row's doc_id, n_tokens, ids_sha256 and decoded_sha256.

    Null and empty texts have no token. Rows come back as often as they are given, with
    null ids as they are; other columns are ignored. Texts beyond ``long`` characters have
    their leaves encoded as rows of their own, each distinct text once.
    """
    prepare(docs.sparkSession)
    path = path or default_path()
    slim = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text") > long, F.lit(False))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, leaf)
        for batch in pieces(batches, "text", PART_BYTES):
            found = list(own.digests(batch.column("text").to_pylist()))
            n, ids, shown = zip(*found) if found else ([], [], [])
            yield _told(batch.column("doc_id"), n, ids, shown)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    slim = slim.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    short = slim.where(~is_long).mapInArrow(near, schema)
    far = slim.where(is_long).withColumn("key", F.sha2("text", 256))
    texts = far.groupBy("key").agg(F.any_value("text").alias("text"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, leaf)
        for batch in batches:
            for key, text in zip(*(batch.column(c).to_pylist() for c in ("key", "text"))):
                rows = []
                for s, segment in enumerate(own.segments(text)):
                    if isinstance(segment, int):
                        rows.append((s, 0, None, segment))
                    else:
                        rows += [(s, i, x, None) for i, x in enumerate(own.leaves(segment))]
                s, i, x, t = zip(*rows) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": [key] * len(rows),
                        "segment": pa.array(s, pa.int32()),
                        "leaf": pa.array(i, pa.int32()),
                        "part": pa.array(x, pa.string()),
                        "token": pa.array(t, pa.int32()),
                    }
                )

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, leaf)
        for batch in batches:
            ids = [
                np.array([t], "<u4").tobytes() if x is None else own.encode_leaf(x).tobytes()
                for x, t in zip(batch.column("part").to_pylist(), batch.column("token").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(ids, pa.binary())],
                names=["key", "segment", "leaf", "part", "ids"],
            )

    def join(table: pa.Table) -> pa.Table:
        own = encoder(path, leaf)
        rows = table.sort_by([("segment", "ascending"), ("leaf", "ascending")]).to_pylist()
        found, at = [], 0
        while at < len(rows):
            end = at
            while end < len(rows) and rows[end]["segment"] == rows[at]["segment"]:
                end += 1
            mine = [np.frombuffer(r["ids"], "<u4") for r in rows[at:end]]
            if rows[at]["part"] is None:
                found += mine
            else:
                text = "".join(r["part"] for r in rows[at:end])
                found.append(own.tree(text, iter(mine)))
            at = end
        ids = np.concatenate(found)
        return pa.table(
            {
                "key": [rows[0]["key"]],
                "n_tokens": pa.array([len(ids)], pa.int64()),
                "ids_sha256": [hashlib.sha256(ids.tobytes()).hexdigest()],
                "decoded_sha256": [hashlib.sha256(own.decode(ids).encode()).hexdigest()],
            }
        )

    joined = (
        texts.mapInArrow(cut, "key string, segment int, leaf int, part string, token int")
        .repartition("key", "segment", "leaf")
        .mapInArrow(encode, "key string, segment int, leaf int, part string, ids binary")
        .groupBy("key")
        .applyInArrow(join, "key string, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    )
    joined = stored(joined, "long")
    return short.unionAll(
        far.select("doc_id", "key")
        .join(joined, "key")
        .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    )


def _told(doc_id: pa.Array, n, ids, shown) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(shown, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )
