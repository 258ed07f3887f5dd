"""Rolling hashes of word sequences, for many documents at once.

The words of a document are joined by single spaces and the documents by line
breaks. Over that buffer runs a polynomial prefix hash modulo 2**64, so the hash
of any run of words is a difference of two prefixes, whatever its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n at least; kept for the next call."""
    held = _POWERS.get(which)
    if held is None or len(held[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            powers = np.ones(size, np.uint64)
            done = 1
            while done < size:  # doubling: the next part is this part times base**done
                step = np.uint64(pow(base, done, 1 << 64))
                powers[done : 2 * done] = powers[:done] * step
                done *= 2
            out.append(powers)
        _POWERS[which] = held = (out[0], out[1])
    return held


@dataclass
class Words:
    """Words of some documents: where each begins and ends in ``buffer``."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # words of each document, zero included

    @property
    def first(self) -> np.ndarray:
        """The index of each document's first word."""
        return np.cumsum(self.counts) - self.counts

    def rank(self) -> np.ndarray:
        """Each word's place in its own document."""
        return np.arange(len(self.starts)) - np.repeat(self.first, self.counts)

    def windows(self, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of ``size`` words of one document."""
        left = np.repeat(self.counts, self.counts) - self.rank()
        at = np.flatnonzero(left >= size)
        return at, self.hashes(at, size, which)

    def hashes(self, at: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        up, down = _powers(which, len(self.buffer) + 1)
        prefix = self.__dict__.get(f"_prefix{which}")
        if prefix is None:
            prefix = np.zeros(len(self.buffer) + 1, np.uint64)
            np.cumsum(_BYTES[self.buffer] * up[: len(self.buffer)], out=prefix[1:])
            self.__dict__[f"_prefix{which}"] = prefix
        begin = self.starts[at]
        span = prefix[self.ends[at + size - 1]] - prefix[begin]
        return mix(span * down[begin])


def words_of(split: list[list[bytes]]) -> Words:
    counts = np.array([len(w) for w in split], np.int64)
    buffer = np.frombuffer(b"\n".join([b" ".join(w) for w in split if w]), np.uint8)
    breaks = np.flatnonzero((buffer == 32) | (buffer == 10))
    if not counts.sum():
        none = np.zeros(0, np.int64)
        return Words(buffer, none, none, counts)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [len(buffer)]])
    return Words(buffer, starts, ends, counts)
