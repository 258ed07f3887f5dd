"""Plain versions of the operators, on rows in memory."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window=35):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows."""
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        sha = hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((doc_id, len(w), sum(gone), sha))
    return out


def simhash(text, size=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return 0
    parts = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows, distance=2):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = np.array([simhash(t) for _, t in rows], np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        near = np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= distance) + i + 1
        for j in near.tolist():
            root[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = least.get(find(i))
        if doc_id is not None and (known is None or doc_id < known):
            least[find(i)] = doc_id
    return [
        (d, f"{int(p):016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))
    ]


def quality_base(rows):
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        w = words(text)
        lines, dup, seen = text.split("\n"), 0, set()
        for line in lines:
            if words(line):
                dup += line in seen
                seen.add(line)
        tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((doc_id, len(w), sum(map(len, w)), symbols, dup, len(hit), failed))
    return out


def tokens(rows, path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    out = []
    for doc_id, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids
        told = own.decode(ids, skip_special_tokens=False)
        out.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(told.encode()).hexdigest(),
            )
        )
    return out


def shown(rows):
    return sorted((tuple(r) for r in rows), key=repr)
