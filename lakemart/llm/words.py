"""Flat numpy helpers for word hashing inside Arrow tasks.

A task receives Arrow batches of texts.  Texts are joined into one byte buffer
of bounded size (``chunks``), bytes are classed by a 256-entry table, and words,
word hashes and word shingles of all texts of the chunk come out of a few
vector operations.  Whole texts are always processed; a text longer than the
chunk size simply is its own chunk.

Hashes are 64 bit: a word hash is a sum over its bytes of ``T[byte] * P[pos]``
with fixed random tables, a shingle hash the same over its words, both finished
by a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U = np.uint64
SPACE = 32
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit words."""
    x = np.asarray(x, dtype=U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words of a seed (a rule, not a table)."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


BYTE_TABLE = stream(11, 256)
POS_TABLE = stream(12, 256) | U(1)
WORD_TABLE = stream(13, 64) | U(1)
LEN_TABLE = stream(14, 64)


def byte_classes(separators, lower: bool = True) -> bytes:
    """Translation table: separators become a space, A-Z become a-z if ``lower``."""
    t = bytearray(range(256))
    if lower:
        for c in range(0x41, 0x5B):
            t[c] = c + 32
    for c in separators:
        t[c] = SPACE
    return bytes(t)


#: words are runs of anything but ASCII white space
BY_SPACE = byte_classes([0x20, *range(0x09, 0x0E)])
#: words are runs of a-z (after lower-casing), 0-9 and every non-ASCII character
BY_ALNUM = byte_classes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def chunks(texts: Sequence, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive groups ``(first position, encoded texts)`` of at most ``limit``
    bytes (one text alone may be longer).  A null text is empty."""
    start, size, out = 0, 0, []
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "replace")
        if out and size + len(b) > limit:
            yield start, out
            start, size, out = i, 0, []
        out.append(b)
        size += len(b) + 1
    if out:
        yield start, out


class Words:
    """Words of a group of texts.  ``doc`` (per word), ``hash`` (per word),
    ``begin``/``end`` (byte offsets in ``data``), ``first``/``count`` (per text)."""

    def __init__(self, texts: list[bytes], classes: bytes):
        self.data = b" ".join(texts).translate(classes) + b" "
        a = np.frombuffer(self.data, dtype=np.uint8)
        inside = a != SPACE
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(a) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.begin, self.end = edge[0::2], edge[1::2]
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        stops = np.cumsum(lens + 1)                       # texts are followed by one space
        self.offset = stops - lens - 1                    # byte offset of each text
        bounds = np.searchsorted(self.begin, stops)
        self.first = np.concatenate(([0], bounds[:-1]))
        self.count = bounds - self.first
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        size = self.end - self.begin
        at = np.cumsum(size) - size
        letters = a[inside]
        pos = np.arange(len(letters)) - np.repeat(at, size)
        with np.errstate(over="ignore"):
            weight = POS_TABLE[pos & 255]
            if len(size) and size.max() > 256:
                weight = weight + mix(pos >> 8) * U(2) * (pos > 255)
            value = BYTE_TABLE[letters] * weight
            self.hash = mix(np.add.reduceat(value, at)) if len(at) else np.zeros(0, U)

    def __len__(self):
        return len(self.begin)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, hash) of every run of ``k`` words inside one text."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        with np.errstate(over="ignore"):
            h = self.hash[:n] * WORD_TABLE[0]
            for j in range(1, k):
                h = h + self.hash[j:n + j] * WORD_TABLE[j]
            at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:n + k - 1])
            return at, mix(h[at] + LEN_TABLE[k])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every ``k``-word shingle; a text of fewer words, but
        not none, has its whole word sequence as one."""
        at, h = self.windows(k)
        doc = self.doc[at]
        for n in range(1, k):
            short = np.flatnonzero(self.count == n)
            if len(short):
                with np.errstate(over="ignore"):
                    s = np.zeros(len(short), U)
                    for j in range(n):
                        s = s + self.hash[self.first[short] + j] * WORD_TABLE[j]
                    doc = np.concatenate((doc, short))
                    h = np.concatenate((h, mix(s + LEN_TABLE[n])))
        return doc, h


def distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs sorted by text then hash, and the count of each text."""
    order = np.argsort(doc, kind="stable")
    doc, h = doc[order], h[order].copy()
    ends = np.cumsum(np.bincount(doc, minlength=n))
    start = 0
    for end in ends:
        h[start:end].sort()
        start = end
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[keep], h[keep]
    return doc, h, np.bincount(doc, minlength=n)


def text_sums(doc: np.ndarray, h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Order-free 64-bit hash of each text's set of element hashes (0 if empty)."""
    out = np.zeros(n, U)
    if len(h):
        with np.errstate(over="ignore"):
            v = mix(h + U(seed))
            starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            out[doc[starts]] = np.add.reduceat(v, starts)
    return out
