"""Word splitting and word hashes over Arrow batches of texts, with NumPy.

A batch of texts is one byte buffer; word borders come from a 256-entry table
of word bytes, and word hashes from prefix sums of a polynomial modulo 2**64
(its base is odd, so it has an inverse and any slice costs two look-ups).
Work is cut into chunks of whole texts of about ``CHUNK`` bytes to bound
memory; a longer text is a chunk of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def blank_separated() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return t


def alphanumeric() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (after lower-casing A-Z)."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix constants); a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, CHUNK + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("p", _BASE), ("i", inverse)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["p"], _powers["i"]


@dataclass
class Words:
    """Words of one chunk of texts: texts ``first .. first + n - 1`` of the batch.

    ``data`` are the (possibly lower-cased) bytes, ``start``/``end`` the byte
    borders of each word, ``offsets[t]:offsets[t + 1]`` the words of text t.
    """

    first: int
    n: int
    data: np.ndarray
    bytes_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word (equal words have equal hashes)."""
        power, inverse = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_byte_values()[self.data] * power[:len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


def text_chunks(texts: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray, lower: bool = False,
                chunk: int = CHUNK) -> Iterator[Words]:
    """Split the texts of a batch into words, a chunk of whole texts at a time; null texts have none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    at = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
    whole = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    lowered = lower_table()
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + chunk, side="right")) - 1)
        data = whole[at[first]:at[last]]
        if lower:
            data = lowered[data]
        bytes_at = at[first:last + 1] - at[first]
        is_word = word_bytes[data]
        if len(data):
            before = np.empty(len(data), bool)
            before[0], before[1:] = False, is_word[:-1]
            before[bytes_at[:-1][bytes_at[:-1] < len(data)]] = False
            start = np.flatnonzero(is_word & ~before)
            after = np.empty(len(data), bool)
            after[-1], after[:-1] = False, is_word[1:]
            inner = bytes_at[1:]
            after[inner[inner > 0] - 1] = False
            end = np.flatnonzero(is_word & ~after) + 1
        else:
            start = end = np.zeros(0, np.int64)
        yield Words(first, last - first, data, bytes_at, start, end, np.searchsorted(start, bytes_at))
        first = last


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (order matters); shorter by n - 1."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    weight = 1
    for j in range(n):
        weight = weight * 0xD6E8FEB86659FD93 % (1 << 64) | 1
        out += h[j:len(h) - n + 1 + j] * np.uint64(weight)
    return mix(out)


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of every element of ragged slices starting at ``offsets``."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return row, offsets[row] + within


def as_long(x: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs."""
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())
