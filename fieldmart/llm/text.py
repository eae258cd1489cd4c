"""Words of whole Arrow columns of text as numpy arrays: bounds, hashes and shingles, without a Python loop over words.

A column is taken in chunks of whole documents of about CHUNK bytes, so that memory follows the longest document and
not the batch. Null texts count as empty. UTF-8 bytes decide: every byte of a non-ASCII character is a word byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U = np.uint64


def _table(chosen) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chosen)] = True
    return out


#: Bytes of words: those between ASCII white space; digits, letters and non-ASCII characters.
SPACED = ~_table([0x20, *range(0x09, 0x0E)])
ALNUM = _table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BASE, _INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
_PLACE = mixed(np.arange(101, 133, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) | U(1)


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK) + 1, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        if n > 4 * CHUNK:
            return have
        _POWERS[base] = have
    return have


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, n)[:n], out=sums[1:])
        return mixed((sums[end] - sums[start]) * _powers(_INVERSE, n + 1)[start] + (end - start).astype(np.uint64))


def hash_of(text: str) -> int:
    data = np.frombuffer(text.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


@dataclass
class Chunk:
    """Documents lo..hi-1 of a batch: bytes, and where each document begins (with the end of the last)."""

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray

    def words(self, kind: np.ndarray, lower: bool = True) -> Words:
        inside = kind[self.data]
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        before[self.bounds] = False
        after[self.bounds] = False
        start = np.flatnonzero(inside & ~before[:-1])
        end = np.flatnonzero(inside & ~after[1:]) + 1
        return Words(self, LOWERED[self.data] if lower else self.data, start, end, np.searchsorted(start, self.bounds))


@dataclass
class Words:
    chunk: Chunk
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Number of the first word of each document, with the number of all words.
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def word(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within documents, the number of their first words, and the first run of each document."""
    n = len(hashes)
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    with np.errstate(over="ignore"):
        full = np.full(max(n - k + 1, 0), k, np.uint64)
        for j in range(k):
            full += hashes[j : j + len(full)] * _PLACE[j]
    return mixed(full[at]), at, begin


def shingle_sets(hashes: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each document, end to end, and where each begins.

    A document of fewer words is one shingle, its whole sequence; one without words has none.
    """
    got, _, begin = grams(hashes, first, k)
    words = np.diff(first)
    short = np.flatnonzero((words > 0) & (words < k))
    docs = np.repeat(np.arange(len(words)), np.diff(begin))
    if len(short):
        with np.errstate(over="ignore"):
            extra = [mixed(np.array([sum(int(h) * int(_PLACE[j]) for j, h in enumerate(hashes[first[d] : first[d + 1]])) + int(words[d]) & (1 << 64) - 1], np.uint64))[0] for d in short]
        got, docs = np.concatenate([got, np.array(extra, np.uint64)]), np.concatenate([docs, short])
    order = np.lexsort((got, docs))
    got, docs = got[order], docs[order]
    keep = np.ones(len(got), bool)
    keep[1:] = (got[1:] != got[:-1]) | (docs[1:] != docs[:-1])
    return got[keep], np.concatenate([[0], np.cumsum(np.bincount(docs[keep], minlength=len(words)))])


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[Chunk]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def sums_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values over first[i]..first[i+1]."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[first[1:]] - total[first[:-1]]
