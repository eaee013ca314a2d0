"""Vectorised UTF-8 helpers shared by the text operators.

Texts of an Arrow batch are seen as one byte buffer. Word boundaries come from
a 256-entry class table, and the hash of any byte range comes from one prefix
sum, so no Python code runs per character or per word.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; these
are all ASCII, so byte words and code-point words are the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many bytes (one longer text is
#: a slice by itself), which bounds the numpy arrays of a task.
SLICE_BYTES = 1_000_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M64 = (1 << 64) - 1
#: Odd base of the prefix hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser: spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A fixed pseudo-random 64-bit value for every byte value.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        base = np.uint64(_BASE if kind == "up" else _BASE_INV)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * SLICE_BYTES:
            _powers[kind] = have
    return have[:n]


class RangeHash:
    """64-bit hash of any byte range of a buffer, after one linear pass."""

    def __init__(self, buf: np.ndarray, table: np.ndarray = _BYTE):
        n = len(buf)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(table[buf] * _power("up", n), out=self._sum[1:])
        self._inv = _power("inv", n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self._sum[end] - self._sum[start]) * self._inv[start]
                     + (end - start).astype(np.uint64))


@dataclass
class Texts:
    """Some texts as one buffer; text i is ``buf[offs[i]:offs[i + 1]]``."""

    buf: np.ndarray
    offs: np.ndarray

    def __len__(self) -> int:
        return len(self.offs) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.offs[i]:self.offs[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """Texts of an Arrow string column; null counts as the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if len(offs) == 0:
        offs = np.zeros(1, np.int64)
    return Texts(buf[offs[0]:offs[-1]], offs - offs[0])


def slices(batch: pa.RecordBatch, text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Row ranges of a batch whose texts have about ``limit`` bytes together."""
    n = batch.num_rows
    if n == 0:
        return
    whole = texts_of(batch.column(batch.schema.get_field_index(text)))
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(whole.offs, whole.offs[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        offs = whole.offs[lo:hi + 1]
        yield batch.slice(lo, hi - lo), Texts(whole.buf[offs[0]:offs[-1]], offs - offs[0])
        lo = hi


@dataclass
class Words:
    """Words of some texts: byte ranges, text index, and per-text bounds."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # words of text i are first[i]:first[i + 1]

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ranges(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of True that stays in one text."""
    n = len(inside)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words_of(texts: Texts) -> Words:
    start, end = ranges(~SPACE[texts.buf], texts.offs)
    return Words(start, end, np.searchsorted(start, texts.offs))


def lines_of(texts: Texts) -> Words:
    """Lines split at ``\\n`` (a text of k newlines has k + 1 lines)."""
    nl = np.flatnonzero(texts.buf == 10)
    start = np.sort(np.concatenate([texts.offs[:-1], nl + 1]), kind="stable")
    end = np.sort(np.concatenate([texts.offs[1:], nl]), kind="stable")
    first = np.arange(len(texts) + 1) + np.searchsorted(nl, texts.offs)
    return Words(start, end, first)


def gram(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams inside one text, and the position of their first item."""
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(hashes)) + n <= last)
    out = np.full(len(at), np.uint64(n), np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + hashes[at + k]
    return mix64(out), at
