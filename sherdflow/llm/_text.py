"""Vectorised word scanning over Arrow text columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Those bytes never occur inside a
multi-byte UTF-8 sequence, so scanning bytes and scanning code points give the same words.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Texts are scanned in runs of whole documents of about this many bytes, which bounds the arrays.
CHUNK_BYTES = 1 << 19

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the hash base or of its inverse, modulo 2**64."""
    table = _powers[kind]
    if len(table) < n:
        m = max(n, CHUNK_BYTES + 1)
        table = np.full(m, _P if kind == "up" else _P_INV, np.uint64)
        table[0] = 1
        with np.errstate(over="ignore"):
            table = np.multiply.accumulate(table, dtype=np.uint64)
        if m <= 8 * CHUNK_BYTES:
            _powers[kind] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash: span_hash() gets the hash of any span from it."""
    out = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power("up", len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((prefix[ends] - prefix[starts]) * _power("down", len(prefix))[starts])


@dataclass
class Chunk:
    """Some whole documents. buf: their bytes; off: where each begins; starts, ends: of words; words: where each
    document's words begin in those."""

    first: int
    buf: np.ndarray
    off: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.off) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.words))

    def word_hashes(self) -> np.ndarray:
        return span_hash(prefix_hash(self.buf), self.starts, self.ends)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space after each: bytes, starts, ends."""
        lens = self.ends - self.starts
        ends = np.cumsum(lens + 1) - 1
        starts = ends - lens
        keep = ~SPACE[self.buf]
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        mask = np.ones(len(out), bool)
        mask[ends] = False
        out[mask] = self.buf[keep]
        return out, starts, ends


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as one array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES, lower: bool = False) -> Iterator[Chunk]:
    """Whole documents of a text column, scanned for words; lower: A-Z become a-z first."""
    col = texts(column)
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + chunk_bytes, "right")) - 1)
        buf = data[off[i] : off[j]]
        if lower:
            buf = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
        yield scan(i, buf, off[i : j + 1] - off[i])
        i = j


def scan(first: int, buf: np.ndarray, off: np.ndarray) -> Chunk:
    ink = ~SPACE[buf]
    if len(buf):
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        before = np.ones(len(buf), bool)
        before[1:] = ~ink[:-1]
        after = np.ones(len(buf), bool)
        after[:-1] = ~ink[1:]
        starts = np.flatnonzero(ink & (before | edge[:-1]))
        ends = np.flatnonzero(ink & (after | edge[1:])) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    return Chunk(first, buf, off, starts, ends, np.searchsorted(starts, off))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` neighbours; len(x) - width + 1 values."""
    have, span = x, 1
    while span * 2 <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def give_back() -> None:
    """Return freed memory to the system: workers are kept between tasks, and with them what they don't use."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only with the GNU C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def batches(it: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made of one stays small."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
