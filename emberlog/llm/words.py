"""Words and word-window hashes of many texts at once, in numpy.

A chunk holds whole texts of about a megabyte; a text larger than that is a chunk
of its own. Hashes are polynomials modulo 2**64 over tabulated bytes (Rabin-Karp),
finished with a bit mixer, so every window is a difference of two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240607)
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_BASE = 0x9E3779B97F4A7C2B  # odd, and one less is no multiple of four
_WINDOW_BASE = 0xD6E8FEB86659FD93

_ALL = np.arange(256)
#: ``[^\x20\x09-\x0D]``
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
_LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2**64."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.size = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 1 << 20)
            self.up = self._powers(self.base)
            self.down = self._powers(self.inverse)
        return self.up[:n], self.down[:n]

    def _powers(self, base: int) -> np.ndarray:
        out = np.full(self.size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_bytes_powers, _words_powers = _Powers(_WORD_BASE), _Powers(_WINDOW_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    """Equal ranges of the hash space, numbered from 0."""
    return ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)


@dataclass
class Chunk:
    """Rows ``start`` to ``stop`` of a batch and their words."""

    start: int
    stop: int
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # word number at which each text begins; one more at the end

    @property
    def texts(self) -> int:
        return self.stop - self.start

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """Hash of each word."""
        return self.prefix_hashes([len(self.buf)])[0]

    def prefix_hashes(self, lengths: list[int]) -> list[np.ndarray]:
        """Hashes of the first bytes of each word, for several lengths; shorter words count whole."""
        up, down = _bytes_powers.upto(len(self.buf) + 1)
        sums = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[self.buf] * up[:-1], out=sums[1:])
        out = []
        for length in lengths:
            ends = np.minimum(self.ends, self.starts + length)
            out.append(mix((sums[ends] - sums[self.starts]) * down[self.starts] + (ends - self.starts).astype(np.uint64)))
        return out


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, kind: np.ndarray, lower: bool, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts in chunks of about ``size`` bytes."""
    raw, at = strings(column)
    start, n = 0, len(at) - 1
    while start < n:
        stop = int(np.searchsorted(at, at[start] + size, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield _chunk(start, stop, raw[at[start] : at[stop]], at[start : stop + 1] - at[start], kind, lower)
        start = stop


def _chunk(start: int, stop: int, buf: np.ndarray, at: np.ndarray, kind: np.ndarray, lower: bool) -> Chunk:
    if lower:
        buf = _LOWER[buf]
    inside = kind[buf]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = at[(at > 0) & (at < len(buf))]  # a word never runs from one text into the next
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Chunk(start, stop, buf, starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, at))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers at which windows of ``width`` words of one text begin, and their hashes."""
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(hashes)) + width <= last)
    up, down = _words_powers.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return at, mix((sums[at + width] - sums[at]) * down[at] + np.uint64(width))


def covered(at: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``at``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    return np.cumsum(steps[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of maximal runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def grouped(work, *args):
    """``work(*args, table)`` as a function with the type hints that applyInArrow looks for."""

    def of_group(table: pa.Table) -> pa.Table:
        return work(*args, table)

    return of_group
