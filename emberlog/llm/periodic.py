"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a maximal stretch of words with smallest period q, at least 2 * q and ``LEAST`` words
long. Its words are equal to those q places on over a stretch of q places or more, so
of aligned blocks of B words, with 2 * B - 1 <= q, one lies wholly inside that
stretch. At scale B (1, 2, 4, ...) every block is therefore compared with the windows 2 * B - 1 to
4 * B - 2 words further on: the sum of the squared differences of word numbers is zero where the
block occurs again. Sums come from the squares' prefix sums and a correlation, which is an exact
integer number-theoretic transform modulo a prime (below ``DIRECT`` words per block they are taken
directly). A block with a word that does not come again within the window cannot occur there and
needs no transform. Blocks that follow each other at one distance are one seed; seeds are
checked word by word (a sum can be zero modulo the prime only) and extended to both sides.

A seed inside a known run whose period divides its distance would find that run again and is
left out before it is extended. That keeps a text of one repeated word at N log N.

The texts of a chunk are one sequence, with a word of its own after each, so no run crosses
texts. Chunks hold whole texts of about ``CHUNK_BYTES``; nothing is shuffled.

Defined cases: null, empty and blank text has no words and no runs, its collapsed text is
empty; one very long text is a chunk of its own; repeated rows are handled one by one; tables may be
empty; a column named like the new one is replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.words import SPACED, Chunk, chunks

LEAST = 12
DIRECT = 16  # words of a block from which sums come from a transform
CHUNK_BYTES = 1 << 20
_PRIME, _ROOT = 998244353, 3  # 119 * 2**23 + 1
_P = np.uint64(_PRIME)
_CELLS = 1 << 18  # of the matrices worked on at once
_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapsed(docs: DataFrame, text_col: str = "text", column: str = "runs", least: int = LEAST) -> DataFrame:
    """``docs`` with the runs of each text by start and period, in words, and in place of the text its
    words, one blank between them, without those that a run holds after its first period."""
    docs = docs.drop(column) if column != text_col else docs
    schema = docs.withColumn(column, F.lit(None).cast(_RUNS)).schema
    return docs.mapInArrow(partial(_collapsed, docs.columns.index(text_col), column, least), schema)


def _collapsed(place: int, column: str, least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(place), SPACED, lower=False, size=CHUNK_BYTES):
            text, found = _of_chunk(chunk, least)
            own = [c.slice(chunk.start, chunk.texts) for c in batch.columns]
            own[place] = text.cast(batch.schema.types[place])
            yield pa.record_batch([*own, found], names=[*batch.schema.names, column])


def _of_chunk(chunk: Chunk, least: int) -> tuple[pa.Array, pa.Array]:
    _, numbers = np.unique(chunk.hashes(), return_inverse=True)
    texts = chunk.texts
    own = np.insert(numbers.astype(np.int64), chunk.first[1:], len(numbers) + np.arange(texts))
    start, end, period = find_runs(own, int(np.diff(chunk.first).max(initial=0)), least)
    begins = chunk.first[:-1] + np.arange(texts)  # of each text in the sequence
    owner = np.searchsorted(begins, start, side="right") - 1
    # of texts without words the last that begins there; a run has words, so it is the right one
    offsets = np.searchsorted(owner, np.arange(texts + 1))
    rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - begins[owner], end - start, period)], fields=list(_RUN))
    runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
    steps = np.zeros(len(own) + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, end, -1)
    real = np.ones(len(own), bool)
    real[chunk.first[1:] + np.arange(texts)] = False
    kept = np.cumsum(steps[:-1])[real] == 0
    return _joined(chunk, kept), runs


def _joined(chunk: Chunk, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, one blank between them."""
    starts, sizes = chunk.starts[kept], (chunk.ends - chunk.starts)[kept] + 1
    upto = np.cumsum(sizes)
    places = np.repeat(starts - (upto - sizes), sizes) + np.arange(int(sizes.sum()))
    out = chunk.buf[np.minimum(places, max(len(chunk.buf) - 1, 0))] if len(places) else np.zeros(0, np.uint8)
    out[upto - 1] = 0x20
    words = np.concatenate([[0], np.cumsum(kept)])[chunk.first]  # kept words before each text
    ends = np.concatenate([[0], upto])[words]
    some = np.diff(words) > 0
    out = np.delete(out, ends[1:][some] - 1)
    offsets = ends - np.concatenate([[0], np.cumsum(some)])
    return pa.Array.from_buffers(pa.large_string(), chunk.texts, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])


def find_runs(words: np.ndarray, longest: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and periods of all runs of a sequence of numbers below 2**31, by start and period.

    ``longest``: words that a run can have at most.
    """
    n = len(words)
    scales = []
    while 2 * (2 << len(scales) >> 1) - 1 <= longest // 2:
        scales.append(1 << len(scales))
    width = scales[-1] if scales else 1
    top = int(words.max(initial=0)) + 1
    x = np.concatenate([words, top + np.arange(6 * width + 64)])  # no word equals what stands behind the end
    again = _again(x)
    runs = np.zeros((0, 3), np.int64)
    for block in scales:
        j, q = _direct(x, n, block) if block < DIRECT else _transformed(x, n, block, again)
        i, e, q = _new(*_chains(j, q, block), runs, block)
        if block >= DIRECT and len(i):
            i, e, q = _checked(x, i, e, q, block)
        i, e = i - _reach(x, i - 1, q, -1), e + _reach(x, e, q, 1)
        long = (e - i >= q) & (e - i + q >= least)
        runs = _distinct(np.concatenate([runs, np.stack([i, e + q, q], axis=1)[long]]))
    order = np.lexsort((runs[:, 2], runs[:, 0]))
    return runs[order, 0], runs[order, 1], runs[order, 2]


def _distinct(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def _again(x: np.ndarray) -> np.ndarray:
    """Distance to the next equal word; a large number if there is none."""
    out = np.full(len(x), 1 << 40, np.int64)
    order = np.argsort(x, kind="stable")
    same = x[order[1:]] == x[order[:-1]]
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def _direct(x: np.ndarray, n: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances without a mismatch; no squared difference adds to a sum."""
    blocks = -(-n // block)
    found = [np.flatnonzero((x[: blocks * block] == x[q : q + blocks * block]).reshape(blocks, block).all(axis=1)) for q in range(2 * block - 1, 4 * block - 1)]
    return np.concatenate(found), np.repeat(np.arange(2 * block - 1, 4 * block - 1), [len(f) for f in found])


def _transformed(x: np.ndarray, n: int, block: int, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = n // block  # a part of a block at the end holds no whole block
    able = np.flatnonzero(again[: blocks * block].reshape(blocks, block).max(axis=1, initial=0) <= 4 * block - 2)
    size, rows = 4 * block, max(1, _CELLS // (4 * block))
    found, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(able), rows):
        j = able[k : k + rows]
        zero = _zero_sums(x, j * block, block, size)
        row, shift = np.nonzero(zero)
        found.append(j[row]), distances.append(shift + 2 * block - 1)
    return np.concatenate(found), np.concatenate(distances)


def _zero_sums(x: np.ndarray, at: np.ndarray, block: int, size: int) -> np.ndarray:
    """For each block that begins at ``at`` and each of its 2 * block windows, whether the sum of squared differences is zero."""
    own = x[at[:, None] + np.arange(block)].astype(np.uint64) % _P
    window = x[at[:, None] + 2 * block - 1 + np.arange(3 * block - 1)].astype(np.uint64) % _P
    pattern = np.zeros((len(at), size), np.uint64)
    pattern[:, 0] = own[:, 0]
    pattern[:, size - block + 1 :] = own[:, :0:-1]
    text = np.zeros((len(at), size), np.uint64)
    text[:, : 3 * block - 1] = window
    product = _backward(_times(_forward(pattern), _forward(text)))[:, : 2 * block]
    squares = np.zeros((len(at), 3 * block), np.uint64)
    np.cumsum(_times(window, window), axis=1, out=squares[:, 1:])
    theirs = squares[:, block : 3 * block] - squares[:, : 2 * block]
    mine = _times(own, own).sum(axis=1, dtype=np.uint64)[:, None]
    return (mine + theirs) % _P == (product + product) % _P


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = a * b
    return c - c // _P * _P


@lru_cache(64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order 2 * half."""
    root = pow(_ROOT, (_PRIME - 1) // (2 * half), _PRIME)
    root = pow(root, -1, _PRIME) if inverse else root
    out, k = np.ones(1, np.uint64), 1
    while k < half:
        out = np.concatenate([out, _times(out, np.uint64(pow(root, k, _PRIME)))])
        k *= 2
    return out


def _forward(a: np.ndarray) -> np.ndarray:
    """Transform of each row; results in bit-reversed order."""
    m, n = a.shape
    half = n // 2
    while half:
        v = a.reshape(m, n // (2 * half), 2, half)
        low, high = v[:, :, 0], v[:, :, 1]
        total, less = low + high, low + (_P - high)
        v[:, :, 0], v[:, :, 1] = np.minimum(total, total - _P), _times(less, _twiddles(half, False))
        half //= 2
    return a


def _backward(a: np.ndarray) -> np.ndarray:
    """Inverse of ``_forward``, from its order."""
    m, n = a.shape
    half = 1
    while half < n:
        v = a.reshape(m, n // (2 * half), 2, half)
        low, high = v[:, :, 0], _times(v[:, :, 1], _twiddles(half, True))
        total, less = low + high, low + (_P - high)
        v[:, :, 0], v[:, :, 1] = np.minimum(total, total - _P), np.minimum(less, less - _P)
        half *= 2
    return _times(a, np.uint64(pow(n, -1, _PRIME)))


def _chains(j: np.ndarray, q: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and distances of blocks that follow each other at one distance."""
    order = np.lexsort((j, q))
    j, q = j[order], q[order]
    head = np.ones(len(j), bool)
    head[1:] = (q[1:] != q[:-1]) | (j[1:] != j[:-1] + 1)
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(j))[: len(at)] - 1
    return j[at] * block, (j[last] + 1) * block, q[at]


def _new(i: np.ndarray, e: np.ndarray, q: np.ndarray, runs: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds that lie in no known run whose period divides their distance."""
    order = np.argsort(i, kind="stable")
    i, e, q = i[order], e[order], q[order]
    start, end, period = runs[runs[:, 1] - runs[:, 0] >= 3 * block - 1].T
    first, stop = np.searchsorted(i, start), np.searchsorted(i, end)
    known = np.zeros(len(i), bool)
    count = stop - first
    cuts = np.searchsorted(np.cumsum(count), np.arange(0, int(count.sum()) + _CELLS, _CELLS))
    for a, b in zip(cuts[:-1].tolist(), np.maximum(cuts[1:], cuts[:-1] + 1).tolist(), strict=True):
        span = count[a:b]
        run = np.repeat(np.arange(a, min(b, len(count))), span)
        seed = np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span) + np.repeat(first[a:b], span)
        known[seed[(e[seed] + q[seed] <= end[run]) & (q[seed] % period[run] == 0)]] = True
    return i[~known], e[~known], q[~known]


def _checked(x: np.ndarray, i: np.ndarray, e: np.ndarray, q: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seeds' blocks that are equal word by word, as seeds."""
    count = (e - i) // block
    j = np.repeat(i // block - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    q = np.repeat(q, count)
    rows = max(1, _CELLS // block)
    good = np.zeros(len(j), bool)
    for k in range(0, len(j), rows):
        at = j[k : k + rows, None] * block + np.arange(block)
        good[k : k + rows] = (x[at] == x[at + q[k : k + rows, None]]).all(axis=1)
    return _chains(j[good], q[good], block)


def _reach(x: np.ndarray, at: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
    """How many places from ``at`` on, in steps, hold the same word as q places further."""
    out = np.zeros(len(at), np.int64)
    open_, width = np.arange(len(at)), 8
    while len(open_):
        more = []
        rows = max(1, _CELLS // width)
        for k in range(0, len(open_), rows):
            own = open_[k : k + rows]
            places = at[own, None] + step * (out[own, None] + np.arange(width))
            inside = (places >= 0) & (places + q[own, None] < len(x))
            places = np.where(inside, places, 0)
            same = (x[places] == x[places + np.where(inside, q[own, None], 0)]) & inside
            whole = same.all(axis=1)
            out[own] += np.where(whole, width, same.argmin(axis=1))
            more.append(own[whole])
        open_, width = np.concatenate(more), min(2 * width, 1 << 14)
    return out
