"""Substring deduplication by counted Rabin-Karp window hashes.

Every window of ``width`` words of every whole text gets a 64-bit rolling hash.
Spark deals the hashes out by range, so the task of a range sees all documents of
each of its windows and finds those that also start in a document with a smaller
id. Repeated windows go back to their documents and merge into maximal removal
intervals. Each task sends a window once, with the smallest id it has seen; a
passage that a third of all rows share is one row per task. Windows travel in
packed arrays of one row per task and range.

Defined cases: null text has no words; a text shorter than a window loses
nothing; a null id counts as larger than every other id; rows with one id count
as one document and do not remove each other's words; tables may be empty and may
hold any further columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.words import SPACED, chunks, covered, grouped, mix, runs, slot, windows

WIDTH = 13
RANGE_BYTES = 8 << 20  # text whose windows one range holds, on average
LEAST_RANGES = 32
NO_ID = (1 << 63) - 1
_KEY, _HASHES = "__dedup_key", "__dedup_hashes"


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, column: str = "repeats") -> DataFrame:
    """``docs`` and a struct column, which replaces one of its name.

    Its fields: n_words, n_removed, spans (array of start and end word, end
    exclusive, maximal and in order) and kept (the kept words joined by one space).
    """
    return _applied(docs, id_col, text_col, width, column)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated words cut from the text; texts without repeats stay as they are.

    Every row stays; a text that repeats as a whole becomes empty.
    """
    out = repeated_spans(docs, id_col, text_col, width, "__repeats")
    text = F.when(F.col("__repeats.n_removed") > 0, F.col("__repeats.kept")).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).select(docs.columns)


def _applied(docs: DataFrame, id_col: str, text_col: str, width: int, column: str) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    ranges = max(LEAST_RANGES, -(-size // RANGE_BYTES))
    sent = docs.select(key.alias(_KEY), F.col(text_col).alias("text")).mapInArrow(
        partial(_sent, width, ranges), "range int, answered boolean, ids binary, hashes binary"
    )
    answers = sent.groupBy("range").applyInArrow(grouped(_answers, ranges), "part int, ids binary, hashes binary")
    marks = answers.groupBy("part").applyInArrow(grouped(_by_document), f"{_KEY} long, {_HASHES} binary")
    joined = docs.withColumn(_KEY, key).join(marks, _KEY, "left")
    columns = [c for c in docs.columns if c != column]
    schema = docs.select(columns).withColumn(column, F.lit(None).cast("struct<n_words:bigint,n_removed:bigint,spans:array<struct<start:int,end:int>>,kept:string>")).schema
    return joined.select(*columns, _HASHES).mapInArrow(partial(_described, width, columns, text_col, column), schema)


def _parcels(ids: np.ndarray, hashes: np.ndarray, slots: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    order = np.argsort(slots, kind="stable")
    ids, hashes, slots = ids[order], hashes[order], slots[order]
    cuts = np.flatnonzero(np.diff(slots)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(slots)]]), strict=True):
        if a < b:
            yield int(slots[a]), ids[a:b].tobytes(), hashes[a:b].tobytes()


def _later(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the smallest id of each hash, and of all pairs with a larger one; a pair counts once."""
    order = np.lexsort((ids, hashes))
    h, d = hashes[order], ids[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(d) else d
    once = new.copy()
    once[1:] |= d[1:] != d[:-1]
    return np.sort(order[new]), np.sort(order[once & (d > least)])


def _sent(width: int, ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(1), SPACED, lower=False):
            at, hashes = windows(chunk.hashes(), chunk.first, width)
            ids = keys[chunk.start : chunk.stop][chunk.text_of_word()[at]]
            least, later = _later(ids, hashes)
            rows = [(s, False, i, h) for s, i, h in _parcels(ids[least], hashes[least], slot(hashes[least], ranges))]
            owners = slot(mix(ids[later].astype(np.uint64)), ranges)
            rows += [(s, True, i, h) for s, i, h in _parcels(ids[later], hashes[later], owners)]
            yield _batch(rows, [("range", pa.int32()), ("answered", pa.bool_()), ("ids", pa.binary()), ("hashes", pa.binary())])


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _joined(parcels: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(parcels), kind)


def _answers(parts: int, table: pa.Table) -> pa.Table:
    done = table.column("answered").to_numpy()
    ids, hashes = table.column("ids").to_pylist(), table.column("hashes").to_pylist()
    asked_ids, asked = _joined(list(compress(ids, ~done)), np.int64), _joined(list(compress(hashes, ~done)), np.uint64)
    _, later = _later(asked_ids, asked)
    all_ids = np.concatenate([asked_ids[later], _joined(list(compress(ids, done)), np.int64)])
    found = np.concatenate([asked[later], _joined(list(compress(hashes, done)), np.uint64)])
    rows = list(_parcels(all_ids, found, slot(mix(all_ids.astype(np.uint64)), parts)))
    return pa.Table.from_batches([_batch(rows, [("part", pa.int32()), ("ids", pa.binary()), ("hashes", pa.binary())])])


def _by_document(table: pa.Table) -> pa.Table:
    ids = _joined(table.column("ids").to_pylist(), np.int64)
    hashes = _joined(table.column("hashes").to_pylist(), np.uint64)
    order = np.argsort(ids, kind="stable")
    rows = list(zip(*_grouped(ids[order], hashes[order]), strict=True))
    return pa.Table.from_batches([_batch(rows, [(_KEY, pa.int64()), (_HASHES, pa.binary())])])


def _grouped(ids: np.ndarray, hashes: np.ndarray) -> tuple[list[int], list[bytes]]:
    firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, int)
    lasts = np.append(firsts[1:], len(ids))
    return ids[firsts].tolist(), [hashes[a:b].tobytes() for a, b in zip(firsts, lasts, strict=True)]


def _described(width: int, columns: list[str], text_col: str, column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = columns.index(text_col)
    for batch in batches:
        texts, marks = batch.column(place), batch.column(len(columns))
        out: list[dict] = []
        for chunk in chunks(texts, SPACED, lower=False):
            gone = _removed(chunk, marks.slice(chunk.start, chunk.texts), width)
            for k in range(chunk.texts):
                flags = gone[chunk.first[k] : chunk.first[k + 1]]
                words = (texts[chunk.start + k].as_py() or "").encode().split()
                a, b = runs(flags)
                kept = b" ".join(compress(words, ~flags) if len(a) else words)
                spans = [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)]
                out.append({"n_words": len(words), "n_removed": int(flags.sum()), "spans": spans, "kept": kept.decode()})
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())])
        yield pa.record_batch([*batch.columns[: len(columns)], pa.array(out, kind)], names=[*columns, column])


def _removed(chunk, marks: pa.Array, width: int) -> np.ndarray:
    """Words of the chunk that a marked window covers."""
    n = len(chunk.starts)
    marked = np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False))
    if not len(marked):
        return np.zeros(n, bool)
    own = [np.frombuffer(marks[int(k)].as_py(), np.uint64) for k in marked]
    owners = np.repeat(marked, [len(x) for x in own])
    at, hashes = windows(chunk.hashes(), chunk.first, width)
    tagged = lambda h, k: mix(h ^ (k.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    hit = np.isin(tagged(hashes, chunk.text_of_word()[at]), tagged(np.concatenate(own), owners))
    return covered(at[hit], width, n)
