"""Benchmark decontamination by suffix arrays over the training text.

Each task cuts its documents into shards of whole texts and sorts the word
suffixes of a shard into a suffix array. Every benchmark suffix that is long
enough for a window is binary-searched in every shard; the places found are
extended to longest verbatim matches with their locations. A suffix that starts
with fewer benchmark words than the shortest window cannot hold a match and is
left out of the array. Nothing is shuffled: benchmark items go to the tasks in
blocks of bounded size, one pass for each block.

A window is ``width`` consecutive words of an item; an item with fewer words, but
not none, is one window. A document is contaminated if its hit words are at
least a twentieth of its words.

Defined cases: null text has no words; items without words or without an id are
left out; items that share an id count once; empty tables give no matches;
further columns pass through, whatever their names. Rows and ties need no order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.words import ALNUM, Chunk, chunks, covered

WIDTH = 13
SHARE = 20  # contaminated from one hit word in so many words
BLOCK_BYTES = 16 << 20  # benchmark text sent to the tasks at once
SHARD_BYTES = 8 << 20
_MATCH = pa.struct([("item_id", pa.int64()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())])
_MATCHES = "array<struct<item_id:bigint,item_start:int,doc_start:int,n_words:int>>"


class Items:
    """Words of a block of benchmark items and the suffixes to search for."""

    def __init__(self, ids: list[int], texts: list[str], width: int) -> None:
        hashes, of_item, item_ids = [], [], []
        for chunk in chunks(pa.array(texts, pa.large_string()), ALNUM, lower=True, size=1 << 62):
            hashes.append(chunk.hashes())
            of_item.append(chunk.text_of_word() + chunk.start)
        words = np.concatenate([*hashes, np.zeros(0, np.uint64)]).astype(np.uint64)
        item = np.concatenate([*of_item, np.zeros(0, np.int64)]).astype(np.int64)
        self.vocabulary = np.unique(words)
        sizes = np.bincount(item, minlength=len(ids)) if len(item) else np.zeros(len(ids), np.int64)
        first = np.cumsum(sizes) - sizes
        self.offset = np.arange(len(words)) - first[item]
        self.rest = sizes[item] - self.offset
        self.item = item
        self.ids = np.array(ids, np.int64)
        self.need = np.minimum(width, sizes)[item]  # window length of the word's item
        self.suffixes = np.flatnonzero(self.rest >= self.need)
        self.shortest = int(self.need.min()) if len(words) else 0
        self.words = np.concatenate([self.number(words), np.zeros(width + 1, np.int64)])

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers from 1; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` and the columns n_words, n_hit, matches, contaminated, which replace columns of these names.

    ``matches`` holds the longest verbatim matches: item, word number in it, word
    number in the document, length in words.
    """
    out = _searched_all(docs, benchmark, text_col, item_col, item_text_col, width)
    own = ["n_words", "n_hit", "matches", "contaminated"]
    return out.select(*[c for c in docs.columns if c not in own], *[F.col(f"__{c}").alias(c) for c in own])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` that are not contaminated."""
    return _searched_all(docs, benchmark, text_col, "item_id", "text", WIDTH).filter("not __contaminated").select(docs.columns)


def _searched_all(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, width: int) -> DataFrame:
    spark, columns = docs.sparkSession, docs.columns
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).filter("id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = docs.withColumn("__n_words", F.lit(0).cast("long")).withColumn("__n_hit", F.lit(0).cast("long")).withColumn("__matches", F.array().cast(_MATCHES))
    schema = out.schema
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()  # about BLOCK_BYTES
        block = spark.sparkContext.broadcast(Items([r[0] for r in rows], [r[1] for r in rows], width))
        out = out.mapInArrow(partial(_searched, columns.index(text_col), block), schema)
    hit = F.col("__n_hit")
    return out.withColumn("__contaminated", (hit > 0) & (hit * SHARE >= F.col("__n_words")))


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``words`` in order, by prefix doubling."""
    n = len(words)
    rank, step, order = words.astype(np.int64), 1, np.zeros(0, np.int64)
    while n:
        new = np.ones(n, np.int64)
        nexts = np.zeros(n, np.int64)
        nexts[: max(0, n - step)] = rank[step:] + 1
        order = np.lexsort((nexts, rank))
        new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (nexts[order[1:]] != nexts[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        step *= 2
        if rank[order[-1]] == n - 1 or step >= 2 * n:
            break
    return order


def _bounds(shard: np.ndarray, order: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Range of the array whose suffixes begin with the window at each searched item suffix."""
    width = int(items.need.max())
    steps = np.arange(width)
    padded = np.concatenate([shard, np.full(width, -1)])
    wanted = items.words[items.suffixes[:, None] + steps]
    used = steps < items.need[items.suffixes][:, None]
    out = []
    for above in (False, True):
        lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            there = padded[order[np.minimum(mid, len(order) - 1)][:, None] + steps]
            differs = (there != wanted) & used
            k = np.where(differs.any(axis=1), differs.argmax(axis=1), -1)
            row = np.arange(len(wanted))
            less = np.where(k >= 0, there[row, k] < wanted[row, k], above)
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        out.append(lo)
    return out[0], out[1]


def _matches(chunk: Chunk, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number in the shard, word number in the items, length of every longest match."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(items.suffixes) or not len(chunk.starts):
        return none
    words = items.number(chunk.hashes())
    n = len(words)
    stops = np.zeros(n + 1, bool)
    stops[:n] = words == 0
    stops[chunk.first] = True
    ends = np.flatnonzero(stops)
    known = np.flatnonzero(words > 0)
    reach = ends[np.searchsorted(ends, known, side="right")] - known  # words up to the next unknown word or text
    begin = known == 0
    begin |= stops[known] | (words[np.maximum(known, 1) - 1] == 0)
    run = np.cumsum(begin)
    long = reach[begin][run - 1] >= items.shortest if len(run) else np.zeros(0, bool)
    known, begin = known[long], begin[long]
    if not len(known):
        return none
    shard = np.zeros(len(known) + int(begin.sum()), np.int64)  # runs, each after a zero
    at = np.arange(len(known)) + np.cumsum(begin)
    shard[at] = words[known]
    place = np.full(len(shard), -1, np.int64)
    place[at] = known
    order = suffix_array(shard)
    lo, hi = _bounds(shard, order, items)
    found = hi - lo
    which = np.repeat(np.arange(len(found)), found)
    p = order[np.repeat(lo - np.cumsum(found) + found, found) + np.arange(len(which))]
    s = items.suffixes[which]
    left = (items.offset[s] > 0) & (shard[p - 1] == items.words[s - 1])  # goes on to the left: part of a longer match
    p, s = p[~left], s[~left]
    length, end = items.need[s].copy(), np.append(shard, [0])
    more = np.arange(len(p))
    while len(more):
        x = length[more]
        go = (x < items.rest[s[more]]) & (end[np.minimum(p[more] + x, len(shard))] == items.words[np.minimum(s[more] + x, len(items.words) - 1)])
        more = more[go]
        length[more] += 1
    return place[p], s, length


def _searched(place: int, block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = block.value
    for batch in batches:
        names = batch.schema.names
        n_words, n_hit, matches = [], [], []
        earlier = batch.column(len(names) - 1)
        for chunk in chunks(batch.column(place), ALNUM, lower=True, size=SHARD_BYTES):
            at, suffix, length = _matches(chunk, items)
            text = np.searchsorted(chunk.first, at, side="right") - 1
            found: dict[int, list[dict]] = {}
            for k, w, s, x in zip(text.tolist(), at.tolist(), suffix.tolist(), length.tolist(), strict=True):
                found.setdefault(k, []).append({"item_id": int(items.ids[items.item[s]]), "item_start": int(items.offset[s]), "doc_start": int(w - chunk.first[k]), "n_words": x})
            sizes = np.diff(chunk.first)
            for k in range(chunk.texts):
                own = (earlier[chunk.start + k].as_py() or []) + found.get(k, [])
                n_words.append(int(sizes[k]))
                matches.append(own)
                n_hit.append(int(covered(np.array([m["doc_start"] for m in own]), np.array([m["n_words"] for m in own]), int(sizes[k])).sum()) if own else 0)
        new = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(matches, pa.list_(_MATCH))]
        yield pa.record_batch([*batch.columns[:-3], *new], names=names)
