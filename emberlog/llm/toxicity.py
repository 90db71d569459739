"""Toxicity by a chain of linear classifiers.

The categories are predicted one after another. The model of a category sees the words
of a text and the probabilities of all categories before it in the chain. While
fitting, those come from models that did not see the row (out-of-fold), as the models
will meet unseen rows later; for prediction each category is fitted once more on all rows.

Features are the lower-cased words of the whole text and their first 4, 5 and 6
bytes, as present or absent. The ``FEATURES`` most telling of each category (chi-square over
the fitted rows) enter its logistic regression.

The chain is fitted on at most about ``FIT_DOCS`` labelled rows of each combination of
labels, drawn by a hash of the id; every whole text is scored.

Defined cases: null and empty texts have no words and get the probabilities of
an empty text; labelled rows whose document is missing or whose labels are null are
left out; without labelled rows of both kinds a category has the probability 0;
repeated labels count as often as they are given; further columns pass through.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.words import ALNUM, Chunk, chunks

FIT_DOCS = 3000
FEATURES = 2000
FOLDS = 4
STEPS = 150
PENALTY = 1e-3
THRESHOLD = 0.15  # of the last category, from which a text counts as toxic; out-of-fold, clean texts of check_s stay below 0.12
PREFIXES = [4, 5, 6]
_TABLE_BITS = 20


@dataclass
class Chain:
    categories: list[str]
    features: list[np.ndarray] = field(default_factory=list)  # sorted feature hashes of each category
    weights: list[np.ndarray] = field(default_factory=list)  # of the features, the earlier categories, the constant


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """``labels`` has the id column and a 0/1 column for each category, in the order of the chain."""
    rows = labels.select(F.col(id_col).alias("id"), *[F.col(c).cast("int") for c in categories]).dropna()
    kinds = rows.groupBy(*categories).count().collect()  # one row for each combination of labels
    if not kinds:
        return Chain(categories, [np.zeros(0, np.uint64)] * len(categories), [])
    share = F.lit(0)
    for kind in kinds:
        is_kind = F.lit(True)
        for c in categories:
            is_kind &= F.col(c) == kind[c]
        share = F.when(is_kind, int(min(1.0, FIT_DOCS / kind["count"]) * (1 << 30))).otherwise(share)
    drawn = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(drawn), "id")  # bounded by FIT_DOCS for each combination
    listed = joined.select("text", *categories).mapInArrow(_listed, ", ".join(["features binary", *[f"`{c}` int" for c in categories]]))
    # the bounded sample is fitted in one task, away from the driver
    fitted = listed.repartition(1).mapInArrow(partial(_fit_task, categories), "chain binary").collect()
    return pickle.loads(fitted[0][0])


def _fit_task(categories: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple] = []
    for batch in batches:
        found += zip(*[c.to_pylist() for c in batch.columns], strict=True)
    found.sort()  # the folds don't depend on the order of arrival
    rows = [np.frombuffer(r[0], np.uint64) for r in found]
    chain = _fitted(categories, rows, np.array([r[1:] for r in found], int).reshape(len(found), len(categories)))
    yield pa.record_batch([pa.array([pickle.dumps(chain)], pa.binary())], names=["chain"])


def predict(docs: DataFrame, chain: Chain, text_col: str = "text", column: str = "toxicity") -> DataFrame:
    """``docs`` and an array column (it replaces one of that name): the probability of each category, in the order of the chain."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES weights for each category
    schema = docs.withColumn(column, F.lit(None).cast("array<double>")).schema
    return docs.mapInArrow(partial(_predicted, docs.columns.index(text_col), shared), schema)


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word and word start, in no order and with repeats."""
    owner = chunk.text_of_word()
    kinds = chunk.prefix_hashes([len(chunk.buf), *PREFIXES])
    tags = [h ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for k, h in enumerate(kinds)]
    return np.tile(owner, len(tags)), np.concatenate(tags)


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.fill_null(""))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = []
        for chunk in chunks(_lowered(batch.column(0)), ALNUM, lower=False):
            owner, hashes = _features(chunk)
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(chunk.texts + 1))
            blobs += [np.unique(hashes[order[a:b]]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.record_batch([pa.array(blobs, pa.binary()), *batch.columns[1:]], names=["features", *batch.schema.names[1:]])


def _fitted(categories: list[str], rows: list[np.ndarray], labels: np.ndarray) -> Chain:
    chain, earlier = Chain(categories), np.zeros((len(rows), 0))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    known, number = np.unique(np.concatenate([*rows, np.zeros(0, np.uint64)]).astype(np.uint64), return_inverse=True)
    fold = np.arange(len(rows)) % FOLDS
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        if len(set(y.tolist())) < 2:
            chain.features.append(np.zeros(0, np.uint64))
            chain.weights.append(np.r_[np.zeros(k), -50.0 if not y.any() else 50.0])
            earlier = np.c_[earlier, y]
            continue
        outside = np.zeros(len(rows))
        for f in range(FOLDS):
            seen = fold != f
            used = _telling(number, owner, y, seen, len(known))
            x = _matrix(number, owner, used, len(rows), len(known), earlier)
            outside[~seen] = _sigmoid(x @ _regression(x, y, seen))[~seen]
        used = _telling(number, owner, y, np.ones(len(rows), bool), len(known))
        x = _matrix(number, owner, used, len(rows), len(known), earlier)
        chain.features.append(known[used])
        chain.weights.append(_regression(x, y, np.ones(len(rows), bool)))
        earlier = np.c_[earlier, outside]
    return chain


def _telling(number: np.ndarray, owner: np.ndarray, y: np.ndarray, seen: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the features with the largest chi-square, rising; at least three rows must have them."""
    of_seen = seen[owner]
    total = np.bincount(number[of_seen], minlength=n).astype(float)
    with_y = np.bincount(number[of_seen], y[owner[of_seen]], minlength=n)
    rows, positive = seen.sum(), y[seen].sum()
    expected = total * positive / rows
    spread = expected * (1 - positive / rows) * (1 - total / rows) + 1e-9
    score = np.where(total >= 3, (with_y - expected) ** 2 / spread, -1)
    best = np.argsort(-score, kind="stable")[:FEATURES]
    return np.sort(best[score[best] > 0])


def _matrix(number: np.ndarray, owner: np.ndarray, used: np.ndarray, rows: int, n: int, earlier: np.ndarray) -> np.ndarray:
    """Used features, probabilities of earlier categories and a constant, by row."""
    column = np.full(n, -1)
    column[used] = np.arange(len(used))
    has = column[number] >= 0
    out = np.zeros((rows, len(used) + earlier.shape[1] + 1), np.float32)
    out[owner[has], column[number[has]]] = 1
    out[:, len(used) : -1] = earlier
    out[:, -1] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _regression(x: np.ndarray, y: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Logistic regression on the seen rows with an L2 penalty (not on the constant), by accelerated gradient steps."""
    n, d = int(seen.sum()), x.shape[1]
    probe = np.ones(d, np.float32) / np.sqrt(d)
    for _ in range(12):  # largest curvature, by power iteration
        probe = x.T @ (x @ probe)
        size = np.linalg.norm(probe)
        probe /= max(size, 1e-12)
    rate = 1 / (size / (4 * n) * 1.05 + PENALTY)
    penalty = np.full(d, PENALTY)
    penalty[-1] = 0
    w, ahead, t = np.zeros(d), np.zeros(d), 1.0
    for _ in range(STEPS):
        error = np.where(seen, _sigmoid(x @ ahead.astype(np.float32)) - y, 0).astype(np.float32)
        new = ahead - rate * (x.T @ error / n + penalty * ahead)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w


class _Scorer:
    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.known = np.unique(np.concatenate([*chain.features, np.zeros(0, np.uint64)]).astype(np.uint64))
        self.maybe = np.zeros(1 << _TABLE_BITS, bool)  # most hashes are settled by one look
        self.maybe[self.known >> np.uint64(64 - _TABLE_BITS)] = True
        self.places = [np.searchsorted(self.known, f) for f in chain.features]

    def scores(self, chunk: Chunk) -> np.ndarray:
        owner, hashes = _features(chunk)
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - _TABLE_BITS)])
        at = np.searchsorted(self.known, hashes[some])
        real = self.known[np.minimum(at, max(len(self.known) - 1, 0))] == hashes[some] if len(self.known) else np.zeros(0, bool)
        pairs = np.unique(owner[some[real]] * len(self.known) + at[real]) if len(self.known) else np.zeros(0, np.int64)
        text, feature = (pairs // len(self.known), pairs % len(self.known)) if len(self.known) else (pairs, pairs)
        out = np.zeros((chunk.texts, len(self.chain.categories)))
        for k, weights in enumerate(self.chain.weights):
            n = len(self.places[k])
            full = np.zeros(len(self.known))
            full[self.places[k]] = weights[:n]
            sums = np.bincount(text, full[feature], minlength=chunk.texts)
            out[:, k] = _sigmoid(sums + out[:, :k] @ weights[n : n + k] + weights[-1])
        return out


def _predicted(place: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scorer = _Scorer(shared.value)
    for batch in batches:
        scores = [scorer.scores(chunk) for chunk in chunks(_lowered(batch.column(place)), ALNUM, lower=False)]
        flat = np.concatenate([*scores, np.zeros((0, len(scorer.chain.categories)))])
        width = flat.shape[1]
        lists = pa.ListArray.from_arrays(np.arange(0, len(flat) * width + 1, width, dtype=np.int32) if width else np.zeros(len(flat) + 1, np.int32), pa.array(flat.ravel()))
        yield pa.record_batch([*batch.columns, lists], names=[*batch.schema.names, "__scores"])
