"""Language identification by nearest centroids.

A text is a vector of hashed letter n-grams (two and three bytes of lower-cased
UTF-8, everything but letters as one blank), weighted by TF-IDF and scaled to length
one. Each language has several centroids, found by spherical k-means, so that
styles of one language keep centroids of their own. The nearest centroid by
cosine gives the language; a text farther from it than nearly all training texts were
is marked as rejected.

The model is fitted on at most about ``FIT_DOCS`` labelled rows of each language,
drawn by a hash of the row's key; prediction reads every whole text.

Defined cases: null text and text without a letter are ``und`` with score 0;
without labelled rows everything is ``und``; rows with null labels are not
learned from; ties go to the language that sorts first; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.words import strings

FIT_DOCS = 600
CENTROIDS = 4
DIMENSIONS = 4096
ROUNDS = 12
REJECT_SHARE = 0.002  # of training texts that lie outside the accepted distance
_CHUNK_BYTES = 2 << 20
_LETTER = regex.compile(r"\p{L}")
_ALL = np.arange(256)
_FOLDED = np.where(((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80), _ALL, 0x20).astype(np.uint8)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row for each centroid
    owner: np.ndarray  # language number of each centroid
    least: np.ndarray  # cosine below which a text is rejected, by language


def fit(docs: DataFrame, key: Column, lang_col: str = "lang", text_col: str = "text") -> Model:
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row for each language
    if not counts:
        return Model([], np.ones(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, FIT_DOCS / n) * (1 << 30)))])
    drawn = rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.element_at(share, F.col(lang_col)))
    found = drawn.select(F.col(lang_col), F.col(text_col)).mapInArrow(_counted, "lang string, counts binary").collect()
    counted = np.stack([_dense(r["counts"]) for r in found]) if found else np.zeros((0, DIMENSIONS), np.float32)
    idf = (np.log((1 + len(found)) / (1 + (counted > 0).sum(axis=0))) + 1).astype(np.float32)
    vectors = _weighted(counted, idf)
    names = np.array([r["lang"] for r in found])
    languages = sorted(set(names.tolist()))
    centroids, owner, least = [], [], []
    for k, name in enumerate(languages):
        own = vectors[names == name]
        c = _clustered(own)
        centroids.append(c)
        owner += [k] * len(c)
        least.append(np.quantile((own @ c.T).max(axis=1), REJECT_SHARE))
    return Model(languages, idf, np.concatenate(centroids), np.array(owner), np.array(least))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` and a struct column ``language`` (it replaces one of that name): lang, score (0 to 1), rejected."""
    docs = docs.drop("language")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # centroids only
    schema = docs.withColumn("language", F.lit(None).cast("struct<lang:string,score:double,rejected:boolean>")).schema
    return docs.mapInArrow(partial(_predicted, docs.columns.index(text_col), shared), schema)


def _clustered(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means; each start is the vector farthest from those before it."""
    centres = [vectors.mean(axis=0)]
    for _ in range(min(CENTROIDS, len(vectors)) - 1):
        centres.append(vectors[np.argmin((vectors @ np.stack(centres).T).max(axis=1))])
    c = np.stack(centres)
    for _ in range(ROUNDS):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        nearest = (vectors @ c.T).argmax(axis=1)
        c = np.stack([vectors[nearest == k].mean(axis=0) if (nearest == k).any() else c[k] for k in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _parts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First row and n-gram counts of runs of whole texts."""
    raw, at = strings(pc.utf8_lower(column.fill_null("")))
    start, n = 0, len(at) - 1
    while start < n:
        stop = min(n, max(start + 1, int(np.searchsorted(at, at[start] + _CHUNK_BYTES, side="right")) - 1), start + 1024)
        stop = min(stop, start + 1024)
        yield start, _counts(raw[at[start] : at[stop]], at[start : stop + 1] - at[start])
        start = stop


def _counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    texts = len(at) - 1
    codes = np.concatenate([_FOLDED[raw], [0x20, 0x20]]).astype(np.uint32)
    own = np.repeat(np.arange(texts), np.diff(at))
    room = np.repeat(at[1:], np.diff(at)) - np.arange(len(raw))  # bytes left in the text
    out = np.zeros(texts * DIMENSIONS, np.float32)
    two = codes[:-2] | codes[1:-1] << 8
    three = two | codes[2:] << 16
    for n, gram in ((2, two), (3, three)):
        real = (room >= n) & ((gram & 0xFFFF) != 0x2020)
        if n == 3:
            real &= (gram >> 8) != 0x2020
        place = (gram[real] * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA6B) >> np.uint32(20)
        out += np.bincount(own[real] * DIMENSIONS + place, minlength=len(out)).astype(np.float32)
    return out.reshape(texts, DIMENSIONS)


def _dense(blob: bytes) -> np.ndarray:
    out = np.zeros(DIMENSIONS, np.float32)
    pairs = np.frombuffer(blob, "<u4").reshape(2, -1)
    out[pairs[0]] = pairs[1]
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = []
        for _, counts in _parts(batch.column(1)):
            for row in counts:
                used = np.flatnonzero(row)
                blobs.append(np.stack([used, row[used]]).astype("<u4").tobytes())
        yield pa.record_batch([batch.column(0), pa.array(blobs, pa.binary())], names=["lang", "counts"])


def _predicted(place: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    for batch in batches:
        texts = batch.column(place)
        rows: list[dict] = []
        for start, counts in _parts(texts):
            if len(model.centroids):
                cosines = _weighted(counts, model.idf) @ model.centroids.T
                best = cosines.argmax(axis=1)
                scores = cosines[np.arange(len(best)), best]
            for k in range(len(counts)):
                text = texts[start + k].as_py()
                if not len(model.centroids) or text is None or not _LETTER.search(text):
                    rows.append({"lang": "und", "score": 0.0, "rejected": True})
                    continue
                language = int(model.owner[best[k]])
                score = float(min(1.0, max(0.0, scores[k])))
                rows.append({"lang": model.languages[language], "score": score, "rejected": score < float(model.least[language])})
        yield pa.record_batch([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, "language"])
