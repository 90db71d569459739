"""Token-id files: flat unsigned integers and 64-bit document offsets.

A data set is a folder of parts. ``part-k.bin`` holds the ids of its documents one
after another, two bytes each if the vocabulary allows it, else four; ``part-k.idx``
holds the offsets of the documents in the part and one more at the end;
``part-k.doc`` their document ids. ``manifest.json`` lists the parts in order with
the number of ids before each, a prefix sum over the parts, so that the global
offset of a document is the base of its part plus its own. Readers memory-map local
files and read byte ranges of others.

Texts are encoded piece by piece: each distinct piece of a chunk of texts goes to the
tokenizer once, and a worker keeps the pieces it has met in a table of bounded
size. Encoded documents are dealt by ranges of document id, cut so that parts hold about as many
bytes, one part to a task, and written in that order as they come, so no task holds a range in memory, and a part is written
again as a whole if its executor is lost.

Added tokens of the vocabulary (such as ``<|endoftext|>``) that stand in a text get their own id, as
the tokenizer gives it, and the text between them is encoded by itself. Added tokens that strip
their surroundings or must be words of their own are refused.

Defined cases: null text is empty (its ids are the end id alone); null ids come
first; rows with one id keep both, ordered by a checksum of their ids; an empty
table gives a manifest without parts; further columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.pieces import Pieces, split
from emberlog.llm.words import strings

CHUNK_BYTES = 1 << 20
KNOWN_BYTES = 112 << 20  # of the pieces a Python worker keeps; then it starts anew
PART_BYTES = 64 << 20
FINE = 16  # ranges of documents per part whose bytes are summed to cut parts by bytes
NO_ID = -(1 << 63)
_ENTRY_BYTES = 180  # of a kept piece, besides its ids: hash, bytes object and place in the table


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of each whole text, and the end id if there is one, to ``path``, a folder that all executors share."""
    kind = _kind(vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    edges = _edges(rows, parts, size)
    encoded = rows.mapInArrow(partial(_encoded, vocabulary, end_id, kind, edges), "part int, doc_id long, ids binary")
    dealt = encoded.withColumn("check", F.crc32("ids")).repartitionById(parts, F.col("part"))  # a task for each part
    ordered = dealt.sortWithinPartitions("part", "doc_id", "check").select("part", "doc_id", "ids")
    found = ordered.mapInArrow(partial(_written, path, kind), "part int, name string, n_docs long, n_tokens long").collect()
    found.sort(key=lambda r: r.part)  # one row for each part
    bases = [0, *accumulate(r.n_tokens for r in found)]
    manifest = {"dtype": kind, "n_tokens": bases[-1], "parts": [{"name": r.name, "n_docs": r.n_docs, "n_tokens": r.n_tokens, "base": b} for r, b in zip(found, bases, strict=False)]}
    _put(f"{path}/manifest.json", [json.dumps(manifest).encode()])


def _edges(rows: DataFrame, parts: int, size: int) -> np.ndarray:
    """Document ids at which a new part begins, so that parts hold about as many bytes.

    Quantiles of the ids cut the table into ``FINE`` ranges for each part; their bytes are summed in the tasks,
    and neighbouring ranges join until they hold the share of a part.
    """
    if parts < 2:
        return np.zeros(0, np.int64)
    n = FINE * parts
    found = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)).first()[0]
    fine = np.unique(np.array(found or [], np.int64))
    lengths = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    sums = lengths.mapInArrow(partial(_range_bytes, fine), "range int, bytes long").groupBy("range").agg(F.sum("bytes").alias("bytes"))
    bytes_of = np.zeros(len(fine) + 1, np.int64)
    for r in sums.collect():  # one row for each range
        bytes_of[r["range"]] = r["bytes"]
    part = np.minimum(np.cumsum(bytes_of) * parts // max(size, 1), parts - 1)
    return fine[np.flatnonzero(np.diff(part) > 0)]


def _range_bytes(fine: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(len(fine) + 1, np.int64)
    for batch in batches:
        place = np.searchsorted(fine, batch.column(0).fill_null(NO_ID).to_numpy(), side="right")
        np.add.at(sums, place, batch.column(1).to_numpy())
    some = np.flatnonzero(sums)
    yield pa.record_batch([pa.array(some, pa.int32()), pa.array(sums[some], pa.int64())], names=["range", "bytes"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (packed as in the file), read from the files."""
    return _read(spark, path, _document_rows, "doc_id long, start long, n_tokens long, ids binary")


def read_checks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, and the CRC-32 of each document's ids as little-endian 32-bit integers."""
    return _read(spark, path, _check_rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read(spark: SparkSession, path: str, rows, schema: str) -> DataFrame:
    manifest = json.loads(bytes(_get(f"{path}/manifest.json")))
    parts = [(p["name"], p["base"]) for p in manifest["parts"]]
    listed = spark.createDataFrame(parts, "name string, base long").repartition(max(1, len(parts)))
    return listed.mapInArrow(partial(_opened, path, manifest["dtype"], rows), schema)


def _kind(vocabulary: str) -> str:
    return "<u2" if _tokenizer(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"


@lru_cache(2)
def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True  # added tokens are cut out before pieces go to the tokenizer
    return tokenizer


@lru_cache(2)
def _added(vocabulary: str) -> tuple[re.Pattern, dict[bytes, int]]:
    """Pattern of the added tokens, of several at one place the longest, and their ids."""
    found = _tokenizer(vocabulary).get_added_tokens_decoder()
    for token in found.values():
        if token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"added token {token.content!r} depends on its surroundings")
    ids = {token.content.encode(): k for k, token in found.items() if token.content}
    return re.compile(b"|".join(re.escape(x) for x in sorted(ids, key=len, reverse=True)) or rb"(?!)"), ids


class _Known:
    """Ids of the pieces a Python worker has met, packed, by the hash of the piece."""

    def __init__(self, vocabulary: str, kind: str) -> None:
        self.tokenizer, self.kind, self.ids, self.bytes = _tokenizer(vocabulary), kind, {}, 0
        self.pattern, self.added = _added(vocabulary)

    def cuts(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Begins, ends and ids of the added tokens in the texts."""
        buf = raw.tobytes()
        found = [m for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) for m in self.pattern.finditer(buf, a, b)] if self.pattern.search(buf) else []
        return np.array([m.start() for m in found], np.int64), np.array([m.end() for m in found], np.int64), [self.added[m[0]] for m in found]

    def lookup(self, pieces: Pieces, hashes: np.ndarray, firsts: np.ndarray) -> list[bytes]:
        if self.bytes > KNOWN_BYTES:
            self.ids.clear()
            self.bytes = 0
        keys = hashes.tolist()
        missing = [k for k, h in enumerate(keys) if h not in self.ids]
        if missing:
            texts = [pieces.text(int(firsts[k])) for k in missing]
            for k, e in zip(missing, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                self.ids[keys[k]] = own = np.array(e.ids, self.kind).tobytes()
                self.bytes += _ENTRY_BYTES + len(own)
        return [self.ids[h] for h in keys]


@lru_cache(1)
def _known(vocabulary: str, kind: str) -> _Known:
    return _Known(vocabulary, kind)


def _encoded(vocabulary: str, end_id: int | None, kind: str, edges: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _known(vocabulary, kind)
    for batch in batches:
        raw, at = strings(batch.column(1))
        parts = np.searchsorted(edges, batch.column(0).fill_null(NO_ID).to_numpy(), side="right")
        start, n = 0, batch.num_rows
        while start < n:
            stop = min(n, max(start + 1, int(np.searchsorted(at, at[start] + CHUNK_BYTES, side="right")) - 1))
            ids, sizes = _ids(known, raw[at[start] : at[stop]], at[start : stop + 1] - at[start], end_id)
            width = ids.dtype.itemsize
            offsets = np.concatenate([[0], np.cumsum(sizes) * width]).astype(np.int64)
            packed = pa.Array.from_buffers(pa.large_binary(), stop - start, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
            part = pa.array(parts[start:stop], pa.int32())
            yield pa.record_batch([part, batch.column(0).slice(start, stop - start), packed.cast(pa.binary())], names=["part", "doc_id", "ids"])
            start = stop


def _ids(known: _Known, raw: np.ndarray, at: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the number of each."""
    begins, ends, added = known.cuts(raw, at)
    parts = np.sort(np.concatenate([at, begins, ends]))  # added tokens and what lies between them
    pieces = split(raw, parts)
    first = pieces.first[np.searchsorted(parts, at)]  # of each text; empty parts have no pieces
    hashes = pieces.hashes()
    distinct, firsts, which = np.unique(hashes, return_index=True, return_inverse=True)
    own = known.lookup(pieces, distinct, firsts)
    if added:  # the first piece of an added token stands for all of it
        place = np.searchsorted(parts, begins, side="right") - 1
        head, stop = pieces.first[place], pieces.first[place + 1]
        inside = np.zeros(len(which) + 1, np.int64)
        np.add.at(inside, head, 1)
        np.add.at(inside, stop, -1)
        numbers, number = np.unique(added, return_inverse=True)
        which[np.cumsum(inside)[:-1] > 0] = len(own)
        which[head] = len(own) + 1 + number
        own += [b"", *[np.array([k], known.kind).tobytes() for k in numbers]]
    if end_id is not None:
        own.append(np.array([end_id], known.kind).tobytes())
        which = np.insert(which, first[1:], len(own) - 1)
    sizes = np.array([len(x) for x in own], np.int64) // np.dtype(known.kind).itemsize
    flat = np.frombuffer(b"".join(own), known.kind)
    begins = np.cumsum(sizes) - sizes
    count = sizes[which]
    upto = np.concatenate([[0], np.cumsum(count)])
    ids = flat[np.repeat(begins[which] - upto[:-1], count) + np.arange(upto[-1])]
    edges = first + (np.arange(len(at)) if end_id is not None else 0)
    return ids, np.diff(upto[edges])


def _written(path: str, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write the parts of a partition one after another; a part may run over several batches."""
    open_part: _Part | None = None
    for batch in batches:
        parts = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if open_part and open_part.number != parts[a]:
                yield open_part.close()
                open_part = None
            open_part = open_part or _Part(path, kind, int(parts[a]))
            open_part.add(batch.slice(a, b - a))
    if open_part:
        yield open_part.close()


class _Part:
    def __init__(self, path: str, kind: str, number: int) -> None:
        # a second attempt writes files of its own
        self.number, self.name = number, f"part-{number:06d}-{uuid.uuid4().hex[:8]}"
        self.path, self.width = f"{path}/{self.name}", np.dtype(kind).itemsize
        fs, place = _store(self.path)
        fs.create_dir(os.path.dirname(place), recursive=True)
        self.out, self.sizes, self.documents = fs.open_output_stream(f"{place}.bin"), [0], []

    def add(self, batch: pa.RecordBatch) -> None:
        for x in batch.column(2):
            blob = x.as_buffer()
            self.out.write(blob)
            self.sizes.append(blob.size // self.width)
        self.documents.append(batch.column(1).fill_null(NO_ID).to_numpy())

    def close(self) -> pa.RecordBatch:
        self.out.close()
        offsets = np.cumsum(self.sizes).astype("<u8")
        _put(f"{self.path}.idx", [offsets.tobytes()])
        _put(f"{self.path}.doc", [np.concatenate(self.documents).astype("<i8").tobytes()])
        return pa.record_batch(
            [pa.array([self.number], pa.int32()), pa.array([self.name]), pa.array([len(offsets) - 1], pa.int64()), pa.array([int(offsets[-1])], pa.int64())],
            names=["part", "name", "n_docs", "n_tokens"],
        )


def _opened(path: str, kind: str, rows, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = _mapped(f"{path}/{name}.bin", kind)
            offsets = _mapped(f"{path}/{name}.idx", "<u8").astype(np.int64)
            documents = _mapped(f"{path}/{name}.doc", "<i8")
            for a in range(0, len(documents), 5000):
                b = min(a + 5000, len(documents))
                yield rows(ids, offsets[a : b + 1], documents[a:b], base)


def _heads(offsets: np.ndarray, documents: np.ndarray, base: int) -> list[pa.Array]:
    return [pa.array(documents, pa.int64(), mask=documents == NO_ID), pa.array(base + offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64())]


def _document_rows(ids, offsets, documents, base) -> pa.RecordBatch:
    own = pa.array([ids[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
    return pa.record_batch([*_heads(offsets, documents, base), own], names=["doc_id", "start", "n_tokens", "ids"])


def _check_rows(ids, offsets, documents, base) -> pa.RecordBatch:
    own = pa.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.int64())
    return pa.record_batch([*_heads(offsets, documents, base), own], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _store(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path.removeprefix('file:'))}")


def _put(path: str, blobs: list[bytes]) -> None:
    fs, place = _store(path)
    fs.create_dir(os.path.dirname(place), recursive=True)
    with fs.open_output_stream(place) as out:
        for blob in blobs:
            out.write(blob)


def _get(path: str):
    fs, place = _store(path)
    with fs.open_input_file(place) as source:
        return source.read()


def _mapped(path: str, kind: str) -> np.ndarray:
    from pyarrow.fs import LocalFileSystem

    fs, place = _store(path)
    if not isinstance(fs, LocalFileSystem):
        return np.frombuffer(_get(path), kind)
    return np.memmap(place, kind, "r") if os.path.getsize(place) else np.zeros(0, kind)
