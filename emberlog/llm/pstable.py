"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are scaled to length one. A table hashes a vector to the integer parts of
several random projections divided by a width; vectors that agree in all of them
share a bucket. Every pair in a bucket is checked by its exact cosine in double
precision. Cosine 0.9 is a distance of 0.447, where one projection agrees with
probability ``_NEAR`` for the width used and ``_FAR`` at right angles. With n vectors
a table takes ln(n) / -ln(_FAR) projections, so that a vector meets about one unrelated
vector in each bucket at any n, and there are as many tables as leave ``MISSED`` of the
pairs at exactly the threshold unfound; closer pairs are found more often.

Equal vectors are one vector with a count. A bucket of more than ``BLOCK`` vectors is cut
into blocks, which meet two by two in separate tasks. A pair counts in the first
table where it meets, so links are summed, never listed; for components a block gives
each vector one link to the smallest id it is connected with there.

Defined cases: a vector that is null, zero or holds null or non-finite components has no
links and is its own component; vectors of different lengths do not link; null ids do not
count as smallest ids unless all are null; tables may be empty; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.components import components
from emberlog.sources.scratch import staged

COSINE = 0.9
WIDTH = 2.5
MISSED = 0.05
BLOCK = 512
LEAST_PROJECTIONS = 8
_SEED = 77


def agreement(distance: float, width: float) -> float:
    """Probability that one projection of two vectors at ``distance`` agrees."""
    r = width / distance
    normal = 0.5 * (1 + erf(-r / sqrt(2)))
    return 1 - 2 * normal - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    projections: int
    tables: int
    cosine: float
    width: float

    @classmethod
    def of(cls, vectors: int, cosine: float = COSINE, width: float = WIDTH, missed: float = MISSED) -> Tables:
        near, far = agreement(sqrt(2 - 2 * cosine), width), agreement(sqrt(2), width)
        projections = max(LEAST_PROJECTIONS, ceil(log(max(vectors, 2)) / -log(far)))
        return cls(projections, ceil(log(missed) / log(1 - near**projections)), cosine, width)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """32-bit bucket of each vector in each table."""
        random = np.random.default_rng([_SEED, vectors.shape[1]])
        lines = random.standard_normal((vectors.shape[1], self.tables * self.projections))
        shifts = random.uniform(0, self.width, self.tables * self.projections)
        odd = random.integers(1, 1 << 62, self.projections, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        cells = np.floor((vectors @ lines + shifts) / self.width).astype(np.int64).astype(np.uint64)
        sums = (cells.reshape(len(vectors), self.tables, self.projections) * odd).sum(axis=2, dtype=np.uint64)
        return ((sums * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id, kept."""
    spark = table.sparkSession
    kind = "<f4" if table.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    known = rows.mapInArrow(partial(_packed, kind), "vec_id long, vector binary")
    known = staged(known, "vectors")
    groups = known.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    groups = staged(groups.withColumn("gid", F.xxhash64("vector")), "distinct")  # rep may be null
    rule = Tables.of(groups.count(), cosine)
    keyed = staged(groups.mapInArrow(partial(_keyed, rule, kind), "gid long, n long, vector binary, keys binary"), "keys")
    buckets = keyed.select("gid", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(rule.tables)), lambda t: F.substring("keys", (t - 1) * 4 + 1, F.lit(4)))).alias("table", "key"))
    sizes = buckets.groupBy("table", "key").agg(F.count("*").alias("size")).filter("size > 1")
    met = buckets.join(sizes, ["table", "key"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("gid"), blocks).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("gid", "table", F.col("own"), F.xxhash64("table", "key", F.least("own", "other"), F.greatest("own", "other")).alias("block"))
    dealt = met.join(keyed, "gid").repartition("block").sortWithinPartitions("block")
    found = dealt.select("block", "table", "own", "gid", "n", "vector", "keys").mapInArrow(partial(_met, rule, kind), "gid long, links long, other long")
    found = staged(found, "links")
    counts = found.groupBy("gid").agg(F.sum("links").alias("links"))
    parts = components(found.filter("other is not null").select(F.col("gid").alias("a"), F.col("other").alias("b")))
    named = groups.join(counts, "gid", "left").join(parts, groups.gid == parts.id, "left")
    named = named.select("vector", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "gid").alias("part"))
    roots = named.groupBy("part").agg(F.min("rep").alias("root"))
    named = named.join(roots, "part").select("vector", "n_links", "root")
    out = known.join(named, "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("root"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _packed(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of each vector; null where it has no direction."""
    for batch in batches:
        blobs = []
        for x in batch.column(1):
            v = np.array(x.as_py() if x.is_valid else [], float)  # null components become nan
            blobs.append(v.astype(kind).tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
        yield pa.record_batch([batch.column(0), pa.array(blobs, pa.binary())], names=["vec_id", "vector"])


def _units(blobs: list, kind: str) -> np.ndarray:
    """Vectors of length one, in double precision; shorter ones end in zeros."""
    size = np.dtype(kind).itemsize
    v = np.zeros((len(blobs), max(len(b) for b in blobs) // size))
    for k, b in enumerate(blobs):
        v[k, : len(b) // size] = np.frombuffer(b, kind)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _keyed(rule: Tables, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector").to_pylist()
        lengths = np.array([len(u) for u in vectors])
        keys: list[bytes] = [b""] * len(vectors)
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            for a in range(0, len(own), 2000):
                some = own[a : a + 2000]
                for k, row in zip(some.tolist(), rule.keys(_units([vectors[k] for k in some.tolist()], kind)), strict=True):
                    keys[k] = row.tobytes()
        yield pa.record_batch([batch.column("gid"), batch.column("n"), batch.column("vector"), pa.array(keys, pa.binary())], names=["gid", "n", "vector", "keys"])


def _met(rule: Tables, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        if not len(blocks):
            continue
        others = np.flatnonzero(blocks != blocks[-1])
        last = int(others[-1]) + 1 if len(others) else 0  # where the last block of the batch begins
        if last == 0 and held and held[-1].column(0)[0].as_py() != blocks[0]:
            yield from _pairs(rule, kind, pa.Table.from_batches(held))
            held = []
        if last:
            yield from _pairs(rule, kind, pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = []
        held.append(batch.slice(last))
    if held:
        yield from _pairs(rule, kind, pa.Table.from_batches(held))


def _pairs(rule: Tables, kind: str, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links of whole blocks: counts for each vector, and links that connect them."""
    block = table.column("block").to_numpy()
    begins = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    sizes = np.diff(np.append(begins, len(block)))
    names = {c: table.column(c).to_numpy() for c in ("table", "own", "gid", "n")}
    vectors, keys = table.column("vector").combine_chunks(), table.column("keys").combine_chunks()
    for n in np.unique(sizes[sizes > 1]).tolist():
        step = max(1, 200_000 // (n * n))
        starts = begins[sizes == n]
        for a in range(0, len(starts), step):
            at = (starts[a : a + step][:, None] + np.arange(n)).ravel()
            yield _same_size(rule, kind, names, vectors, keys, at, n)


def _same_size(rule: Tables, kind: str, names: dict, vectors, keys, at: np.ndarray, n: int) -> pa.RecordBatch:
    """``at`` holds whole blocks of ``n`` rows."""
    gid, own, number, weight = (names[c][at].reshape(-1, n) for c in ("gid", "own", "table", "n"))
    blobs = [vectors[k].as_buffer() for k in at.tolist()]
    v = _units(blobs, kind)
    lengths = np.array([len(b) for b in blobs]).reshape(-1, n)
    v = v.reshape(-1, n, v.shape[1])
    cosine = v @ v.transpose(0, 2, 1)
    two = (own != own[:, :1]).any(axis=1)[:, None, None]  # two parts of a bucket meet: pairs inside a part meet elsewhere
    good = (cosine >= rule.cosine) & (gid[:, :, None] != gid[:, None, :]) & (lengths[:, :, None] == lengths[:, None, :])
    good &= ~two | (own[:, :, None] != own[:, None, :])
    b, i, j = np.nonzero(good)
    upper = i < j
    b, i, j = b[upper], i[upper], j[upper]
    key = np.stack([np.frombuffer(keys[k].as_buffer(), np.int32) for k in at.tolist()]).reshape(-1, n, rule.tables)
    first = np.ones(len(b), bool)
    for s in range(0, len(b), 100_000):  # not if the pair meets in an earlier table
        x = slice(s, s + 100_000)
        same = key[b[x], i[x]] == key[b[x], j[x]]
        first[x] = same.argmax(axis=1) == number[b[x], i[x]]
    b, i, j = b[first], i[first], j[first]
    links = np.zeros(gid.shape, np.int64)
    np.add.at(links, (b, i), weight[b, j])
    np.add.at(links, (b, j), weight[b, i])
    root = np.tile(np.arange(n), (len(gid), 1))
    while True:  # smallest place reachable in the block
        before = root.copy()
        np.minimum.at(root, (b, i), root[b, j])
        np.minimum.at(root, (b, j), root[b, i])
        if (root == before).all():
            break
    other = np.take_along_axis(gid, root, axis=1)
    used = links.ravel() > 0
    other, mine = other.ravel()[used], gid.ravel()[used]
    return pa.record_batch([pa.array(mine, pa.int64()), pa.array(links.ravel()[used], pa.int64()), pa.array(other, pa.int64(), mask=other == mine)], names=["gid", "links", "other"])
