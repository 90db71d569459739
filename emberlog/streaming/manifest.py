"""The files of a live sink that count, as a numbered list.

Every micro-batch writes its rows into new folders and then puts up a new manifest, one small
file that appears by a rename. Readers take the manifest with the highest number, so they see
all of a batch or nothing of it, and a batch that runs again replaces the folders of its first
attempt without touching them. Folders that no recent manifest names are removed.

Small batches are merged: ``COMPACT`` folders of one level become one of the next, so the folders
of a table grow with the logarithm of its batches and every row is rewritten about as often.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPACT = 16
KEEP = 12  # manifests whose folders stay for readers that have begun
_FOLDER = "manifests"


@dataclass(frozen=True)
class Part:
    """A folder with the rows of the batches ``first`` to ``last`` of a table."""

    table: str
    path: str
    first: int
    last: int
    level: int = 0


@dataclass(frozen=True)
class Manifest:
    number: int = -1
    batch_id: int = -1
    parts: tuple[Part, ...] = ()

    def of(self, table: str) -> list[Part]:
        return sorted((p for p in self.parts if p.table == table), key=lambda p: (p.first, p.last))


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _all(spark: SparkSession, sink: str) -> list[str]:
    """Paths of the manifests, oldest first; their names begin with their numbers."""
    fs, folder = _fs(spark, f"{sink}/{_FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return [f"{sink}/{_FOLDER}/{n}" for n in sorted(names) if n.endswith(".json")]


def _load(spark: SparkSession, path: str) -> Manifest:
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return Manifest(found["number"], found["batch_id"], tuple(Part(**p) for p in found["parts"]))


def newest(spark: SparkSession, sink: str, before_batch: int | None = None) -> Manifest:
    """The manifest with the highest number (of those of earlier batches); an empty one if there is none."""
    for path in reversed(_all(spark, sink)):
        if before_batch is None or int(path.rsplit("-", 1)[1].removesuffix(".json")) < before_batch:
            return _load(spark, path)
    return Manifest()


def commit(spark: SparkSession, sink: str, batch_id: int, parts: Iterable[Part]) -> Manifest:
    """Put up the next manifest: written aside, then renamed."""
    paths = _all(spark, sink)
    number = int(paths[-1].rsplit("/", 1)[1].split("-")[0]) + 1 if paths else 0
    manifest = Manifest(number, batch_id, tuple(parts))
    text = json.dumps({"number": number, "batch_id": batch_id, "parts": [asdict(p) for p in manifest.parts]})
    fs, aside = _fs(spark, f"{sink}/{_FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = _fs(spark, f"{sink}/{_FOLDER}/{number:012d}-{batch_id}.json")
    if not fs.rename(aside, final):
        raise OSError(f"manifest {number} of {sink} could not be put up")
    return manifest


def write_part(df: DataFrame, sink: str, table: str, batch_id: int) -> Part:
    """Write the rows of a batch into a folder of their own."""
    path = new_folder(sink, table, batch_id)
    df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.parquet(path)
    return Part(table, path, batch_id, batch_id)


def new_folder(sink: str, table: str, batch_id: int) -> str:
    return f"{sink}/{table}/{batch_id}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sink: str, table: str) -> DataFrame | None:
    """Rows of a table by the newest manifest, with their batch_id; None if the sink has none yet."""
    paths = [p.path for p in newest(spark, sink).of(table)]
    return spark.read.parquet(*paths) if paths else None


def compacted(spark: SparkSession, sink: str, parts: list[Part], tables: Iterable[str], every: int = COMPACT) -> list[Part]:
    """``parts`` with ``every`` neighbours of one level merged into one folder of the next."""
    for table in tables:
        level = 0
        while every > 1:
            same = sorted((p for p in parts if p.table == table and p.level == level), key=lambda p: p.first)
            if len(same) < every:
                if not any(p.table == table and p.level > level for p in parts):
                    break
                level += 1
                continue
            path = new_folder(sink, table, same[-1].last)
            # the hint lets adaptive execution pack small files and cut large ones
            spark.read.parquet(*[p.path for p in same]).hint("rebalance").write.parquet(path)
            parts = [p for p in parts if p not in same]
            parts.append(replace(same[0], path=path, last=same[-1].last, level=level + 1))
            level += 1
    return parts


def sweep(spark: SparkSession, sink: str, tables: Iterable[str], keep: int = KEEP) -> int:
    """Remove manifests but the last ``keep`` and what no remaining one names; returns the folders removed.

    The newest manifest of the batch before stays as well: a batch that runs again starts from it.
    """
    paths = _all(spark, sink)
    if not paths:
        return 0
    last = _load(spark, paths[-1])
    base = newest(spark, sink, before_batch=last.batch_id)
    stay = {int(p.rsplit("/", 1)[1].split("-")[0]) for p in paths[-max(1, keep):]} | {base.number}
    named: set[str] = set()
    fs, _ = _fs(spark, sink)
    for path in paths:
        if int(path.rsplit("/", 1)[1].split("-")[0]) in stay:
            named |= {p.path.rsplit("/", 1)[1] for p in _load(spark, path).parts}
        else:
            fs.delete(_fs(spark, path)[1], False)
    removed = 0
    for table in tables:
        folder = _fs(spark, f"{sink}/{table}")[1]
        if fs.exists(folder):
            for status in fs.listStatus(folder):
                if status.getPath().getName() not in named:
                    removed += bool(fs.delete(status.getPath(), True))
    return removed
