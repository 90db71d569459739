"""Exact Jaccard self-join of word-shingle sets by vertical partitioning.

The global order of shingles is the order of their 64-bit hashes, and it is cut into fragments
twice. First into so many that linked sets must agree in whole ones: two sets that pass the
threshold differ in at most D shingles and every set falls into F > D segments, so they have an
equal segment in at least F - D fragments. Equal segments are counted range by range in separate
tasks and summed per pair; pairs with enough are candidates. F follows the size of the sets, in
levels; a set near the lower edge of its level takes part in the level below as well.

Then into ``FRAGMENTS`` wide ones: the overlap of every candidate pair is counted in each of them by
itself, and the sum of these partial counts, with the sizes, decides.

Groups do not become pairs. Equal sets are one set from the start. A segment that
more than ``SMALL`` sets share links each of them to one centre only. A set is a member of its centres
if such segments, with those it shares in its best listed pair, are as many as any link needs: one with
fewer, such as a text with a common passage, can have no link there. Of the members of a centre
the one in most such segments, the least altered copy, is their hub, and each is a candidate pair
with its hub. Sets still apart after these links are compared with the other sets of the same
centre, block against block, and only where their components differ; of the links that a block
finds it returns a spanning forest. So links grow with the members of a group, every link either
joins two components or lies inside one, and none is lost.

Defined cases: null or blank text is an empty set, linked with nothing; a text of
fewer words than a shingle is one shingle; rows with a null id take
part in no link and have no component; rows with one id are compared as separate
rows; tables may be empty and hold further columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.components import components
from emberlog.llm.words import SPACED, chunks, grouped, mix, slot, windows
from emberlog.sources.scratch import passing, staged

SMALL = 8  # sets of a segment that are compared pair by pair
FRAGMENTS = 4  # in which the overlap of a pair is counted
BLOCK_BYTES = 4 << 20  # of hashes of the sets of a centre that are compared with as many others at once
RANGE_BYTES = 24 << 20
LEAST_RANGES = 32
_LEVEL_BASE, _LEVEL_STEP, _SLACK = 4, 1.5, 1.3


@dataclass(frozen=True)
class Rule:
    """Shingles of ``width`` words; sets link if 100 * intersection >= percent * union."""

    width: int = 5
    percent: int = 80

    def most_different(self, a, b):
        """Shingles in which linked sets of sizes ``a`` and ``b`` can differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def level(self, sizes: np.ndarray) -> np.ndarray:
        edges = self.edges(int(sizes.max()) + 1) if len(sizes) else np.array([1])
        return np.searchsorted(edges, sizes, side="right") - 1

    def edges(self, upto: int) -> np.ndarray:
        edges = [1, _LEVEL_BASE]
        while edges[-1] <= upto:
            edges.append(int(np.ceil(edges[-1] * _LEVEL_STEP)))
        return np.array(edges)

    def block(self, level: int) -> int:
        """Sets of the level that ``BLOCK_BYTES`` hold."""
        return max(1, BLOCK_BYTES // (8 * int(self.edges(1 << 40)[level + 1])))

    def fragments(self, level: int) -> tuple[int, int]:
        """Most differing shingles of a pair of the level, and its number of fragments."""
        largest = int(self.edges(1 << 40)[level + 1]) - 1
        differ = largest * (100 - self.percent) // self.percent
        return differ, int(np.ceil((differ + 1) * _SLACK)) if differ else 0


def jaccard_classes(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every row."""
    sets, links = _joined(docs, rule, id_col, text_col)
    parts = components(links)
    least = sets.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("rep"))
    named = least.join(parts, least.sid == parts.id, "left").select("sid", "rep", F.coalesce("component", "sid").alias("part"))
    roots = named.groupBy("part").agg(F.min("rep").alias("root"))
    found = named.join(roots, "part").select("sid", "root")
    return sets.join(found, "sid", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id.

    Rows without text are classes of their own. Of rows that share that id, all stay.
    """
    kept = jaccard_classes(docs, rule, id_col, text_col).filter("doc_id = component_id or doc_id is null")
    kept = kept.select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col("__kept")), "left_semi")


def links(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, n_shingles, sid) and links between different sets (a, b: sids).

    Links inside a component already found are left out where a segment is shared by many.
    """
    return _joined(docs, rule, id_col, text_col)


def _joined(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(LEAST_RANGES, -(-size // RANGE_BYTES))
    sets = rows.mapInArrow(partial(_sets, rule), "doc_id long, n_shingles long, sid long")
    sets = staged(sets.withColumn("sid", F.when(F.col("doc_id").isNotNull(), F.col("sid"))), "sets")
    segments = rows.filter("doc_id is not null").select("text").mapInArrow(partial(_segments, rule, ranges), "range int, sets binary, segments binary")
    found = staged(segments.groupBy("range").applyInArrow(grouped(_shared), "a long, b long, level int, n_a int, n_b int, none int, own int, equal int, hot int"), "shared")
    star = staged(_members(found, rule), "stars")
    pairs = staged(_enough(found, rule).union(_hub_pairs(star)).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).union(star.select("sid")).distinct()
    reps = sets.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("doc_id")).join(wanted, "sid")
    hashes = rows.join(reps, "doc_id").select("sid", "text").mapInArrow(partial(_hash_sets, rule), "sid long, hashes binary").dropDuplicates(["sid"])
    with passing(hashes, "hashes") as hashes:
        first = staged(_compared(pairs, hashes, rule), "links")
        rest = _rest(star, first, hashes, rule)
        rest = staged(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return sets, first.union(rest)


def _shingles(rule: Rule, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks: first row, number of rows, text number and hash of each distinct shingle, by text and hash."""
    for chunk in chunks(texts, SPACED, lower=True):
        hashes = chunk.hashes()
        at, full = windows(hashes, chunk.first, rule.width)
        owner = chunk.text_of_word()
        own = owner[at]
        sizes = np.diff(chunk.first)
        for k in range(1, rule.width):  # whole texts of fewer words
            if (sizes == k).any():
                at, short = windows(hashes, chunk.first, k)
                some = sizes[owner[at]] == k
                full, own = np.concatenate([full, short[some]]), np.concatenate([own, owner[at][some]])
        order = np.lexsort((full, own))
        full, own = full[order], own[order]
        new = np.ones(len(full), bool)
        new[1:] = (full[1:] != full[:-1]) | (own[1:] != own[:-1])
        yield chunk.start, chunk.texts, own[new], full[new]


def _sids(n: int, own: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and fingerprint of each set."""
    sizes = np.bincount(own, minlength=n)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    ends = np.cumsum(sizes)
    return sizes, mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


def _sets(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, n, own, hashes in _shingles(rule, batch.column(1)):
            sizes, sids = _sids(n, own, hashes)
            yield pa.record_batch([batch.column(0).slice(start, n), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64(), mask=sizes == 0)], names=["doc_id", "n_shingles", "sid"])


def _hash_sets(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, n, own, hashes in _shingles(rule, batch.column(1)):
            sizes, sids = _sids(n, own, hashes)
            ends = np.cumsum(sizes)
            blobs = [hashes[b - s : b].tobytes() for b, s in zip(ends, sizes, strict=True)]
            # a row joined by an id that several texts share may hold another set
            same = sids == batch.column(0).slice(start, n).to_numpy()
            yield pa.record_batch([pa.array(sids[same]), pa.array([x for x, s in zip(blobs, same, strict=True) if s], pa.binary())], names=["sid", "hashes"])


_MEMBER = np.dtype([("sid", "<i8"), ("n", "<i4"), ("level", "<i2"), ("none", "<i4"), ("count", "<i4")])


def _segments(rule: Rule, ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, n, own, hashes in _shingles(rule, batch.column(0)):
            sizes, sids = _sids(n, own, hashes)
            _, keep = np.unique(sids, return_index=True)
            once = np.zeros(n, bool)
            once[keep] = True
            once &= sizes > 0
            levels = rule.level(np.maximum(sizes, 1))
            edges = rule.edges(int(sizes.max(initial=1)) + 1)
            below = once & (levels > 0) & (sizes * rule.percent <= 100 * (edges[levels] - 1))
            parts = [_of_level(rule, k, (once & (levels == k)) | (below & (levels == k + 1)), sizes, sids, own, hashes) for k in range(int(levels.max(initial=0)) + 1)]
            member = np.concatenate([p[0] for p in parts])
            values = np.concatenate([p[1] for p in parts])
            yield _packed(member, values, ranges)


def _of_level(rule: Rule, level: int, chosen: np.ndarray, sizes, sids, own, hashes) -> tuple[np.ndarray, np.ndarray]:
    """A member record and a value for every segment of the chosen sets."""
    differ, count = rule.fragments(level)
    if not count or not chosen.any():
        return np.zeros(0, _MEMBER), np.zeros(0, np.uint64)
    mine = chosen[own]
    o, h = own[mine], hashes[mine]
    cell = o * count + slot(h, count)  # rising, as hashes rise within a text
    begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h), out=sums[1:])
    ends = np.append(begins[1:], len(h))
    text, fragment = cell[begins] // count, cell[begins] % count
    value = sums[ends] - sums[begins]
    filled = np.bincount(text, minlength=len(sizes))
    sparse = chosen & (filled <= differ)  # too few segments: empty ones count as well
    if sparse.any():
        rows = np.flatnonzero(sparse)
        mine = sparse[text]
        full = np.zeros((len(rows), count), bool)
        full[np.searchsorted(rows, text[mine]), fragment[mine]] = True
        t, f = np.nonzero(~full)
        text, fragment, value = np.concatenate([text, rows[t]]), np.concatenate([fragment, f]), np.concatenate([value, np.zeros(len(t), np.uint64)])
    record = np.zeros(len(text), _MEMBER)
    record["sid"], record["n"], record["level"], record["none"] = sids[text], sizes[text], level, (count - filled)[text]
    return record, mix(value ^ ((fragment.astype(np.uint64) << np.uint64(16)) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15))


def _packed(member: np.ndarray, values: np.ndarray, ranges: int) -> pa.RecordBatch:
    """One row for each range: members with their number of segments, and 32 bits of each segment."""
    place = slot(values, ranges)
    order = np.lexsort((member["level"], member["sid"], place))
    member, values, place = member[order], values[order], place[order]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (member["sid"][1:] != member["sid"][:-1]) | (member["level"][1:] != member["level"][:-1])
    at = np.flatnonzero(new)
    runs = member[at]
    runs["count"] = np.diff(np.append(at, len(place)))
    low = (values & np.uint64(0xFFFFFFFF)).astype("<u4")
    numbers = np.unique(place)
    cut = lambda rows, where: [rows[a:b].tobytes() for a, b in zip(np.searchsorted(where, numbers), np.searchsorted(where, numbers, side="right"), strict=True)]
    return pa.record_batch([pa.array(numbers, pa.int32()), pa.array(cut(runs, place[at]), pa.binary()), pa.array(cut(low, place), pa.binary())], names=["range", "sets", "segments"])


def _shared(table: pa.Table) -> pa.Table:
    """Pairs of sets with the number of segments they share in this range.

    Of a segment with more than ``SMALL`` sets, a hot one, only the pairs with its centre, the smallest
    set id, itself included. none: fragments empty in both sets at most; own: those empty in b.
    """
    runs = np.frombuffer(b"".join(table.column("sets").to_pylist()), _MEMBER)
    low = np.frombuffer(b"".join(table.column("segments").to_pylist()), "<u4")
    member = np.repeat(np.arange(len(runs)), runs["count"])
    key = low.astype(np.uint64) << np.uint64(16) | runs["level"][member].astype(np.uint64)
    order = np.lexsort((runs["sid"][member], key))
    key, member = key[order], member[order]
    once = np.ones(len(key), bool)
    once[1:] = (key[1:] != key[:-1]) | (runs["sid"][member][1:] != runs["sid"][member][:-1])
    key, member = key[once], member[once]
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(key)))
    first, second, many = [], [], []
    for n in range(2, SMALL + 1):
        at = begins[sizes == n][:, None]
        i, j = np.triu_indices(n, 1)
        first.append((at + i).ravel()), second.append((at + j).ravel()), many.append(np.zeros(at.size * len(i), bool))
    large = sizes > SMALL
    owner = np.repeat(begins[large], sizes[large])
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[large]) - sizes[large], sizes[large])
    first.append(owner), second.append(owner + inside), many.append(np.ones(len(owner), bool))
    a, b, many = member[np.concatenate(first)], member[np.concatenate(second)], np.concatenate(many)
    left, right = runs[a], runs[b]
    order = np.lexsort((left["level"], right["sid"], left["sid"]))
    left, right, many = left[order], right[order], many[order]
    new = np.ones(len(left), bool)
    new[1:] = (left["sid"][1:] != left["sid"][:-1]) | (right["sid"][1:] != right["sid"][:-1]) | (left["level"][1:] != left["level"][:-1])
    at = np.flatnonzero(new)
    equal = np.diff(np.append(at, len(left)))
    hot = np.add.reduceat(many, at, dtype=np.int32) if len(at) else np.zeros(0, np.int32)
    left, right = left[at], right[at]
    return pa.table([left["sid"], right["sid"], left["level"].astype(np.int32), left["n"], right["n"], np.minimum(left["none"], right["none"]).astype(np.int32), right["none"].astype(np.int32), equal.astype(np.int32), hot], names=["a", "b", "level", "n_a", "n_b", "none", "own", "equal", "hot"])


def _enough(found: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose equal segments, summed over the ranges, allow the threshold."""
    summed = found.filter("a <> b").groupBy("a", "b", "level", "n_a", "n_b").agg(F.sum("equal").alias("equal"), F.max("none").alias("none"))
    sizes = F.least("n_a", "n_b").cast("long") * 100 >= F.greatest("n_a", "n_b").cast("long") * rule.percent
    differ = F.floor((F.col("n_a") + F.col("n_b")) * (100 - rule.percent) / (100 + rule.percent))
    need = _of_levels(rule, lambda k: rule.fragments(k)[1]) - differ - F.col("none")
    return summed.filter(sizes & (F.col("equal") >= need)).select("a", "b").distinct()


def _of_levels(rule: Rule, value) -> Column:
    """``value`` of the number in the column level."""
    return F.element_at(F.array(*[F.lit(value(k)) for k in range(len(rule.edges(1 << 40)) - 1)]), F.col("level") + 1)


def _members(found: DataFrame, rule: Rule) -> DataFrame:
    """Centres, their members that can have a link, and the segments shared with the centre.

    A set that shares a hot segment with its partner shares at most all its hot segments and as many others as
    with its best listed pair. The partner is no larger than the threshold lets it be; of two sets above the
    level, which meet in their own as well, one counts as the largest of the level.
    """
    star = found.filter("hot > 0")
    own = star.groupBy(F.col("b").alias("sid"), "level").agg(F.sum("hot").alias("hot"), F.max("n_b").cast("long").alias("n"), F.max("own").alias("own"))
    cold = found.filter("equal > hot").groupBy("a", "b", "level").agg(F.sum(F.col("equal") - F.col("hot")).alias("cold"))
    best = cold.select(F.col("a").alias("sid"), "level", "cold").union(cold.select("b", "level", "cold")).groupBy("sid", "level").agg(F.max("cold").alias("cold"))
    largest = _of_levels(rule, lambda k: int(rule.edges(1 << 40)[k + 1]) - 1).cast("long")
    partner = F.when(F.col("n") > largest, largest).otherwise(F.floor(F.col("n") * 100 / rule.percent))
    differ = F.floor((F.col("n") + partner) * (100 - rule.percent) / (100 + rule.percent))
    need = _of_levels(rule, lambda k: rule.fragments(k)[1]) - differ - F.col("own")
    able = own.join(best, ["sid", "level"], "left").filter(F.col("hot") + F.coalesce("cold", F.lit(0)) >= need).select("sid", "level")
    shared = star.groupBy(F.col("a").alias("centre"), F.col("b").alias("sid"), "level").agg(F.sum("equal").alias("segments"))
    return shared.join(able, ["sid", "level"]).select("centre", "sid", "level", "segments")


def _hub_pairs(star: DataFrame) -> DataFrame:
    """Each member of a centre with the hub of that centre: the member in most shared segments, ties by id."""
    degrees = star.groupBy("sid").agg(F.sum("segments").alias("degree"))
    placed = star.join(degrees, "sid")
    hubs = placed.groupBy("centre", "level").agg(F.max_by("sid", F.struct("degree", "sid")).alias("hub"))
    both = star.join(hubs, ["centre", "level"]).filter("sid <> hub")
    return both.select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()


def _compared(pairs: DataFrame, hashes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that pass the threshold: overlaps counted by fragment, summed per pair.

    A fragment that one of the sets has nothing in adds nothing. Both joins deal the parts out by the same columns
    under the same names, so Spark cuts and sends them once.
    """
    cut = hashes.mapInArrow(_cut, "sid long, fragment int, n int, part binary")
    wide = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("at"))
    one, two = cut.alias("one"), cut.alias("two")
    left = wide.join(one, (F.col("a") == F.col("one.sid")) & (F.col("at") == F.col("one.fragment")))
    left = left.select("a", "b", "at", F.col("n").alias("n_a"), F.col("part").alias("left"))
    both = left.join(two, (F.col("b") == F.col("two.sid")) & (F.col("at") == F.col("two.fragment")))
    both = both.select("a", "b", "n_a", F.col("n").alias("n_b"), "left", F.col("part").alias("right"))
    partial_counts = both.mapInArrow(_overlaps, "a long, b long, n_a int, n_b int, common long")
    summed = partial_counts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return summed.filter(100 * F.col("common") >= rule.percent * union).select("a", "b")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The part of each set in each fragment it has shingles in, and the size of the set."""
    edges = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)
    for batch in batches:
        rows = []
        for sid, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(blob, np.uint64)
            at = [0, *np.searchsorted(own, edges).tolist(), len(own)]
            rows += [(sid, k, len(own), own[a:b].tobytes()) for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["sid", "fragment", "n", "part"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common = [_common(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
        yield pa.record_batch([*batch.columns[:4], pa.array(common, pa.int64())], names=["a", "b", "n_a", "n_b", "common"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]))
    return int((both[1:] == both[:-1]).sum())


def _rest(star: DataFrame, found: DataFrame, hashes: DataFrame, rule: Rule) -> DataFrame:
    """Links between the components of sets that share a centre.

    All sets of a centre that are not in its most frequent component are compared with
    all others whose component differs, in blocks of at most ``BLOCK_BYTES``: the shorter the
    sets, the more of them make a block, and the fewer copies of a set are sent.
    """
    members = star.select("centre", "sid", "level")
    parts = components(found)
    members = members.join(parts, members.sid == parts.id, "left").select("centre", "level", "sid", F.coalesce("component", "sid").alias("part"))
    counts = members.groupBy("centre", "level", "part").agg(F.count("*").alias("n"))
    main = counts.groupBy("centre", "level").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.sum("n").alias("total"), F.count("*").alias("parts"))
    main = main.filter("parts > 1")
    members = staged(members.join(main, ["centre", "level"]).withColumn("minor", F.col("part") != F.col("main")), "members")
    minors = members.groupBy("centre", "level").agg(F.sum(F.col("minor").cast("long")).alias("n_minor"))
    members = members.join(minors, ["centre", "level"])
    block = _of_levels(rule, rule.block)
    along, across = F.ceil(F.col("total") / block).cast("int"), F.ceil(F.col("n_minor") / block).cast("int")
    side = F.pmod(F.xxhash64("sid"), along).cast("int")
    row = members.filter("minor").withColumn("row", F.pmod(F.xxhash64("sid"), across).cast("int"))
    row = row.withColumn("column", F.explode(F.sequence(F.lit(0), along - 1))).withColumn("query", F.lit(True))
    column = members.withColumn("column", side).withColumn("row", F.explode(F.sequence(F.lit(0), across - 1))).withColumn("query", F.lit(False))
    fields = ["centre", "level", "row", "column", "query", "sid", "part"]
    placed = row.select(fields).union(column.select(fields)).join(hashes, "sid")
    key = F.xxhash64("centre", "level", "row", "column")
    dealt = placed.withColumn("block", key).repartition("block").sortWithinPartitions("block")
    return dealt.select("block", "query", "sid", "part", "hashes").mapInArrow(partial(_blocks, rule), "a long, b long")


def _blocks(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block; a block may run over several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
        start = 0
        for cut in cuts.tolist():
            held.append(batch.slice(start, cut - start))
            if held[0].column(0)[0] != held[-1].column(0)[0]:
                yield from _block(rule, held[:-1])
                held = held[-1:]
            yield from _block(rule, held)
            held, start = [], cut
        rest = batch.slice(start)
        if rest.num_rows:
            if held and held[0].column(0)[0] != rest.column(0)[0]:
                yield from _block(rule, held)
                held = []
            held.append(rest)
    yield from _block(rule, held)


def _block(rule: Rule, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    table = pa.Table.from_batches(held)
    query = table.column("query").to_numpy()
    sid, part = table.column("sid").to_numpy(), table.column("part").to_numpy()
    own = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    sizes = np.array([len(x) for x in own])
    rows, columns = np.flatnonzero(query), np.flatnonzero(~query)
    if not len(rows) or not len(columns):
        return
    flat = np.concatenate(own)
    owner = np.repeat(np.arange(len(own)), sizes)
    order = np.argsort(flat, kind="stable")
    starts = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
    number = np.empty(len(flat), np.int64)
    number[order] = np.cumsum(starts) - 1
    place = np.full(len(own), -1)
    place[columns] = np.arange(len(columns))
    col = ~query[owner]
    by = np.argsort(number[col], kind="stable")  # columns that hold each shingle, in postings
    posted, shingle = place[owner[col]][by], number[col][by]
    _, joined = np.unique(part, return_inverse=True)  # components, and what this block joins of them
    a, b = [], []
    for r in rows.tolist():
        mine = number[owner == r] if len(rows) < 4 else number[np.searchsorted(owner, r) : np.searchsorted(owner, r, side="right")]
        lo, hi = np.searchsorted(shingle, mine), np.searchsorted(shingle, mine, side="right")
        span = hi - lo
        hits = posted[np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum())]
        common = np.bincount(hits, minlength=len(columns))
        good = columns[(100 * common >= rule.percent * (sizes[r] + sizes[columns] - common)) & (joined[columns] != joined[r])]
        if len(good):  # one link to each component it reaches
            others, at = np.unique(joined[good], return_index=True)
            a += [sid[r]] * len(at)
            b += sid[good[at]].tolist()
            joined[np.isin(joined, others)] = joined[r]
    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
