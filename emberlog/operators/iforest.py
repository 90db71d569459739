"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark.

Sampling, grouping and scoring are Spark jobs; Python sees one sample of at
most ``sample_size`` rows per tree, and Arrow batches when scoring.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlog.functions import fixed
from emberlog.functions.params import Thresholds
from emberlog.sources.scratch import staged

_NODES = "tree int, node int, feature int, split double, below int, above int, path double"
_CIRCLE = 1 << 62  # places on the circle the rows are sampled from
_DEVIATIONS = 10
SKETCH_K = 1600


def average_path(n: float) -> float:
    """c(n): mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


@dataclass(frozen=True)
class IsolationForest:
    """A fitted forest: at most ``trees * (2 * sample_size - 1)`` node rows."""

    features: Sequence[str]
    sample_size: int
    nodes: pd.DataFrame

    def score(self, df: DataFrame, name: str = "isolation_score") -> DataFrame:
        """Add 2^(-E[path] / c(sample)): near 1 is isolated early, 0.5 and below is ordinary."""
        trees = [_walk_tables(tree.sort_values("node")) for _, tree in self.nodes.groupby("tree")]
        scale = average_path(self.sample_size) or 1.0

        def score_batches(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for batch in batches:
                batch = (batch,) if isinstance(batch, pd.Series) else batch  # a single feature
                rows = np.column_stack([c.to_numpy(dtype="float64") for c in batch])
                values, start = rows.ravel(), np.arange(len(rows)) * rows.shape[1]
                total = np.zeros(len(rows))
                for feature, split, child, path, depth in trees:
                    at = np.zeros(len(rows), dtype=np.int64)
                    for _ in range(depth):
                        above = values.take(start + feature.take(at)) >= split.take(at)
                        at = child.take(2 * at + above)
                    total += path.take(at)
                mean = total / max(len(trees), 1)
                yield pd.Series(np.where(np.isnan(rows).any(axis=1), np.nan, 2.0 ** (-mean / scale)))

        scorer = F.pandas_udf(score_batches, "double")
        return df.withColumn(name, F.nanvl(scorer(*self.features), F.lit(None).cast("double")))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, _NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(list(self.features), self.sample_size)]
        spark.createDataFrame(meta, "features array<string>, sample_size int").write.mode("overwrite").json(
            f"{path}/meta"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForest":
        meta = spark.read.schema("features array<string>, sample_size int").json(f"{path}/meta").first()
        return cls(meta.features, meta.sample_size, spark.read.parquet(f"{path}/nodes").toPandas())


def _walk_tables(tree: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Arrays for walking whole batches: leaves point to themselves, so all rows take equal steps."""
    leaf = (tree["feature"] < 0).to_numpy()
    node = tree["node"].to_numpy(dtype=np.int64)
    feature = np.where(leaf, 0, tree["feature"]).astype(np.int64)
    split = np.where(leaf, np.inf, tree["split"])
    below, above = (np.where(leaf, node, tree[side]).astype(np.int64) for side in ("below", "above"))
    child = np.column_stack([below, above]).ravel()
    depth, level = 0, np.zeros(1, dtype=np.int64)
    while not leaf[level].all():
        level = np.unique(child[np.concatenate([2 * level, 2 * level + 1])])
        depth += 1
    return feature, split, child, tree["path"].to_numpy(), depth


def tree_samples(
    df: DataFrame, total: int, key: Sequence[str], trees: int, sample_size: int, seed: int
) -> DataFrame:
    """The ``sample_size`` rows (all, if there are fewer) of every tree.

    One rule for every size: the hash of a unique row key puts each row on a circle, and a
    tree takes the rows that follow its own place on it.  The places are equally far apart,
    so trees share rows only where the input has fewer rows than all trees together take.
    The sample does not depend on partitioning and is the same when a lost task is run again.

    Rows beyond a tree's reach are dropped before anything is sent.  The reach holds
    ``sample_size`` rows and ten deviations more; should a tree still
    fall short, the reach is the whole circle.
    """
    wanted = min(sample_size, total)
    reach = min(1.0, (wanted + _DEVIATIONS * math.sqrt(wanted) + 20) / max(total, 1))
    samples = _rows_behind(df, reach, key, trees, wanted, seed)
    if reach < 1.0:
        counted = samples.groupBy("tree").agg(F.count("*").alias("n")).filter(F.col("n") >= wanted)
        if counted.count() < trees:
            samples = _rows_behind(df, 1.0, key, trees, wanted, seed)
    return samples


def _rows_behind(df: DataFrame, reach: float, key: Sequence[str], trees: int, wanted: int, seed: int) -> DataFrame:
    """The first ``wanted`` rows behind the place of each tree, of those within ``reach`` of the circle."""
    place = F.shiftrightunsigned(F.xxhash64(*key, F.lit(seed)), 2)
    step = _CIRCLE // trees
    far = min(_CIRCLE, int(reach * _CIRCLE))
    at = df.withColumn("_at", place)
    # the trees whose place lies in (_at - far, _at]; numbers below 0 are those before the start of the circle
    last = F.least(F.floor(F.col("_at") / step), F.lit(trees - 1))
    last = last - F.when(last * step > F.col("_at"), 1).otherwise(0)
    first = F.greatest(F.ceil((F.col("_at") - far) / step), last - (trees - 1))
    numbers = F.filter(F.sequence(first, last), lambda t: F.pmod(F.col("_at") - F.pmod(t, F.lit(trees)) * step, F.lit(_CIRCLE)) < far)
    offered = at.filter(first <= last).withColumn("tree", F.explode(numbers)).withColumn("tree", F.pmod("tree", F.lit(trees)).cast("int"))
    order = Window.partitionBy("tree").orderBy("_rank", *key)
    # An explicit number keeps adaptive execution from packing all trees into one task.
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    return staged(
        offered.withColumn("_rank", F.pmod(F.col("_at") - F.col("tree").cast("long") * step, F.lit(_CIRCLE)))
        .drop("_at")
        .repartition(tasks, "tree")
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= wanted),
        "forest-sample",
    )


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    trees: int = fixed.ISOLATION_TREES,
    sample_size: int = fixed.ISOLATION_SAMPLE,
    seed: int = fixed.KMEANS_SEED,
) -> IsolationForest:
    """Fit on the complete rows of ``df``; ``key`` must identify a row."""
    names = list(features)
    rows = df.dropna(subset=names).select(*key, *[F.col(n).cast("double").alias(n) for n in names])
    total = rows.count()
    samples = tree_samples(rows, total, key, trees, sample_size, seed)

    def grow(group: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(group[0])
        values = sample.sort_values("_place")[names].to_numpy()
        return _grow_tree(values, tree, np.random.default_rng([seed, tree]))

    # Bounded by the parameters: trees * (2 * sample_size - 1) node rows.
    nodes = samples.groupBy("tree").applyInPandas(grow, _NODES).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    return IsolationForest(names, min(sample_size, total), nodes)


def _grow_tree(values: np.ndarray, tree: int, rng: np.random.Generator) -> pd.DataFrame:
    limit = math.ceil(math.log2(max(len(values), 2)))
    nodes: list[list] = []
    waiting = [(values, 0, None)]
    while waiting:
        rows, depth, link = waiting.pop()
        node = len(nodes)
        if link is not None:
            parent, side = link
            nodes[parent][side] = node
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        varying = np.flatnonzero(high > low) if len(rows) > 1 else []
        if depth >= limit or len(varying) == 0:
            nodes.append([tree, node, -1, 0.0, 0, 0, depth + average_path(len(rows))])
            continue
        feature = int(rng.choice(varying))
        split = rng.uniform(low[feature], high[feature])
        lower = rows[:, feature] < split
        nodes.append([tree, node, feature, split, 0, 0, 0.0])
        waiting.append((rows[lower], depth + 1, (node, 4)))
        waiting.append((rows[~lower], depth + 1, (node, 5)))
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in _NODES.split(", ")])


def contamination_flag(scored: DataFrame, share: float = Thresholds.contamination, score: str = "isolation_score") -> DataFrame:
    """Mark the top ``share`` of the scores: 1 at or above their percentile."""
    cut = scored.agg(F.percentile_approx(score, 1.0 - share, 10000).alias("cut"))
    return scored.withColumn("is_outlier", F.when(F.col(score) >= cut.scalar(), 1).otherwise(0))


def score_sketch(scored: DataFrame, score: str = "isolation_score", by: Sequence[str] = ()) -> DataFrame:
    """One mergeable quantile sketch of the scores (per ``by`` group): some kilobytes, whatever the number of rows."""
    return scored.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(score), F.lit(SKETCH_K)).alias("sketch"))


def merged_sketch(sketches: DataFrame) -> DataFrame:
    """One sketch of all rows that the sketches have seen."""
    return sketches.agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))


def contamination_cut(sketch: DataFrame, share: float = Thresholds.contamination) -> float | None:
    """The score from which the top ``share`` begins, to about 0.2 % of the rows; None without scores.

    Taken once and kept with a model, it lets a stream mark its rows one by one.
    """
    row = sketch.select(F.expr(f"kll_sketch_get_quantile_double(sketch, {1.0 - share}D)").alias("cut")).first()
    return None if row is None else row.cut


def marked_from(scored: DataFrame, cut: float | None, score: str = "isolation_score") -> DataFrame:
    """``is_outlier`` by a cut taken before: works on batches and streams."""
    hit = F.lit(False) if cut is None else F.coalesce(F.col(score) >= cut, F.lit(False))
    return scored.withColumn("is_outlier", hit.cast("int"))


def ensemble(
    scored: DataFrame, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Weighted KMeans and isolation scores, and the combined decision."""
    final = (
        F.col("anomaly_score") * fixed.ENSEMBLE_KMEANS_WEIGHT
        + F.col("isolation_score") * fixed.ENSEMBLE_ISOLATION_WEIGHT
    )
    return scored.withColumn("final_anomaly_score", final).withColumn(
        "is_anomaly_final",
        F.when(F.col("final_anomaly_score") >= thresholds.ensemble_anomaly, 1).otherwise(0),
    )
