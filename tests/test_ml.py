"""Scaling, clustering, isolation forest and the ensemble."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import log_line
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from emberlog.functions import fixed
from emberlog.functions.params import AnalysisOptions
from emberlog.operators import centers, iforest, kmeans
from emberlog.plans import analyze
from emberlog.sources import models

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    ordinary = rng.normal(0, 1, (1000, 4))
    far = rng.choice([-1, 1], (10, 4)) * rng.uniform(8, 12, (10, 4))
    pdf = pd.DataFrame(np.vstack([ordinary, far]), columns=NAMES)
    pdf.insert(0, "id", range(len(pdf)))
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="module")
def trained(planted):
    return kmeans.fit_kmeans(planted, NAMES)


def test_expressions_agree_with_the_pipeline(planted, trained):
    pipeline, model = trained
    theirs = pipeline.transform(planted).withColumnRenamed("cluster", "their_cluster")
    ours = model.assign(theirs.withColumn("z", vector_to_array("features")))
    clusters = {j: c for j, c in enumerate(model.centers)}
    for row in ours.collect():
        assert row.cluster == row.their_cluster
        assert row.distance_to_center == pytest.approx(math.dist(row.z, clusters[row.cluster]), abs=1e-9)


def test_frozen_figures(planted, trained):
    _, model = trained
    assert sum(model.cluster_shares) == pytest.approx(1.0) and len(model.cluster_shares) == fixed.KMEANS_K
    d = model.assign(planted).toPandas()["distance_to_center"]
    assert model.distance_mean == pytest.approx(d.mean())
    assert model.distance_std == pytest.approx(d.std())
    assert model.distance_max == pytest.approx(d.max())


def test_scaler_matches_plain_statistics(planted):
    scaled, fitted = kmeans.scaled_vectors(planted, NAMES)
    means, stds = centers.standardisation(planted, NAMES)
    assert list(fitted.stages[1].mean) == pytest.approx(means)
    assert list(fitted.stages[1].std) == pytest.approx(stds)
    columns = np.array([r.features.toArray() for r in scaled.collect()])
    assert columns.mean(axis=0) == pytest.approx(np.zeros(4), abs=1e-9)


def test_invalid_rows_skip_or_fail(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id int, a double")
    assert kmeans.assembler(["a"]).transform(df).count() == 1
    with pytest.raises(Exception):
        kmeans.assembler(["a"], "error").transform(df).collect()


def test_weighted_distinct_rows_cluster_like_all_rows(spark):
    rows = [(0.0,)] * 50 + [(1.0,)] * 30 + [(10.0,)] * 20 + [(11.0,)] * 20
    df = spark.createDataFrame(rows, "a double")
    _, model = kmeans.fit_kmeans(df, ["a"], k=2)
    raw = sorted(c[0] * model.stds[0] + model.means[0] for c in model.centers)
    assert raw == pytest.approx([30 / 80, 10.5])
    assert sorted(model.cluster_shares) == pytest.approx([40 / 120, 80 / 120])


def test_scores_stay_in_range(planted, trained):
    _, model = trained
    scored = centers.zscore_scores(model.assign(planted), model).toPandas()
    assert scored["anomaly_score"].between(0, 1).all()
    assert (scored["is_anomaly"] == (scored["anomaly_score"] > 0.7)).all()


def test_degenerate_inputs(spark):
    for rows in ([(1.0, 2.0)], [(1.0, 2.0)] * 5):
        df = spark.createDataFrame(rows, "a double, b double")
        means, stds = centers.standardisation(df, ["a", "b"])
        assert stds == [0.0, 0.0]
        model = centers.CenterModel(["a", "b"], means, stds, [[0.0, 0.0]]).with_figures(df)
        assert model.distance_std == 1.0
        got = centers.zscore_scores(model.assign(df), model).collect()
        assert {(r.cluster, r.distance_to_center, r.anomaly_score) for r in got} == {(0, 0.0, 0.5)}


def test_missing_feature_is_not_assigned(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    row = centers.CenterModel(["a", "b"], [0, 0], [1, 1], [[0.0, 0.0], [1.0, 1.0]]).assign(df).first()
    assert row.cluster is None and row.distance_to_center is None


def test_ties_go_to_the_first_centre(spark):
    df = spark.createDataFrame([(0.0,)], "a double")
    assert centers.CenterModel(["a"], [0], [1], [[1.0], [-1.0]]).assign(df).first().cluster == 0


def test_rare_clusters_are_small_not_high_numbered(spark):
    model = centers.CenterModel(["a"], [0], [1], [[0.0], [5.0]], [0.03, 0.97])
    df = model.assign(spark.createDataFrame([(0.0,), (5.0,)], "a double"))
    assert [r.rare for r in df.select(model.rare_cluster().alias("rare")).collect()] == [True, False]


def test_model_round_trip_and_overwrite(spark, planted, trained, tmp_path):
    path = str(tmp_path / "m")
    for _ in range(2):
        models.save_model(spark, path, *trained)
    pipeline, model = models.load_model(spark, path)
    assert model == trained[1]
    assert len(pipeline.stages) == 3
    with pytest.raises(ValueError):
        models.save_model(spark, path, None, None)


# ------------------------------------------------------------ isolation forest


def test_average_path():
    assert iforest.average_path(1) == 0.0 and iforest.average_path(2) == 1.0
    harmonic = sum(1 / i for i in range(1, 256))
    assert iforest.average_path(256) == pytest.approx(2 * harmonic - 2 * 255 / 256, abs=1e-2)


def test_planted_outliers_rank_first(planted):
    forest = iforest.fit_isolation_forest(planted, NAMES, ["id"])
    scored = forest.score(planted).toPandas().sort_values("isolation_score", ascending=False)
    assert scored["isolation_score"].between(0, 1).all()
    assert set(scored["id"].head(10)) == set(range(1000, 1010))
    assert scored["isolation_score"].head(10).min() > 0.6 > 0.5 > scored["isolation_score"].median()


def test_forest_does_not_depend_on_partitioning(planted):
    a = iforest.fit_isolation_forest(planted.repartition(3), NAMES, ["id"], trees=10)
    b = iforest.fit_isolation_forest(planted.coalesce(1), NAMES, ["id"], trees=10)
    pd.testing.assert_frame_equal(a.nodes, b.nodes)


def test_large_input_gives_each_pool_row_to_one_tree(spark):
    df = spark.range(20000).withColumn("a", F.rand(3))
    sample = iforest.tree_samples(df, 20000, ["id"], trees=10, sample_size=64, seed=1)
    counts = {r["tree"]: r["count"] for r in sample.groupBy("tree").count().collect()}
    assert len(counts) == 10 and max(counts.values()) <= 64 and min(counts.values()) > 40
    assert sample.groupBy("id").count().agg(F.max("count")).first()[0] == 1


def test_tree_walk_against_plain_python(planted):
    forest = iforest.fit_isolation_forest(planted, NAMES, ["id"], trees=7, sample_size=32)
    assert len(forest.nodes) <= 7 * (2 * 32 - 1)
    trees = [t.set_index("node") for _, t in forest.nodes.groupby("tree")]

    def path(tree, row):
        at = 0
        while tree.loc[at, "feature"] >= 0:
            name = NAMES[int(tree.loc[at, "feature"])]
            at = tree.loc[at, "below" if row[name] < tree.loc[at, "split"] else "above"]
        return tree.loc[at, "path"]

    for row in forest.score(planted.filter("id % 100 = 3")).collect():
        mean = sum(path(t, row) for t in trees) / len(trees)
        assert row.isolation_score == pytest.approx(2 ** (-mean / iforest.average_path(32)))


def test_forest_save_load_and_missing_values(spark, planted, tmp_path):
    forest = iforest.fit_isolation_forest(planted, NAMES, ["id"], trees=5)
    forest.save(spark, str(tmp_path / "f"))
    again = iforest.IsolationForest.load(spark, str(tmp_path / "f"))
    few = planted.limit(50)
    assert forest.score(few).collect() == again.score(few).collect()
    row = forest.score(few.limit(1).withColumn("a", F.lit(None).cast("double"))).first()
    assert row.isolation_score is None


def test_tiny_and_constant_inputs(spark):
    for rows in ([(1, 5.0)], [(i, 5.0) for i in range(9)]):
        df = spark.createDataFrame(rows, "id int, a double")
        got = iforest.fit_isolation_forest(df, ["a"], ["id"], trees=3).score(df).collect()
        assert len({r.isolation_score for r in got}) == 1 and 0 <= got[0].isolation_score <= 1


def test_contamination_marks_the_top_share(spark):
    df = spark.range(1, 101).select((F.col("id") / 100.0).cast("double").alias("isolation_score"))
    assert iforest.contamination_flag(df).agg(F.sum("is_outlier")).first()[0] in (10, 11)


def test_ensemble_weights(spark):
    df = spark.createDataFrame([(1.0, 0.2), (0.5, 0.5)], "anomaly_score double, isolation_score double")
    rows = iforest.ensemble(df).collect()
    assert rows[0].final_anomaly_score == pytest.approx(0.68) and rows[0].is_anomaly_final == 1
    assert rows[1].final_anomaly_score == pytest.approx(0.5) and rows[1].is_anomaly_final == 0


# --------------------------------------------------------------------- analyses


def test_ml_analysis_accounts_for_every_valid_line(lines):
    good = [log_line(rt=100 + i % 7, message=f"request {i % 3}") for i in range(200)]
    odd = [log_line(level="ERROR", ip="10.0.0.666", rt=9900, message="critical deadlock: attack")]
    broken = ["garbage", "[WARN] a-svc - no time | IP: 1.1.1.1 | User: u | ResponseTime: 5ms"]
    result = analyze.analyze(lines(*good, *odd, *broken), AnalysisOptions())
    assert result.scored.count() + result.rejects.count() == 202
    # a lone row is its own centre, so it is the forest that singles it out
    assert result.scored.orderBy(F.desc("isolation_score")).first().line_number == 201
    found = result.anomalies.first()
    assert found.analysis_type == "spark_mllib" and found.cluster is not None
    assert result.statistics.first().total_logs == result.scored.count()


def test_trained_analysis_keeps_lines_without_features(lines):
    model = centers.CenterModel(fixed.FEATURES_8, [0.0] * 8, [1.0] * 8, [[0.0] * 8], [1.0])
    result = analyze.analyze_trained(
        lines(log_line(rt=1, message=""), "[INFO] a-svc - m | IP: 1.1.1.1 | User: u"), model
    )
    rows = {r.line_number: r.anomaly_score for r in result.scored.collect()}
    assert rows[2] == 0.5 and rows[1] < 0.5
    assert [r.line_number for r in result.rejects.collect()] == [2]


@pytest.mark.parametrize("far", [1, 3, 10])
def test_ml_analysis_marks_planted_outliers(lines, far):
    """Rows far from all others are marked whether KMeans gives them a centre of their own or not, and no ordinary row is."""
    good = [log_line(rt=100 + i % 7, ts=f"2024-01-01 10:{i % 60:02d}:00.000", message=f"request {i % 3}") for i in range(400)]
    odd = [log_line(level="ERROR", ip="10.0.0.666", rt=9900 + i, message="critical deadlock: attack") for i in range(far)]
    found = analyze.analyze(lines(*good, *odd), AnalysisOptions()).anomalies.collect()
    assert {r.line_number for r in found} == set(range(401, 401 + far))
    assert min(r.anomaly_score for r in found) > 0.8


def test_rows_of_rare_clusters_are_measured_to_large_centres(spark):
    rows = [(0.0,)] * 60 + [(1.0,)] * 39 + [(10.0,)]
    df = spark.createDataFrame(rows, "a double")
    plain = centers.CenterModel(["a"], [0], [1], [[0.0], [1.0], [10.0]]).with_figures(df)
    assert plain.distance_max == 0.0
    model = plain.sized(df, 0.05)
    assert list(model.large) == [0, 1] and model.distance_max == 9.0
    got = {r.a: (r.cluster, r.distance_to_center) for r in model.assign(df).collect()}
    assert got == {0.0: (0, 0.0), 1.0: (1, 0.0), 10.0: (2, 9.0)}
    # no cluster is large enough: all rows are measured to the largest
    assert list(plain.sized(df, 0.9).large) == [0]


def test_sized_model_round_trip(spark, planted, trained, tmp_path):
    pipeline, model = trained
    sized = model.sized(planted)
    models.save_model(spark, str(tmp_path / "m"), pipeline, sized)
    assert models.load_model(spark, str(tmp_path / "m"))[1] == sized


@pytest.mark.parametrize("rows", [100, 2000, 33_000, 34_000])
def test_one_sampling_rule_for_every_size(spark, rows):
    """Each tree has its full sample on either side of any size, and the same at 1, 4 and 16 partitions."""
    df = spark.range(rows).withColumn("a", F.xxhash64("id") / 2.0**63)
    samples = []
    for partitions in (1, 4, 16):
        sample = iforest.tree_samples(df.repartition(partitions), rows, ["id"], trees=100, sample_size=256, seed=9)
        counts = sample.groupBy("tree").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
        assert tuple(counts) == (100, min(rows, 256), min(rows, 256))
        samples.append(sorted(map(tuple, sample.select("tree", "_place", "id").collect())))
    assert samples[0] == samples[1] == samples[2]
    used = {i for _, _, i in samples[0]}
    assert len(used) > 0.9 * min(rows, 25_600 * (1 - math.exp(-rows / 25_600)))


def test_rows_of_a_tree_are_those_behind_its_place(spark):
    df = spark.range(500)
    places = {r.id: r.h for r in df.select("id", F.shiftrightunsigned(F.xxhash64("id", F.lit(3)), 2).alias("h")).collect()}
    sample = iforest.tree_samples(df, 500, ["id"], trees=7, sample_size=40, seed=3).collect()
    for tree in range(7):
        start = tree * (iforest._CIRCLE // 7)
        want = sorted(places, key=lambda i: (places[i] - start) % iforest._CIRCLE)[:40]
        assert [r.id for r in sorted(sample, key=lambda r: r._place) if r.tree == tree] == want


def test_a_reach_that_falls_short_is_widened(spark, monkeypatch):
    monkeypatch.setattr(iforest, "_DEVIATIONS", -12)
    df = spark.range(5000)
    sample = iforest.tree_samples(df, 5000, ["id"], trees=5, sample_size=200, seed=1)
    assert {r["count"] for r in sample.groupBy("tree").count().collect()} == {200}
