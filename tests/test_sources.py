"""File sources, numbering, inventory and result tables."""

import json
import os

import pytest
from pyspark.sql.utils import AnalysisException
from conftest import log_line

from emberlog.functions import columns as C
from emberlog.functions import fixed
from emberlog.operators import aggregates
from emberlog.operators.centers import CenterModel
from emberlog.plans import analyze, batch, graphs
from emberlog.sources import inventory, scratch, tables, textlogs
from emberlog.functions.params import AnalysisOptions
from pyspark.sql import functions as F


def write(path, *rows):
    path.write_text("".join(f"{r}\n" for r in rows), encoding="utf-8")
    return path


@pytest.fixture
def log_dir(tmp_path):
    write(tmp_path / "a.log", log_line(level="ERROR", rt=2000, message="timeout"), log_line())
    write(tmp_path / "b.log", log_line(), "", log_line(level="ERROR", rt=9000, message="attack failed"))
    write(tmp_path / "c.txt", "nothing to see")
    write(tmp_path / "d.csv", log_line(level="ERROR"))
    return tmp_path


def test_scan_reads_log_and_txt_only(spark, log_dir):
    df = textlogs.scan_log_files(spark, str(log_dir))
    assert {r.file_name for r in df.collect()} == {"a.log", "b.log", "c.txt"}
    assert textlogs.scan_lines(spark, str(log_dir / "a.log")).count() == 2


def test_file_identity_and_counts(spark, log_dir):
    os.utime(log_dir / "a.log", (1_700_000_000.9, 1_700_000_000.9))
    counts = {r.file_id: r.line_count for r in textlogs.line_counts(textlogs.scan_log_files(spark, str(log_dir))).collect()}
    assert counts["a.log_1700000000"] == 2
    assert sorted(counts.values()) == [1, 2, 3]


def test_nested_files_of_one_name_stay_apart(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        os.utime(write(tmp_path / name / "s.log", log_line()), (1_700_000_000, 1_700_000_000))
    df = textlogs.numbered_lines(spark, str(tmp_path), nested=True)
    assert df.select("file_id").distinct().count() == 2
    assert {r.line_number for r in df.collect()} == {1}


@pytest.mark.parametrize("split", ["2k", "64k", "128m"])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    for f in range(3):
        write(tmp_path / f"{f}.log", *[f"{f}:{i} {'x' * (i % 50)}" for i in range(1, 3001)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = textlogs.numbered_lines(spark, str(tmp_path))
        wrong = df.filter(
            F.substring_index(F.split("value", " ")[0], ":", -1).cast("bigint") != F.col("line_number")
        )
        assert df.count() == 9000
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_numbering_without_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textlogs, "MAX_BROADCAST_BLOCKS", -1)
    write(tmp_path / "a.log", *[str(i) for i in range(1, 51)])
    rows = textlogs.numbered_lines(spark, str(tmp_path)).collect()
    assert {(r.line_number, r.value) for r in rows} == {(i, str(i)) for i in range(1, 51)}


def test_inventory_sizes_and_order(spark, log_dir):
    (log_dir / "big.log").write_bytes(b"x" * 2048)
    os.utime(log_dir / "big.log", (1_900_000_000, 1_900_000_000))
    rows = inventory.file_inventory(spark, str(log_dir)).collect()
    assert rows[0].file_name == "big.log" and rows[0].size == "2.00 KB"
    assert {r.file_name for r in rows} == {"a.log", "b.log", "c.txt", "d.csv", "big.log"}
    plan = inventory.file_inventory(spark, str(log_dir))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_result_tables_replace_only_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(spark.createDataFrame([("a", 1), ("b", 1)], "file_id string, v int"), path)
    tables.write_partitions(spark.createDataFrame([("b", 2)], "file_id string, v int"), path)
    got = {(r.file_id, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1), ("b", 2)}


def test_batch_of_files(spark, log_dir):
    model = CenterModel(fixed.FEATURES_8, [0.0] * 8, [1000.0] + [1.0] * 7, [[0.0] * 8, [9.0] * 8], [0.9, 0.1])
    analysis, per_file = batch.analyze_directory(spark, str(log_dir), model)
    rows = {r.file_name: r for r in per_file.collect()}
    assert set(rows) == {"a.log", "b.log", "c.txt"}
    assert not rows["c.txt"].success and rows["c.txt"].message == "no line of this file has a level and a service"
    assert rows["b.log"].success and rows["b.log"].total_logs == 2 and rows["b.log"].file_size > 0
    total = batch.batch_summary(per_file).first()
    assert (total.total_files, total.successful, total.failed) == (3, 2, 1)
    assert total.total_anomalies == analysis.anomalies.count()


def test_batch_falls_back_to_rules_without_model(spark, log_dir):
    analysis, per_file = batch.analyze_directory(spark, str(log_dir))
    found = {(r.file_id.split("_")[0], r.line_number, r.analysis_type) for r in analysis.anomalies.collect()}
    assert found == {("a.log", 1, "pattern_spark"), ("b.log", 3, "pattern_spark")}


def test_written_analysis_is_complete(spark, log_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("results"))
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    analyze.analyze(lines, AnalysisOptions(use_ml=False)).write(root)
    stats = tables.read_table(spark, root, tables.STATISTICS)
    assert stats.count() == 3
    assert stats.agg(F.sum("total_logs")).first()[0] == 6
    assert tables.read_table(spark, root, tables.ALERTS).count() == 2
    one = stats.agg(F.max("file_id")).first()[0]
    assert tables.read_table(spark, root, tables.STATISTICS, one).count() == 1


def test_repeated_analysis_hides_former_rows(spark, log_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("results"))
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    for threshold, expected in ((0.4, 2), (2.0, 0), (0.8, 1)):
        analyze.analyze_rules(lines, AnalysisOptions(use_ml=False, anomaly_threshold=threshold)).write(root)
        assert tables.read_table(spark, root, tables.ANOMALIES).count() == expected
    row = tables.read_table(spark, root, tables.STATISTICS).first()
    assert row.status == "completed" and row.processing_time >= 0


def test_a_run_that_stops_before_its_commit_changes_nothing(spark, log_dir, tmp_path_factory, monkeypatch):
    """Between the tables and the commit, and after a failure there, readers see the whole run before."""
    root = str(tmp_path_factory.mktemp("results"))
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    first = analyze.analyze_rules(lines, AnalysisOptions(use_ml=False))
    first.write(root)
    names = (tables.ANOMALIES, tables.ALERTS, tables.STATISTICS, tables.ENTITIES)
    before = {t: sorted(map(str, tables.read_table(spark, root, t).collect())) for t in names}

    def stops(*args):
        assert {t: sorted(map(str, tables.read_table(spark, root, t).collect())) for t in names} == before
        raise OSError("stopped")

    monkeypatch.setattr(tables, "write_commits", stops)
    with pytest.raises(OSError, match="stopped"):
        analyze.analyze_rules(lines, AnalysisOptions(use_ml=False, anomaly_threshold=0.1)).write(root)
    assert {t: sorted(map(str, tables.read_table(spark, root, t).collect())) for t in names} == before
    monkeypatch.undo()
    analyze.analyze_rules(lines, AnalysisOptions(use_ml=False, anomaly_threshold=2.0)).write(root)
    assert tables.read_table(spark, root, tables.ANOMALIES).count() == 0
    assert tables.read_table(spark, root, tables.STATISTICS).count() == 3


def test_former_runs_go_after_the_commit_unless_kept(spark, log_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("results")
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    runs = lambda: {p.name for p in (root / tables.ANOMALIES).glob("file_id=*/run_id=*")}
    done = analyze.analyze_rules(lines, AnalysisOptions(use_ml=False))
    done.write(str(root))
    begun = tables.read_table(spark, str(root), tables.ANOMALIES)
    done.write(str(root), keep_former=True)
    assert len(runs()) == 2 and begun.count() == tables.read_table(spark, str(root), tables.ANOMALIES).count() == 2
    done.write(str(root))
    assert len(runs()) == 1 and tables.read_table(spark, str(root), tables.ANOMALIES).count() == 2


def test_lists_of_a_file_and_of_all_files(spark, log_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("results"))
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    done = analyze.analyze_rules(lines, AnalysisOptions(use_ml=False))
    done.write(root)
    entities = tables.read_table(spark, root, tables.ENTITIES)
    assert entities.select("file_id").distinct().count() == 2
    whole = {(r.kind, r.entity): r.anomaly_count for r in aggregates.summed(entities, "kind", "entity").collect()}
    found = done.anomalies.collect()
    for kind in ("service", "ip_address"):
        for value in {r[kind] for r in found}:
            assert whole[kind, value] == sum(r[kind] == value for r in found)
    sizes = aggregates.list_sizes(entities, tables.read_table(spark, root, tables.PATTERNS))
    said = tables.read_table(spark, root, tables.STATISTICS).filter("anomalies_found > 0").select(sizes.columns)
    assert sorted(sizes.collect()) == sorted(said.collect())


def test_trained_analysis_writes_its_summaries(spark, log_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("results"))
    model = CenterModel(fixed.FEATURES_8, [0.0] * 8, [1000.0] + [1.0] * 7, [[0.0] * 8, [9.0] * 8], [0.9, 0.1])
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    done = analyze.analyze_trained(lines, model)
    done.write(root)
    rows = {r.file_id: r for r in tables.read_table(spark, root, tables.SUMMARIES).collect()}
    records = {r.file_id: r for r in done.statistics.collect()}
    assert rows.keys() == records.keys()
    for k, r in rows.items():
        assert (r.total_logs, r.anomalies_found, r.error_logs) == (records[k].total_logs, records[k].anomalies_found, records[k].error_logs)
        assert 1 <= len(r.top_ips) <= 10


def test_failed_graph_export_keeps_the_last_graph(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", 1)], "src string, dst string, weight bigint")
    vertices = spark.createDataFrame([("a", "ip"), ("b", "service")], "id string, type string")
    graphs.export_graph(vertices, edges, str(tmp_path / "g"))
    with pytest.raises(AnalysisException):
        graphs.export_graph(vertices, edges.drop("dst"), str(tmp_path / "g"))
    links = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "g")).filter("kind = 'link'").collect()]
    assert links == [{"source": "a", "target": "b", "value": 1}]


def test_scratch_follows_the_session(spark, monkeypatch):
    path = scratch.scratch_dir(spark, "x")
    assert scratch.scratch_dir(spark, "x") != path
    assert path.rsplit("/", 1)[0] == scratch.scratch_dir(spark, "y").rsplit("/", 1)[0]


def test_alerts_can_be_switched_off(spark, log_dir):
    lines = textlogs.numbered_lines(spark, str(log_dir)).select("file_id", "line_number", "value")
    quiet = analyze.analyze_rules(lines, AnalysisOptions(use_ml=False, generate_alerts=False))
    assert quiet.alerts.count() == 0 and quiet.anomalies.count() == 2
    assert quiet.statistics.agg(F.sum("critical_alerts")).first()[0] == 0


def test_staged_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("timestamp"))
    again = scratch.staged(df, "t")
    assert again.schema.simpleString() == df.schema.simpleString() and again.count() == 10
