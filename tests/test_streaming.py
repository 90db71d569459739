"""Structured Streaming jobs against their batch equivalents."""

import json
import os
from datetime import datetime

import pytest
from conftest import log_line
from pyspark.sql import functions as F

from emberlog.functions import fixed
from emberlog.operators import aggregates as A
from emberlog.operators.centers import CenterModel
from emberlog.operators.parse import extract_features, parse_lines, valid_lines
from emberlog.operators.statistics import live_counters
from emberlog.sources import textlogs
from emberlog.streaming import detect, manifest

# one centre on the ordinary line: 100 ms, INFO, a message of 14 characters
MODEL = CenterModel(fixed.FEATURES_8, [100.0, 0, 0, 0, 14.0, 0, 0, 0], [1000.0] + [1.0] * 7, [[0.0, 0, 0, 1, 0, 0, 0, 0]], [1.0])


def put(directory, name, mtime, *rows):
    path = directory / name
    path.write_text("".join(f"{r}\n" for r in rows))
    os.utime(path, (mtime, mtime))


def minute(m, **kw):
    return log_line(ts=f"2024-01-01 00:{m:02d}:00.000", **kw)


@pytest.fixture
def dirs(tmp_path):
    names = ("in", "sink", "ckpt")
    (tmp_path / "in").mkdir()
    return {n: tmp_path / n for n in names}


def run(spark, dirs, **kw):
    lines = textlogs.stream_lines(spark, str(dirs["in"]), max_files=1)
    detect.start_detection(lines, MODEL, str(dirs["sink"]), str(dirs["ckpt"]), interval=None, **kw).awaitTermination()


def fill(dirs, start, count):
    for f in range(start, start + count):
        put(dirs["in"], f"{f}.log", 1_700_000_000 + f,
            minute(f), minute(f, level="ERROR", rt=9000, user=f"u{f}", ip="10.0.0.666"), "garbage",
            "[INFO] a-b - no time | IP: 1.1.1.1 | User: u")


def test_detection_equals_batch_and_restart_adds_nothing(spark, dirs):
    fill(dirs, 0, 3)
    run(spark, dirs, graph_every=2)
    run(spark, dirs, graph_every=2)  # nothing new
    fill(dirs, 3, 2)
    run(spark, dirs, graph_every=2)  # continues from the checkpoint
    sink = str(dirs["sink"])
    found = detect.read_sink(spark, sink, detect.ANOMALIES).select(*detect.RECORD)
    batch = detect.live_scores(textlogs.scan_lines(spark, str(dirs["in"])), MODEL)
    expected = batch.filter("anomaly_score > 0.6").select(*detect.RECORD)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.count() == 5
    live = detect.live_statistics(spark, sink).first()
    totals = live_counters(batch).first()
    for name in ("total_logs", "total_anomalies", "critical_alerts", "anomaly_rate"):
        assert live[name] == totals[name]
    assert (live.total_logs, live.services_affected, live.suspicious_ips) == (15, 1, 1)
    assert [r.user for r in detect.last_anomalies(spark, sink, 2).collect()] == ["u4", "u3"]
    # refreshed by the second and the fourth batch: four files seen
    links = [json.loads(r.value) for r in detect.latest_graph(spark, sink).filter("kind = 'link'").collect()]
    assert max(l["value"] for l in links) == 4 and {"source": "u3", "target": "db-service", "value": 1} in links


def test_replayed_batch_replaces_its_own_rows(spark, dirs):
    fill(dirs, 0, 1)
    run(spark, dirs, graph_every=0)
    # the commit of batch 0 is lost: the batch runs again
    for name in os.listdir(dirs["ckpt"] / "commits"):
        os.unlink(dirs["ckpt"] / "commits" / name)
    run(spark, dirs, graph_every=0)
    assert detect.live_statistics(spark, str(dirs["sink"])).first().total_logs == 3
    assert detect.read_sink(spark, str(dirs["sink"]), detect.ANOMALIES).count() == 1


def test_without_a_model_every_line_is_neutral(spark, dirs):
    fill(dirs, 0, 1)
    scored = detect.live_scores(textlogs.scan_lines(spark, str(dirs["in"])), None)
    assert {r.anomaly_score for r in scored.collect()} == {0.5} and scored.count() == 3


def test_no_graph_yet(spark, tmp_path):
    assert detect.latest_graph(spark, str(tmp_path)).collect() == []


def windows(spark, dirs, **kw):
    out = str(dirs["sink"])
    lines = textlogs.stream_lines(spark, str(dirs["in"]), max_files=1)
    (detect.stream_windows(lines, **kw).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(dirs["ckpt"])).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


def test_windows_close_with_the_watermark(spark, dirs):
    for f in range(5):
        put(dirs["in"], f"{f}.log", 1_700_000_000 + f, *[minute(f * 10 + i, rt=i) for i in range(10)])
    got = windows(spark, dirs)
    features = extract_features(valid_lines(parse_lines(textlogs.scan_lines(spark, str(dirs["in"])))))
    closed = A.windowed_metrics(features).filter("window.end <= timestamp'2024-01-01 00:39:00'")
    assert sorted(map(str, got.collect())) == sorted(map(str, closed.select(*got.columns).collect()))
    assert got.count() == 39


def test_late_rows_are_dropped(spark, dirs):
    put(dirs["in"], "0.log", 1_700_000_000, minute(0), minute(30))
    put(dirs["in"], "1.log", 1_700_000_001, minute(31))
    # Spark drops rows older than the watermark of the batch before: minute 1 is late by now
    put(dirs["in"], "2.log", 1_700_000_002, minute(1), minute(59))
    got = {r.window.start: r.log_count for r in windows(spark, dirs).collect()}
    assert got == {datetime(2024, 1, 1, 0, m): 1 for m in (0, 30, 31)}


def everything(spark, dirs):
    """All lines so far as one batch."""
    features = extract_features(valid_lines(parse_lines(textlogs.scan_lines(spark, str(dirs["in"])))))
    return A.windowed_metrics(features.filter("timestamp is not null"))


def rounded(df):
    names = ["window", "service", "log_count", "error_count", "warn_count", "suspicious_ip_count"]
    spread = [F.round(c, 9) for c in ("avg_response_time", "stddev_response_time")]
    return sorted(map(str, df.select(*names, *spread).collect()))


def test_open_windows_complete_a_bounded_run_and_a_restart(spark, dirs):
    """No window is missing or doubled after a run, and after another that closes some of those open before."""
    for start in (0, 3):
        for f in range(start, start + 3):
            put(dirs["in"], f"{f}.log", 1_700_000_000 + f, *[minute(f * 8 + i, rt=i * 37 % 11, level=("ERROR", "WARN", "INFO")[i % 3]) for i in range(8) for _ in range(i % 3 + 1)])
        emitted = windows(spark, dirs)
        both = detect.all_windows(spark, str(dirs["sink"]), str(dirs["ckpt"]))
        assert 0 < emitted.count() < both.count()
        assert rounded(both) == rounded(everything(spark, dirs))


def test_sliding_windows_on_a_stream(spark, dirs):
    put(dirs["in"], "0.log", 1_700_000_000, minute(0), minute(30))
    got = windows(spark, dirs, duration=detect.WINDOW, slide=detect.SLIDE)
    assert got.count() == 3


def test_running_counters(spark, dirs):
    fill(dirs, 0, 3)
    scored = detect.live_scores(textlogs.stream_lines(spark, str(dirs["in"]), max_files=1), MODEL)
    query = (detect.running_counters(scored).writeStream.outputMode("complete").format("memory")
             .queryName("running").trigger(availableNow=True).start())
    query.awaitTermination()
    row = spark.table("running").first()
    assert (row.total_logs, row.total_anomalies) == (9, 3)


# ------------------------------------------------------------ manifest of the sink


def folders(dirs, table):
    return sorted(p.name for p in (dirs["sink"] / table).iterdir())


def test_batches_are_compacted_and_old_folders_go(spark, dirs):
    fill(dirs, 0, 9)
    run(spark, dirs, graph_every=3, compact=2, keep=2)
    sink = str(dirs["sink"])
    now = manifest.newest(spark, sink)
    assert now.batch_id == 8
    for table in (detect.ANOMALIES, detect.COUNTERS):
        parts = now.of(table)
        assert [(p.first, p.last, p.level) for p in parts] == [(0, 7, 3), (8, 8, 0)]
        rows = detect.read_sink(spark, sink, table)
        assert sorted(r.batch_id for r in rows.collect()) == list(range(9))
    # one snapshot and one graph count; the measures they hold are gone
    assert [len(now.of(t)) for t in (detect.SNAPSHOTS, detect.GRAPHS, detect.EDGES)] == [1, 1, 0]
    assert len(folders(dirs, detect.ANOMALIES)) <= 6 and len(folders(dirs, detect.GRAPHS)) <= 2
    links = [json.loads(r.value) for r in detect.latest_graph(spark, sink).filter("kind = 'link'").collect()]
    assert max(x["value"] for x in links) == 9
    fill(dirs, 9, 1)
    run(spark, dirs, graph_every=3, compact=2, keep=2)  # a restart goes on from there
    assert detect.read_sink(spark, sink, detect.ANOMALIES).count() == 10


def test_replay_while_reading(spark, dirs):
    """A reader that has begun keeps its files while a batch runs again, and the batch counts once."""
    fill(dirs, 0, 2)
    run(spark, dirs, graph_every=1)
    sink = str(dirs["sink"])
    begun = {t: detect.read_sink(spark, sink, t) for t in (detect.ANOMALIES, detect.COUNTERS)}
    graph_before = detect.latest_graph(spark, sink)
    before = manifest.newest(spark, sink)
    for name in os.listdir(dirs["ckpt"] / "commits"):
        if name.strip(".").split(".")[0] == "1":
            os.unlink(dirs["ckpt"] / "commits" / name)
    run(spark, dirs, graph_every=1)
    after = manifest.newest(spark, sink)
    assert after.number == before.number + 1 and after.batch_id == before.batch_id == 1
    assert {p.path for p in before.parts if p.first == 1}.isdisjoint(p.path for p in after.parts)
    assert begun[detect.ANOMALIES].count() == detect.read_sink(spark, sink, detect.ANOMALIES).count() == 2
    assert begun[detect.COUNTERS].agg(F.sum("total_logs")).first()[0] == detect.live_statistics(spark, sink).first().total_logs == 6
    assert sorted(graph_before.collect()) == sorted(detect.latest_graph(spark, sink).collect())


def test_a_batch_without_manifest_does_not_count(spark, dirs, monkeypatch):
    fill(dirs, 0, 1)
    run(spark, dirs, graph_every=0)
    fill(dirs, 1, 1)

    def fails(*args):
        raise OSError("no room")

    monkeypatch.setattr(manifest, "commit", fails)
    with pytest.raises(Exception, match="no room"):
        run(spark, dirs, graph_every=0)
    sink = str(dirs["sink"])
    assert detect.live_statistics(spark, sink).first().total_logs == 3
    monkeypatch.undo()
    run(spark, dirs, graph_every=0)
    assert detect.live_statistics(spark, sink).first().total_logs == 6
    assert detect.read_sink(spark, sink, detect.ANOMALIES).count() == 2


def test_batches_are_limited_by_bytes(spark, dirs):
    fill(dirs, 0, 4)
    lines = textlogs.stream_lines(spark, str(dirs["in"]), max_bytes=1)
    detect.start_detection(lines, MODEL, str(dirs["sink"]), str(dirs["ckpt"]), interval=None, graph_every=0).awaitTermination()
    assert manifest.newest(spark, str(dirs["sink"])).batch_id == 3


def test_processing_time_trigger(spark, dirs):
    """A run with an interval goes on until it is stopped, and picks up files placed meanwhile."""
    fill(dirs, 0, 1)
    lines = textlogs.stream_lines(spark, str(dirs["in"]), max_files=1)
    query = detect.start_detection(lines, MODEL, str(dirs["sink"]), str(dirs["ckpt"]), interval="1 second", graph_every=0)
    try:
        query.processAllAvailable()
        fill(dirs, 1, 1)
        query.processAllAvailable()
        assert query.isActive and detect.live_statistics(spark, str(dirs["sink"])).first().total_logs == 6
    finally:
        query.stop()


def test_nothing_written_yet(spark, tmp_path):
    assert manifest.newest(spark, str(tmp_path)) == manifest.Manifest()
    with pytest.raises(FileNotFoundError):
        detect.read_sink(spark, str(tmp_path), detect.ANOMALIES)
