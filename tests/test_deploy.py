"""Runs from another working folder, without the repository on the workers' path."""

import os
import subprocess
import sys

from emberlog.functions.params import AnalysisOptions
from emberlog.plans import analyze
from emberlog.sources import tables

from conftest import ROOT, log_line

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from emberlog.plans.deploy import ship_package
ship_package(spark)
from emberlog.plans.analyze import analyze_ml
rows = [("a", i, f"2024-01-01 10:{{i % 60:02d}}:45.123 [INFO] db-service - ok | IP: 1.1.1.{{i % 9}} | User: u1 | ResponseTime: {{100 + i % 50}}ms") for i in range(200)]
rows += [("a", 900 + i, f"2024-01-01 10:30:45.123 [ERROR] db-service - timeout error failed | IP: 999.1.1.1 | User: u1 | ResponseTime: {{9000 + i}}ms") for i in range(4)]
done = analyze_ml(spark.createDataFrame(rows, "file_id string, line_number bigint, value string"))
scored = done.scored.orderBy("isolation_score", ascending=False).limit(4).collect()
print("FOUND", sorted(r.line_number for r in scored), done.anomalies.count())
"""


def test_ml_analysis_outside_the_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    found = next((x for x in done.stdout.splitlines() if x.startswith("FOUND")), done.stderr[-2000:])
    assert found.startswith("FOUND [900, 901, 902, 903] ")  # the planted outliers are the most isolated lines
    assert int(found.split()[-1]) <= 20  # at most a tenth of the lines are marked


def test_ml_without_complete_rows_falls_back_to_the_rules(lines):
    bad = [log_line(level="ERROR", message="timeout error").rsplit(" | ResponseTime", 1)[0] for _ in range(3)]
    done = analyze.analyze_ml(lines(*bad))
    assert done.analysis_type == analyze.RULES_TYPE
    assert done.rejects.count() == 3 and done.anomalies.count() == 3


def test_result_tables_show_the_current_run_only(spark, lines, tmp_path):
    root, bad = str(tmp_path), lines(log_line(level="ERROR", message="timeout error", rt=9000), log_line())
    rules = AnalysisOptions(use_ml=False)
    only = (tables.ANOMALIES,)
    analyze.analyze_rules(bad, rules).write(root, only)
    assert tables.read_table(spark, root, tables.ANOMALIES).count() == 1
    analyze.analyze_rules(bad, AnalysisOptions(use_ml=False, anomaly_threshold=2.0)).write(root, only)
    assert tables.read_table(spark, root, tables.ANOMALIES).count() == 0  # nothing stale
    analyze.analyze_rules(bad, rules).write(root)
    analyze.analyze_rules(bad, rules).write(root, only)
    assert tables.read_table(spark, root, tables.ANOMALIES).count() == 1  # nothing lost
    assert tables.read_table(spark, root, tables.STATISTICS).count() == 1
