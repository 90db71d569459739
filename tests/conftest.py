import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("emberlog-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Raw lines from strings."""

    def make(*values, file_id="a.log_1"):
        rows = [(file_id, i, v) for i, v in enumerate(values, start=1)]
        return spark.createDataFrame(rows, "file_id string, line_number bigint, value string")

    return make


def log_line(
    ts="2024-01-01 10:30:45.123", level="INFO", service="db-service", message="request served",
    ip="192.168.1.1", user="user_0001", rt=100,
):
    return f"{ts} [{level}] {service} - {message} | IP: {ip} | User: {user} | ResponseTime: {rt}ms"
