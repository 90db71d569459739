"""What the joins write and leave on disk."""

import os
import random
import time

import brute
from pyspark.sql import functions as F

from emberlog.llm import jaccard
from emberlog.sources import scratch

WORDS = [f"w{i}" for i in range(4000)]


def passage(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def shuffle_files(spark):
    places = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for p in places for _, _, names in os.walk(p.getPath()) for f in names if f.startswith("shuffle_")}


def test_common_passage_makes_no_candidates(spark):
    """A passage that many texts share, far from the threshold: no set is sent. Two copies with an edit are still found."""
    shared = passage(1, 150)
    rows = [(i, f"{passage(100 + i, 300)} {shared}") for i in range(60)]
    rows += [(60, rows[7][1] + " w1 w2 w3"), (61, "w5 w6 " + rows[9][1])]
    root = os.path.dirname(scratch.scratch_dir(spark, "x")).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(docs).collect()}
    assert got == brute.jaccard_classes(rows, 5, 80) and got[60][1] == 7 and got[61][1] == 9
    made = set(os.listdir(root)) - before
    assert not [x for x in made if x.startswith(("hashes-", "fragments-"))]  # nothing reads them any more
    (stars,), (pairs,) = ([x for x in made if x.startswith(f"{kind}-")] for kind in ("stars", "pairs"))
    assert spark.read.parquet(f"{root}/{stars}").select("sid").distinct().count() <= 4
    assert spark.read.parquet(f"{root}/{pairs}").count() <= 6


def test_staged_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    table = scratch.staged(spark.range(10_000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "t")
    assert table.count() == 10 and spark.conf.get(key, None) == was
    left, until = None, time.time() + 20
    while time.time() < until and (left := {f for f in shuffle_files(spark) - before if not f.startswith("shuffle_checksum")}):
        time.sleep(0.2)
    # what count() itself has dealt out: a row from each of its tasks
    assert len(left) <= 4


def test_passing_tables_go_with_their_block(spark):
    with scratch.passing(spark.range(5), "p") as table:
        path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert table.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)
