"""Connected components of a table of links, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.sources.scratch import staged


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) for every id in ``links`` (columns a and b, long).

    Alternating large and small stars: every round joins each node's neighbours to
    the smallest of them, until all links are stars. Rounds grow with the logarithm
    of the links, not with the size of a component, and the smallest neighbour is
    an aggregate, so a centre with many neighbours is one row per task. Nulls and
    links of an id to itself are left out.
    """
    pairs = _distinct(links.filter("a <> b"), F.greatest("a", "b"), F.least("a", "b"))
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).withColumn("m", F.least("m", "hi"))
        large = both.join(least, "hi").filter("lo > hi")
        large = large.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        small = joined.filter("lo <> m").select(F.col("lo"), F.col("m")).union(least.select("hi", "m"))
        pairs = _distinct(small, F.col("lo"), F.col("m"))
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
                pairs.select("lo", F.col("lo").alias("component")).distinct()
            )
        before = now


def _distinct(rows: DataFrame, hi, lo) -> DataFrame:
    return staged(rows.select(hi.alias("hi"), lo.alias("lo")).distinct(), "links")
