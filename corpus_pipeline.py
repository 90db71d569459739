"""A corpus pipeline: toxicity, near-duplicates, repeated passages, contamination, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the documents of the next. All stages but the last return the
columns of ``documents`` and work on all that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import jaccard, queries, substrings, suffixes, toxicity
from emberlog.sources.scratch import staged

#: DuckDB SQL cannot express the models and digests; tests/llm compares with plain restatements.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, the last link of the chain, stays below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return queries.toxic_scores(docs, labels, "__toxicity").filter(F.element_at("__toxicity", -1) < toxicity.THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of five-word shingle sets with Jaccard 0.8 or more."""
    return jaccard.one_of_each(docs, jaccard.Rule(width=5, percent=80))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words and more that also start in a document with a smaller id."""
    out = substrings.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    return suffixes.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
