"""Registered queries of this subpackage: the operators with production parameters over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import bytebpe, chat, jaccard, langid, maintext, periodic, pstable, quality, substrings, suffixes, tokenfiles, toxicity, variants
from emberlog.llm.expressions import let, spaced_words
from emberlog.llm.oracles import ORACLES  # noqa: F401
from emberlog.sources.scratch import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(_table(spark, sf_dir, "documents"), jaccard.Rule(width=3, percent=90))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], rows.schema)
    out = chat.examples(rows.unionByName(more))
    return _read_back(out)


def _read_back(examples: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted examples alone; its turns are read from the last one."""
    loss = F.coalesce(chat.trained(F.col("text"), F.col("loss_start"), F.col("loss_end")), F.lit(""))
    rows = examples.select("conv_id", "example", "text", loss.alias("loss"), F.char_length("text").cast("long").alias("chars"))
    found = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("last"), F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"), F.sum("chars").alias("formatted_chars"),
    )
    trained = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    digests = found.select("conv_id", "last", F.char_length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return digests.mapInArrow(_turn_digests, schema)


def _turn_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        talks = [chat.read_turns(text.as_py()) for text in batch.column(1)]
        digests = [hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest() for turns in talks]
        own = [pa.array([len(turns) for turns in talks], pa.int64()), pa.array(digests, pa.string())]
        yield pa.record_batch([batch.column(0), *own, *batch.columns[2:]], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.repeated_spans(docs)
    return out.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = langid.fit(docs.filter(remainder != 0), F.col("doc_id"))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", F.coalesce(remainder == 0, F.lit(True)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"),
    )


def bpe_digests(docs: DataFrame) -> DataFrame:
    tokenizer = bytebpe.Tokenizer.load(docs.sparkSession, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).learn(docs)
    ids = tokenizer.with_ids(docs.select("doc_id", "text")).select("doc_id", "ids")
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(tokenizer.packed(F.col("ids")), 256).alias("ids_sha256"), F.sha2(tokenizer.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffixes.with_matches(docs, _table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches.item_id", lambda x: x.cast("string"))))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    tokenfiles.write_ids(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokenfiles.read_checks(spark, path)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_duplicates(_table(spark, sf_dir, "embeddings"))


def toxic_scores(docs: DataFrame, labels: DataFrame, column: str = "toxicity") -> DataFrame:
    """``docs`` and an array column: probabilities of low quality, then of toxicity."""
    known = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.predict(docs, toxicity.fit(docs, known, ["low_quality", "toxic"]), column=column)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxic_scores(docs, _table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", F.col("toxicity")[0].alias("low_quality_score"), F.col("toxicity")[1].alias("toxic_score"), (F.col("toxicity")[1] >= toxicity.THRESHOLD).alias("toxic"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = maintext.main_text(pages, maintext.fit(pages))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = quality.scored(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *quality.BASE, "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", _with_repetition(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    out = periodic.collapsed(docs).withColumn("best", best)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


def _with_repetition(doc_id: Column, text: Column) -> Column:
    """``text``; of every tenth document by hash its words, repeated with a period from a place on, both of the hash."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(words, lambda _, i: F.get(words, at(i))), " "))

    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(let(spaced_words(text), repeated), text)).otherwise(text)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.explode(variants.runs_of_letters(F.col("text"))).alias("word"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
    cut = F.pmod(h, F.char_length("word")).cast("int")
    damaged = F.concat(F.left("word", cut), F.substring(F.col("word"), cut + 2, F.char_length("word")))
    return variants.forms(variants.counted(docs.select(F.when(F.pmod(h, F.lit(199)) == 0, damaged).otherwise(F.col("word")).alias("word"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_chat_format, op3_substring_dedup, op4_language, op5_byte_bpe, op6_decontaminate, op7_token_files, op8_embedding_dedup, op9_toxicity, op10_html_text,
        op11_quality_rules, op12_periodic_runs, op13_spelling_variants,
    )
}
