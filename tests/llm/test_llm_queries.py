"""Every query of the subpackage over its whole tables against a plain restatement."""

import base64

import brute
import duckdb
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from emberlog.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def table(columns, name):
    return duckdb.sql(f"select {columns} from '{SF}/{name}.parquet'").fetchall()


def result(spark, name, key, *columns):
    rows = QUERIES[name](spark, SF).collect()
    return {r[key]: tuple(r[c] for c in columns) for r in rows}


def test_op1(spark):
    docs = table("doc_id, text", "documents")
    assert result(spark, "op1_ngram_jaccard", "doc_id", "n_shingles", "component_id") == brute.jaccard_classes(docs)


def test_op2(spark):
    marks = "</s>[INST] ok [/INST]"
    rows = table("conv_id, turn, role, text", "conversations") + [(-1, 0, "user", marks), (-1, 1, "assistant", marks)]
    got = result(spark, "op2_chat_format", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == brute.chat(rows)


def test_op2_groups_no_examples_in_python(spark):
    plan = QUERIES["op2_chat_format"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def test_op3(spark):
    docs = table("doc_id, text", "documents")
    assert result(spark, "op3_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(docs)


def test_op4_held_out_accuracy(spark):
    truth = dict(table("doc_id, lang", "documents"))
    got = result(spark, "op4_language", "doc_id", "held_out", "lang_pred", "score")
    assert got.keys() == truth.keys()
    held = [d for d in got if got[d][0]]
    assert sum(got[d][1] == truth[d] for d in held) >= 0.95 * len(held) > 0
    assert all(0 <= s <= 1 for _, _, s in got.values())


def test_op5(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = table("doc_id, text", "documents")
    assert result(spark, "op5_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == brute.byte_bpe(docs, encoding)


def test_op6(spark):
    got = result(spark, "op6_decontaminate", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(table("doc_id, text", "documents"), table("item_id, text", "benchmark"))


def test_op7(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table("doc_id, text", "documents")
    assert result(spark, "op7_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == brute.token_files(docs, tokenizer)


def test_op8(spark):
    got = result(spark, "op8_embedding_dedup", "vec_id", "n_links", "component_id", "kept")
    assert got == brute.vector_links(table("vec_id, embedding", "embeddings"))


def test_op9_labelled_rows(spark):
    truth = dict(table("doc_id, toxic", "labels"))
    got = result(spark, "op9_toxicity", "doc_id", "toxic")
    clean = [d for d, y in truth.items() if not y and d in got]
    toxic = [d for d, y in truth.items() if y and d in got]
    assert len(got) == len(table("doc_id", "documents"))
    assert not any(got[d][0] for d in clean)
    assert sum(got[d][0] for d in toxic) >= 0.8 * len(toxic)


def test_op9_finds_every_toxic_row(spark):
    sf = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet' where doc_id is not null and toxic is not null").fetchall())
    got = {r.doc_id: r.toxic for r in QUERIES["op9_toxicity"](spark, sf).collect()}
    wrong = {d: y for d, y in truth.items() if d in got and got[d] != bool(y)}
    assert any(truth.values()) and not wrong


def test_op10(spark):
    got = result(spark, "op10_html_text", "page_id", "text", "n_chars")
    expected = {p: brute.article_text(h) for p, h in table("page_id, html", "pages")}
    assert got == {p: (t, len(t)) for p, t in expected.items()}


def test_pipeline(spark):
    import corpus_pipeline

    toxic = result(spark, "op9_toxicity", "doc_id", "toxic")
    docs = [(d, t) for d, t in table("doc_id, text", "documents") if not toxic[d][0]]
    classes = brute.jaccard_classes(docs, 5, 80)
    docs = [(d, t) for d, t in docs if classes[d][1] == d]
    cut = brute.substring_dedup(docs, texts=True)
    docs = [(d, cut[d]) for d, _ in docs]
    found = brute.contamination(docs, table("item_id, text", "benchmark"))
    docs = [(d, t) for d, t in docs if not found[d][4]]
    got = corpus_pipeline.run(spark, SF).select("doc_id", "decoded_sha256").collect()
    assert dict(map(tuple, got)) == {d: brute.sha(t) for d, t in docs}

