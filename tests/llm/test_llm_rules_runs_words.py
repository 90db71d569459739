"""Quality by weak supervision, periodic runs and spelling variants: edge cases and plain restatements."""

import random

import brute
import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberlog.llm import periodic, quality, variants
from emberlog.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_words string, votes string, quality string, runs string, word string, kept string"


def frame(spark, texts):
    return spark.createDataFrame([(k, t, *["own"] * 6) for k, t in texts], SCHEMA)


def documents():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()


LINE = "the quick brown fox jumps over it.\n"
TEXTS = [
    (1, None), (2, ""), (3, " \t\n \x0b"), (4, "one two"), (5, LINE * 3), (5, LINE * 3), (6, "a b c d e f a b c d e"), (7, "a " * 9 + "b"),
    (None, "é!! # ** <x> | $%&\n\nÀ É\n\nÀ É "), (8, "漢字 " * 4), (9, " ".join(f"w{i}" for i in range(5000)) + " w1 w2 w3 w4 w5"), (10, "x" * 100_000),
]


def test_figures_of_every_kind_of_text(spark):
    out = quality.with_figures(frame(spark, TEXTS)).select("doc_id", *quality.BASE).collect()
    want = [(k, *brute.text_figures(t)) for k, t in TEXTS]
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))


def test_scored_keeps_rows_and_other_columns(spark):
    out, _ = quality.scored(frame(spark, TEXTS))
    rows = out.collect()
    assert len(rows) == len(TEXTS) and all(r.runs == "own" for r in rows)
    assert all(not r.kept for r in rows if r.n_words < 10) and {r.n_words for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert all(set(r.votes) == {0} for r in rows if r.n_words == 0)


def test_quality_of_an_empty_table(spark):
    out, model = quality.scored(frame(spark, []))
    assert out.count() == 0 and model == quality.Model.start(len(quality.RULES))


def test_estimate_finds_planted_accuracies(spark):
    """Votes drawn from known rates; the estimate sees no truth."""
    r = random.Random(3)
    right, wrong = [0.95, 0.9, 0.85, 0.97], [0.1, 0.3, 0.2, 0.4]
    rows = []
    for k in range(20_000):
        good = r.random() < 0.8
        share = right if good else wrong
        rows.append((k, good, [0 if r.random() < 0.2 else 1 if r.random() < p else -1 for p in share]))
    voted = spark.createDataFrame(rows, "id long, good boolean, votes array<tinyint>")
    model = quality.fit(voted, rules=4, rounds=60)
    assert abs(model.prior - 0.8) < 0.05
    assert np.abs(np.array(model.right) - right).max() < 0.05 and np.abs(np.array(model.wrong) - wrong).max() < 0.1
    said = voted.withColumn("said", model.posterior(F.col("votes")) >= 0.5).filter("said = good").count()
    assert said > 0.93 * len(rows)


def test_posterior_replaces_all_must_pass(spark):
    """One bad vote among nine good ones does not reject; the estimate decides from all votes."""
    model = quality.Model(0.9, (0.98,) * 10, (0.3,) * 10)
    votes = spark.createDataFrame([(1, [1] * 9 + [-1]), (2, [-1] * 9 + [1]), (3, [0] * 10)], "id int, votes array<tinyint>")
    said = {r.id: r.q for r in votes.select("id", model.posterior(F.col("votes")).alias("q")).collect()}
    assert said[1] > 0.5 > said[2] and said[3] == pytest.approx(0.9)


def test_quality_against_labels(spark):
    """Labels are never read; documents labelled good stay, labelled bad go."""
    sf = SF.replace("0.001", "0.01")
    out = QUERIES["op11_quality_rules"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    counts = {(r.label, r.kept): r["count"] for r in out.join(labels, "doc_id").groupBy("label", "kept").count().collect()}
    assert counts.get((1, True), 0) >= 0.95 * sum(v for (label, _), v in counts.items() if label == 1)
    assert counts.get((0, False), 0) >= 0.95 * sum(v for (label, _), v in counts.items() if label == 0)


def test_quality_stays_in_the_jvm(spark):
    out, _ = quality.scored(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = out._jdf.queryExecution().optimizedPlan().toString() + quality.with_figures(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# periodic runs


def found(words, least=12):
    return [(s, e - s, q) for s, e, q in zip(*(x.tolist() for x in periodic.find_runs(np.array(words, np.int64), len(words), least)), strict=True)]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_runs_of_random_sequences(data):
    letters = data.draw(st.integers(1, 4))
    words = data.draw(st.lists(st.integers(0, letters), max_size=60))
    for _ in range(data.draw(st.integers(0, 4))):
        piece = words[-data.draw(st.integers(1, 60)) :] or [0]
        words = words + (piece * data.draw(st.integers(1, 4)))[: data.draw(st.integers(1, 150))]
    assert found(words) == brute.runs(words)


@pytest.mark.parametrize("n, period", [(12, 1), (11, 1), (12, 6), (400, 1), (5000, 1234), (3000, 30), (3000, 31), (3000, 62), (3000, 63), (3001, 1500)])
def test_run_of_one_period(n, period):
    words = [k % period for k in range(n)]
    assert found(words) == ([(0, n, period)] if n >= max(12, 2 * period) else [])


def test_sum_that_is_zero_modulo_the_prime_only_is_no_run():
    """Blocks whose squared differences sum to a multiple of the prime are rejected word by word."""
    root = pow(periodic._ROOT, (periodic._PRIME - 1) // 4, periodic._PRIME)  # its square is -1
    block = np.zeros(64, np.int64)
    other = block.copy()
    other[:2] = [1, root]
    x = np.concatenate([np.arange(5, 5 + 64) * 7, block, block, other, other, np.arange(900, 1000)])
    assert found(x.tolist()) == brute.runs(x.tolist())


def test_one_word_repeated_is_one_run_and_linear_in_seeds():
    assert found([0] * 100_000) == [(0, 100_000, 1)]


def test_collapsed_texts(spark):
    texts = [*TEXTS, (20, "x y " * 12 + "end"), (21, " ".join("abc" * 5 + "q" + "abc" * 9)), (22, ("p q r s t u v w " * 40).strip())]
    rows = periodic.collapsed(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    got = sorted(repr((r.doc_id, [tuple(x) for x in r.runs], r.text)) for r in rows)
    want = []
    for k, t in texts:
        w = brute.spaced(t)
        runs = brute.runs(w) if len(w) < 3000 else []
        want.append(repr((k, runs, brute.without_runs(w, runs))))
    assert got == sorted(want) and {r.n_words for r in rows} == {"own"}


def test_runs_do_not_cross_texts(spark):
    docs = frame(spark, [(k, "z " * 8) for k in range(50)] + [(99, "z " * 20)])
    rows = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.collapsed(docs).collect()}
    assert rows.pop(99) == [(0, 20, 1)] and not any(rows.values())


def test_runs_of_an_empty_table(spark):
    assert periodic.collapsed(frame(spark, [])).count() == 0


def test_op12(spark):
    rows = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = documents()
    assert len(rows) == len(docs)
    some = 0
    for doc, text in docs:
        w = brute.planted(doc, text)
        if len(w) > 1500 and len(w) == len(brute.spaced(text)) and w == brute.spaced(text):
            continue  # the plain search takes the square of the length
        runs, r = brute.runs(w), rows[doc]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        some += bool(runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == brute.sha(brute.without_runs(w, runs))
    assert some >= 10


# spelling variants


def test_signatures_are_exact():
    """Vectors at distance k or less share a signature, whatever the parts."""
    for k, first, second in [(2, 1, 4), (2, 3, 1), (2, 1, 3), (1, 1, 3), (1, 2, 1), (1, 1, 2), (3, 2, 3)]:
        parts = first * second
        for differing in range(parts**k):
            hit = {differing // parts**i % parts for i in range(k)}
            assert any(not hit & set(own) for own in variants.choices(k, first, second))
    with pytest.raises(ValueError):
        variants.choices(2, 2, 3)


def random_words(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(6, 9))) for _ in range(n)]
    for w in list(words):
        at = r.randrange(len(w))
        words += [w[:at] + w[at + 1 :], w[:at] + r.choice("abcdß") + w[at:], w[:at] + r.choice("xyzé") + w[at + 1 :], w[::-1], "".join(sorted(w))]
    return {w: r.choice([5, 6, 7, 25, 30, 125, 600, 3000]) for w in words if len(w) >= 6}


def test_forms_equal_all_against_all(spark):
    counts = random_words(150, 5)
    rows = variants.forms(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {r.word: tuple(r)[1:] for r in rows} == brute.spelling_variants(counts)


def test_chains_are_followed_to_the_end(spark):
    chain = ["letters", "letterss", "lettersst", "letterssta", "lettersstay", "lettersstayy", "lettersstayyz", "lettersstayyzz"]
    counts = {w: 5 * 5**k for k, w in enumerate(chain)}
    rows = {r.word: r for r in variants.forms(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert {r.root for r in rows.values()} == {chain[-1]} and rows[chain[-1]].form is None


def test_ties_and_hot_signatures(spark):
    """A few hundred words that share half their letters; ties go to the smallest word."""
    r = random.Random(1)
    counts = {"common" + "".join(r.choice("abcdef") for _ in range(3)): r.choice([5, 25, 25]) for _ in range(300)}
    rows = variants.forms(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {x.word: tuple(x)[1:] for x in rows} == brute.spelling_variants(counts)


def test_no_words(spark):
    assert variants.forms(spark.createDataFrame([], "word string, n long")).count() == 0
    assert variants.forms(spark.createDataFrame([("lonely", 7, "own")], "word string, n long, letters string")).collect()[0].root == "lonely"
    texts = frame(spark, [(1, None), (2, ""), (3, "ABC×÷é Àb-c d1e")])
    got = texts.select(variants.runs_of_letters(F.col("text")).alias("w")).collect()
    assert [r.w for r in got] == [[], [], ["abc×÷é", "Àb", "c", "d", "e"]]


def test_op13(spark):
    counts = brute.damaged_words(documents())
    rows = QUERIES["op13_spelling_variants"](spark, SF).collect()
    assert {r.word: tuple(r)[1:] for r in rows} == brute.spelling_variants(counts)
