"""Quality of documents by weak supervision, in DataFrame functions alone.

Rules look at a few figures of each text. A rule votes good, votes bad or abstains.
No rule decides by itself: expectation-maximisation over the table of vote patterns
estimates, without labels, how often each rule votes good on good and on bad documents, and how
many documents are good. The posterior probability of a document's votes is its
quality; a document is kept from ``KEEP_FROM`` on, unless it fails the base rules.

Documents that fail the base rules are decided and take no part in the estimate, which would
otherwise learn to tell those from the rest.

The pattern table has at most 3 ** rules rows, whatever the number of documents, and
is made by one aggregate with partial counts per task. Each round of the estimate is one aggregate over
it, of which the driver gets one row with sums for every rule.

Figures of a text (words are what lies between blanks): n_words, word_chars, n_symbols,
n_dup_lines (lines with a word, equal to an earlier one), n_repeat_words (words in windows of five
that occur twice or more), and those that only rules use. Windows are compared by 64-bit
hashes, sorted only in texts that repeat one.

Defined cases: null, empty or blank text has no words, all figures 0, fails the base
rules and abstains from the estimate; very long texts are one row each, their arrays grow with
the text; repeated rows count as often as they stand there; without documents the estimate
stays at its start; rows keep null ids; columns named like the figures are replaced by them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.expressions import count_signs, let, spaced_words
from emberlog.sources.scratch import staged

WINDOW = 5
SYMBOLS = "#*$%&|<>"
KEEP_FROM = 0.5
ROUNDS = 20
LEAST_WORDS, REPEAT_PERCENT = 10, 20
#: Before any vote is seen: share of good documents, and share of good votes on good and on bad ones.
PRIOR, RIGHT, WRONG = 0.8, 0.98, 0.6
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_lines", "n_ended", "n_capitals", "n_letters", "n_shouts", "n_distinct"]


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the figures; good is asked first, neither is an abstention."""

    name: str
    good: str
    bad: str


RULES = [
    Rule("length", "n_words >= 50", "n_words < 20"),
    Rule("word_length", "word_chars between 3 * n_words and 9 * n_words", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
    Rule("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Rule("equal_lines", "n_dup_lines = 0 and n_lines >= 3", "10 * n_dup_lines > 3 * n_lines"),
    Rule("repeats", "50 * n_repeat_words <= n_words", "10 * n_repeat_words > n_words"),
    Rule("capitals", "8 * n_capitals <= n_letters and n_letters > 0", "3 * n_capitals > n_letters"),
    Rule("letters", "10 * n_letters >= 9 * word_chars", "10 * n_letters < 7 * word_chars"),
    Rule("line_ends", "2 * n_ended >= n_lines", "10 * n_ended < n_lines"),
    Rule("shouts", "n_shouts = 0", "20 * n_shouts > n_words"),
    Rule("variety", "n_words >= 20 and 10 * n_distinct >= 3 * n_words", "10 * n_distinct < n_words"),
]


@dataclass(frozen=True)
class Model:
    """Share of good documents; of each rule's votes, the share that is good on good and on bad documents."""

    prior: float
    right: tuple[float, ...]
    wrong: tuple[float, ...]

    @classmethod
    def start(cls, rules: int) -> Model:
        return cls(PRIOR, (RIGHT,) * rules, (WRONG,) * rules)

    def posterior(self, votes: Column) -> Column:
        """Probability that a document with these votes is good."""
        # arrays of constants, so that the code generated is the same in every round
        sides = [(math.log(a / b), math.log((1 - a) / (1 - b))) for a, b in zip(self.right, self.wrong, strict=True)]
        yes, no = (F.array(*[F.lit(x[k]) for x in sides]) for k in (0, 1))
        weights = F.transform(votes, lambda v, k: F.when(v > 0, F.get(yes, k)).when(v < 0, F.get(no, k)).otherwise(0.0))
        weight = F.aggregate(weights, F.lit(math.log(self.prior / (1 - self.prior))), lambda a, b: a + b)
        return 1 / (1 + F.exp(-weight))


def with_figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the figures of each text (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = let(spaced_words(text), _word_figures)
    lines = let(F.filter(F.split(text, "\n", -1), lambda x: F.char_length(F.translate(x, " \t\n\x0b\f\r", "")) > 0), _line_figures)
    out = docs.withColumns({"__text": text, "__words": words, "__lines": lines})
    solid = F.translate("__text", " \t\n\x0b\f\r", "")
    figures = {
        "n_words": F.col("__words.n_words"),
        "word_chars": F.char_length(solid),
        "n_symbols": count_signs(F.col("__text"), SYMBOLS),
        "n_dup_lines": F.col("__lines.n_dup_lines"),
        "n_repeat_words": F.col("__words.n_repeat_words"),
        "n_lines": F.col("__lines.n_lines"),
        "n_ended": F.col("__lines.n_ended"),
        "n_capitals": F.char_length(F.regexp_replace("__text", r"\P{Lu}+", "")),
        "n_letters": F.char_length(F.regexp_replace("__text", r"\P{L}+", "")),
        "n_shouts": F.floor((F.char_length("__text") - F.char_length(F.replace("__text", F.lit("!!"), F.lit("")))) / 2),
        "n_distinct": F.col("__words.n_distinct"),
    }
    return out.withColumns({k: v.cast("long") for k, v in figures.items()}).drop("__text", "__words", "__lines")


def _line_figures(lines: Column) -> Column:
    size = F.size(lines)
    return F.struct(
        size.alias("n_lines"), (size - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"[.!?][\x22\x27)\x{201D}\x{00BB}]?\s*\z"))).alias("n_ended"),
    )


def _word_figures(words: Column) -> Column:
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.struct(
        F.size(h).alias("n_words"), F.size(F.array_distinct(h)).alias("n_distinct"),
        F.when(F.size(h) > WINDOW, let(_windows(h), _repeated)).otherwise(0).alias("n_repeat_words"),
    ))


def _windows(hashes: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
    )


def _repeated(windows: Column) -> Column:
    """Words covered by the windows that occur more than once."""
    def marked(ordered: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
        at = F.transform(ordered, lambda x, k: F.when(same(k - 1, x) | same(k + 1, x), x["i"]))
        return let(F.sort_array(F.filter(at, lambda i: i.isNotNull())), _covered)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ordered, marked))


def _covered(at: Column) -> Column:
    steps = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: F.least(F.lit(WINDOW), b - a))
    return F.aggregate(steps, F.lit(WINDOW), lambda n, x: n + x)


def base_failed() -> Column:
    """The rules that no vote can outweigh."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def votes(rules: list[Rule] = RULES) -> Column:
    """1 for good, -1 for bad, 0 for an abstention, by rule; a text without words abstains everywhere."""
    one = lambda r: F.when(F.col("n_words") == 0, 0).when(F.expr(r.good), 1).when(F.expr(r.bad), -1).otherwise(0)
    return F.array(*[one(r).cast("tinyint") for r in rules])


def fit(voted: DataFrame, column: str = "votes", rules: int = len(RULES), rounds: int = ROUNDS) -> Model:
    """Estimate from the votes of all documents that have one."""
    some = F.exists(column, lambda v: v != 0)
    patterns = staged(voted.filter(some).groupBy(column).agg(F.count("*").alias("n")), "vote-patterns")
    model = Model.start(rules)
    for _ in range(rounds):
        model = _next(patterns, column, model)
    return model


def _next(patterns: DataFrame, column: str, model: Model) -> Model:
    own = F.col(column)
    found = patterns.select("n", column, model.posterior(own).alias("good"))
    sides = {"good": F.col("n") * F.col("good"), "bad": F.col("n") * (1 - F.col("good"))}
    sums = [F.sum(w).alias(side) for side, w in sides.items()]
    for k in range(len(model.right)):
        for side, w in sides.items():
            sums += [F.sum(F.when(own[k] > 0, w)).alias(f"{side}_yes_{k}"), F.sum(F.when(own[k] != 0, w)).alias(f"{side}_all_{k}")]
    row = found.agg(*sums).first()
    if not row["good"]:
        return model
    # each share starts with one document's weight, so that none becomes 0 or 1
    share = lambda side, k, start: ((row[f"{side}_yes_{k}"] or 0.0) + start) / ((row[f"{side}_all_{k}"] or 0.0) + 1)
    numbers = range(len(model.right))
    return replace(
        model, prior=(row["good"] + PRIOR) / (row["good"] + row["bad"] + 1),
        right=tuple(share("good", k, RIGHT) for k in numbers), wrong=tuple(share("bad", k, WRONG) for k in numbers),
    )


def scored(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> tuple[DataFrame, Model]:
    """``docs`` without its text, with the base figures, votes, base_failed, quality and kept; and the model."""
    drop = [text_col, *[c for c in docs.columns if c in {*BASE, *_MORE, "votes", "base_failed", "quality", "kept"} - {text_col}]]
    figures = with_figures(docs.drop(*drop[1:]), text_col).withColumns({"votes": votes(rules), "base_failed": base_failed()})
    figures = staged(figures.drop(text_col, *_MORE), "figures")
    model = fit(figures.filter(~F.col("base_failed")), rules=len(rules))
    out = figures.withColumn("quality", model.posterior(F.col("votes")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)), model
