"""Spelling variants by PartEnum signatures of letter multisets.

Two words one edit apart differ in at most two places of their letter multisets: a replaced letter
takes one letter away and adds another, an inserted or deleted one only adds or takes one. A
multiset is a binary vector with a place for each letter and each of its repetitions.
PartEnum gives such vectors signatures that two of them share whenever their Hamming distance
is at most k: the places are dealt to ``FIRST`` x ``SECOND`` parts by letter, and within
each first-level group every choice of parts that can have stayed without a
difference, (k + 1) / FIRST - 1 of them left out, is one signature: the letters in those parts.

Words of one length are joined with k = 2 (a replacement), words whose lengths differ by
one with k = 1. A signature that many words share is split by
the half of the word that the edit has left alone: at least one of the halves is the same in
both words, so each signature is taken twice, with the first and with the last letters.
Equal signatures are joined as 64-bit hashes, and every pair is verified by its edit distance in
the join, before any row is made. Pairs are counted once, whatever number of signatures found them.

A form has at least ``TIMES`` times the occurrences of its word, so chains of forms have at most
log(occurrences) / log(TIMES) links and are followed by pointer doubling. A form has a bounded number of near
words (its length times the letters), so no join key is hot.

Defined cases: null text has no words; equal words are one word with their sum; ties of forms go to
the smallest word in code-point order; empty tables give no rows; very long words are
words like others (texts are cut by one pattern in the JVM); further columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.sources.scratch import staged

PATTERN = r"[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: First-level groups and second-level parts, for words of one length (k = 2) and of neighbouring lengths (k = 1).
FIRST, SECOND = {2: 1, 1: 1}, {2: 4, 1: 3}
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))


def runs_of_letters(text: Column) -> Column:
    """Array of maximal runs of letters; only A-Z are lower-cased."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(PATTERN), F.lit(0))


def counted(words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words (column ``word``) that are long and frequent enough; partial counts come before the shuffle."""
    return words.filter(F.char_length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def choices(k: int, first: int, second: int) -> list[list[int]]:
    """The parts that make up each signature; parts of group g are g * second to g * second + second - 1."""
    left_out, rest = divmod(k + 1, first)
    left_out -= 1
    if rest or left_out >= second:
        raise ValueError(f"{first} groups of {second} parts have no signatures for distance {k}")
    return [[g * second + p for p in own] for g in range(first) for own in combinations(range(second), second - left_out)]


def signatures(letters: Column, k: int) -> list[Column]:
    """The signatures of the sorted letters of a word."""
    parts = FIRST[k] * SECOND[k]
    out = []
    for number, own in enumerate(choices(k, FIRST[k], SECOND[k])):
        others = "".join(c for at, c in enumerate(LETTERS) if at % parts not in own)
        out.append(F.concat(F.lit(f"{number}:"), F.translate(letters, others, "")))
    return out


def _keys(length: Column, role: int) -> Column:
    """Hashes of a word's signatures. Roles: 2 joins words of ``length``; 1 is the longer, 0 the shorter word of a pair whose shorter has ``length``."""
    k = 2 if role == 2 else 1
    half = F.floor(length / 2).cast("int")
    word = F.col("word")
    # in front of the edit stand the first ``half`` letters of the shorter word, or behind it all others
    sides = [F.concat(F.lit("<"), F.left(word, half)), F.concat(F.lit(">"), F.right(word, length - half))]
    return F.array(*[F.xxhash64(F.lit(k), length, s, side) for s in signatures(F.col("letters"), k) for side in sides])


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b of all words one edit apart, each pair once, a the shorter or smaller word. ``words``: word, n."""
    rows = words.select("word", "n", F.array_join(F.sort_array(F.split("word", "")), "").alias("letters"), F.char_length("word").alias("length"))

    def keyed(length: Column, role: int, name: str) -> DataFrame:
        return rows.select(F.explode(_keys(length, role)).alias("key"), F.col("word").alias(name), F.col("n").alias(f"n_{name}"))

    one_edit = F.levenshtein("a", "b", 1) == 1
    length = F.col("length")
    same = keyed(length, 2, "a").join(keyed(length, 2, "b"), "key").filter((F.col("a") < F.col("b")) & one_edit)
    longer = keyed(length, 0, "a").join(keyed(length - 1, 1, "b"), "key").filter(one_edit)
    return same.union(longer).select("a", "n_a", "b", "n_b").dropDuplicates(["a", "b"])


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n)."""
    words = staged(words.select("word", "n"), "words")
    pairs = staged(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_other"))
    both = both.union(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    has = -F.col("best.less") >= times * F.col("n")
    found = joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n"))
    found = staged(found, "forms")
    roots = _followed(found.filter("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _followed(links: DataFrame) -> DataFrame:
    """word and root: the end of the chain of each word; the links reached double in each round."""
    at = links
    while True:
        ahead = at.select(F.col("word").alias("__at"), F.col("root").alias("__ahead"))
        further = at.join(ahead, at.root == ahead["__at"], "left")
        at = staged(further.select("word", F.coalesce("__ahead", "root").alias("root"), F.col("__ahead").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")
