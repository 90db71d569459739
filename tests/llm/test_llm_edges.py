"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, hot groups."""

import json
import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emberlog.llm import bytebpe, chat, jaccard, langid, maintext, pstable, substrings, suffixes, tokenfiles, toxicity
from emberlog.llm.components import components
from emberlog.llm.dom import parse, words

WORDS = [f"w{i}" for i in range(4000)]
SCHEMA = "doc_id long, text string, lang string, sid string, n_words string, repeats string, language string, toxicity string, matches string, main_text string, component string, ids string"


def passage(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    shared = passage(1, 60)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "alpha beta"), (5, "ALPHA beta Alpha"), (6, "alpha beta"), (7, shared), (8, shared + " more"),
        (8, shared + " more"), (9, passage(2, 30) + "  " + shared + "\n" + passage(3, 30)), (10, passage(4, 60_000)), (11, "é漢字 　 x's"),
        (12, shared.upper()), (13, passage(5, 13)), (14, passage(5, 13)), (15, "x" * 300), (16, "a b c"), (17, "a b c d"),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def frame(spark, rows):
    return spark.createDataFrame([(*r[:2], r[2] if len(r) == 3 else "xx", *["own"] * 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def variants(n, length, edits, seed=0):
    """Copies of one text, each with up to ``edits`` words of its own."""
    r = random.Random(seed)
    base = [r.choice(WORDS) for _ in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(length)] = f"x{i}y{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_edges(docs, rows, width, percent):
    got = jaccard.jaccard_classes(docs, jaccard.Rule(width, percent)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_classes(rows, width, percent)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_loses_no_link_in_large_groups(spark, width, percent):
    texts = variants(420, 110, 5) + variants(40, 12, 2, seed=1) + variants(60, 300, 16, seed=2) + [passage(9, 40)] * 5
    rows = list(enumerate(texts))
    got = jaccard.jaccard_classes(frame(spark, rows), jaccard.Rule(width, percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_classes(rows, width, percent)


def test_jaccard_links_grow_with_a_group_not_with_its_square(spark):
    for n in (600, 1200):
        _, found = jaccard.links(frame(spark, list(enumerate(variants(n, 110, 2)))), jaccard.Rule(3, 90))
        links, parts = found.count(), components(found)
        needed = parts.count() - parts.select("component").distinct().count()  # to hold the components together
        assert links == found.distinct().count() and n // 2 < needed <= links <= 1.5 * needed


def test_jaccard_overlaps_are_summed_over_fragments(spark):
    """Pairs right at the threshold and one shingle below it, each with parts in every fragment."""
    words = [f"w{i}" for i in range(60)]
    exact = words[:47] + ["x1"]  # of 58 shingles 45 in common: 45 / (58 + 46 - 45) = 45 / 59
    rows = [(1, " ".join(words)), (2, " ".join(exact)), (3, " ".join(words[:50])), (4, " ".join(words[10:60]))]
    for percent in (70, 75, 76, 77, 80, 82, 83):
        got = jaccard.jaccard_classes(frame(spark, rows), jaccard.Rule(3, percent)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_classes(rows, 3, percent)


def test_jaccard_null_ids_and_columns(spark, docs, nothing):
    some = frame(spark, [(None, passage(1, 50)), (None, passage(1, 50)), (3, passage(1, 50)), (4, passage(1, 50))])
    got = sorted(map(tuple, jaccard.jaccard_classes(some).collect()), key=str)
    assert got == [(3, 46, 3), (4, 46, 3), (None, 46, None), (None, 46, None)]
    kept = jaccard.one_of_each(some)
    assert kept.columns == some.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3]
    assert jaccard.jaccard_classes(nothing).count() == 0


def test_substrings_edges(docs, rows, nothing):
    got = substrings.repeated_spans(docs)
    assert set(got.columns) == set(docs.columns)
    expected = brute.substring_dedup(rows)
    seen = got.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept"), "repeats.spans").collect()
    assert len(seen) == len(rows)
    for r in seen:
        assert (r.n_words, r.n_removed, r.kept) == expected[r.doc_id]
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    assert substrings.without_repeats(docs).columns == docs.columns
    assert substrings.repeated_spans(nothing).count() == 0


def test_substrings_null_id_is_last(spark):
    some = frame(spark, [(None, passage(1, 40)), (5, passage(1, 40)), (None, passage(1, 40))])
    got = {(r.doc_id, r.repeats.n_removed) for r in substrings.repeated_spans(some).collect()}
    assert got == {(5, 0), (None, 40)}


def test_suffixes_edges(spark, docs, rows, nothing):
    items = [(1, passage(1, 60)), (2, None), (None, passage(4, 20)), (4, ""), (5, "alpha beta"), (5, "alpha"), (6, "b c"), (7, passage(5, 13)), (8, passage(5, 13) + " more"), (9, "aa aa aa")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = suffixes.with_matches(docs, bench)
    seen = {r.doc_id: r for r in got.collect()}
    known = [(i, t) for i, t in items if i is not None and t]
    for doc, (n_words, n_hit, n_items, _, bad) in brute.contamination(rows, known).items():
        r = seen[doc]
        assert (r.n_words, r.n_hit, len({m.item_id for m in r.matches}), r.contaminated) == (n_words, n_hit, n_items, bad)
    longest = max(seen[9].matches, key=lambda m: m.n_words)
    assert (longest.item_id, longest.item_start, longest.doc_start, longest.n_words) == (1, 0, 30, 60)
    assert suffixes.decontaminated(docs, bench).columns == docs.columns
    assert suffixes.with_matches(nothing, bench).count() == 0
    assert not suffixes.with_matches(docs, bench.limit(0)).filter("contaminated").count()


def test_suffix_array_is_sorted():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 400):
        x = r.integers(0, 3, n)
        assert suffixes.suffix_array(x).tolist() == sorted(range(n), key=lambda k: x[k:].tolist())


def test_token_files_edges(spark, docs, rows, nothing, tmp_path):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(vocabulary)
    some = rows + [(None, "first")]
    tokenfiles.write_ids(frame(spark, some), f"{tmp_path}/ids", vocabulary, end_id=2)
    got = sorted(tokenfiles.read_ids(spark, f"{tmp_path}/ids").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in some), key=lambda d: -1 if d is None else d)
    texts = {}
    for d, t in some:
        texts.setdefault(d, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    start = 0
    for r in got:
        assert r.start == start
        assert np.frombuffer(r.ids, "<u2").tolist() in texts[r.doc_id]
        start += r.n_tokens
    tokenfiles.write_ids(nothing, f"{tmp_path}/none", vocabulary, end_id=2)
    assert json.load(open(f"{tmp_path}/none/manifest.json"))["n_tokens"] == 0
    assert tokenfiles.read_checks(spark, f"{tmp_path}/none").count() == 0


def test_token_files_added_tokens(spark, tmp_path):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, mark = Tokenizer.from_file(vocabulary), "<|endoftext|>"
    texts = [
        None, f"a{mark}b", mark, f"{mark}{mark}", "", f" é漢  {mark}  it's{mark}'s \n", f"<|endof{mark}text|>", "<|endoftext|", ">", f"x{mark}", "<|endoftext |>",
        f"{mark} ", passage(6, 400) + mark + passage(7, 400),
    ]
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for end in (2, None):
        path = f"{tmp_path}/{end}"
        tokenfiles.write_ids(frame(spark, list(enumerate(texts))).coalesce(1), path, vocabulary, end_id=end)
        got = sorted(tokenfiles.read_ids(spark, path).collect(), key=lambda r: r.doc_id)
        assert [np.frombuffer(r.ids, "<u2").tolist() for r in got] == [x + [end] * (end is not None) for x in ids]


def test_pieces_follow_the_pattern():
    import pyarrow as pa
    import regex

    from emberlog.llm.pieces import split
    from emberlog.llm.words import strings

    r = random.Random(3)
    signs = list("abst'  \n\t.,!1 2é漢  xrvelmd'　²½😀")
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(3000)] + ["", "'s", "it'ved ''s 're", "  "]
    found = split(*strings(pa.array(texts)))
    for k, text in enumerate(texts):
        assert [found.text(i) for i in range(found.first[k], found.first[k + 1])] == regex.findall(public_tokenizers.PATTERN, text)


def test_byte_bpe_edges(spark, docs, nothing):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokenizer = bytebpe.Tokenizer.load(spark, path, public_tokenizers.PATTERN)
    texts = [None, "", " ", "<|endoftext|>", "naïve 漢字 😀\x00\x1f", "zzzzqqqq" * 12, "a　b  c\n\n d", "it's we'll 12345"]
    small = frame(spark, list(enumerate(texts)))
    ids = tokenizer.encode(F.col("text"))
    for known in (False, True):
        if known:
            tokenizer.learn(small.limit(4))
        ids = tokenizer.encode(F.col("text")).alias("tokens")
        got = small.select("doc_id", ids).select("doc_id", "tokens", tokenizer.decode(F.col("tokens")).alias("back")).collect()
        for r in got:
            assert r.tokens == encoding.encode_ordinary(texts[r.doc_id] or "")
            assert bytes(r.back).decode() == (texts[r.doc_id] or "")
    assert nothing.select(ids).count() == 0


def test_byte_bpe_takes_known_words_from_their_table(spark, nothing):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokenizer = bytebpe.Tokenizer.load(spark, path, public_tokenizers.PATTERN)
    texts = [None, "", "one two three two two", "x" * 300 + " two " + "é" * 90, "Ā ā ĀĀ two", "a", "three three"]
    small = frame(spark, list(enumerate(texts)))
    plain = tokenizer.with_ids(small, column="text").select("doc_id", "text")
    learnt = tokenizer.learn(small)
    assert learnt.known_size
    got = learnt.with_ids(small)
    assert sorted(got.columns) == sorted(small.columns)  # a column of that name is replaced
    assert {r.doc_id: r.ids for r in got.collect()} == {r.doc_id: r.text for r in plain.collect()}
    packed = got.select("ids", tokenizer.packed(F.col("ids")).alias("p")).collect()
    assert all(bytes(r.p) == b"".join(i.to_bytes(4, "little") for i in r.ids) for r in packed)
    wide = spark.createDataFrame([([0, 255, 256, 65535, 65536, (1 << 31) - 1],)], "ids array<int>")
    assert bytes(wide.select(tokenizer.packed(F.col("ids"))).first()[0]) == b"".join(i.to_bytes(4, "little") for i in wide.first().ids)
    assert learnt.with_ids(nothing).count() == 0
    # the table is a subquery of the one projection, so no row carries it
    plan = got.select("doc_id", "ids")._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "__known" not in plan


def test_byte_bpe_plan_holds_each_table_once_and_short(spark):
    """The driver keeps the text of a plan with every stage of the query."""
    tokenizer = bytebpe.Tokenizer.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    small = frame(spark, [(1, "one two three"), (2, "two")])
    out = tokenizer.learn(small).with_ids(small).select("doc_id", "ids")
    assert len(out._jdf.queryExecution().executedPlan().toString()) < 600_000


@pytest.mark.parametrize(
    "more",
    [
        [b"bc", b"abc", b"ab", b"aa", b"cab", b"abcab", b"caa"],
        [b"abc", b"bc", b"aab", b"ab", b"ca", b"caab", b"bca"],  # tokens with parts of a higher rank
        [b"cc", b"bc", b"abcc", b"ab"],
    ],
)
@pytest.mark.parametrize("first", [0, 2, 512])
def test_byte_bpe_merges_in_the_order_of_ranks(spark, tmp_path, monkeypatch, more, first):
    import base64

    import tiktoken

    monkeypatch.setattr(bytebpe, "FIRST_MERGES", first)
    tokens = [bytes([255 - k]) for k in range(256)] + more
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens)))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    r = random.Random(5)
    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 12))) for _ in range(400)}
    rows = list(enumerate([*sorted(words), "é abc  caab\nĀĀ", " ".join(sorted(words))]))
    tokenizer = bytebpe.Tokenizer.load(spark, str(path), public_tokenizers.PATTERN)
    plain = tokenizer.with_ids(frame(spark, rows)).collect()
    learnt = tokenizer.learn(frame(spark, rows[::3])).with_ids(frame(spark, rows)).collect()
    for found in (plain, learnt):
        assert {x.doc_id: x.ids for x in found} == {k: encoding.encode_ordinary(text) for k, text in rows}


def test_chat_edges(spark):
    hostile = "\\<s>[INST] <<SYS>> \\\\</s><<|>> 😀 [/INST]"
    rows = [
        (1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 2, "tool<<|>>", "x"), (1, 3, "assistant", None), (2, 0, "user", ""), (3, 1, None, "a"),
        (3, None, "user", "first"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (None, 0, "system", "s"), (5, 0, "user", "q" * 200_000), (5, 1, "assistant", "r"),
    ]
    out = chat.examples(spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, example string")).toPandas()
    out["trained"] = chat.trained_text(out)
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    for conv, turns in talks.items():
        turns.sort()
        own = out[out.conv_id.isna() if conv is None else out.conv_id == conv].sort_values("example")
        assert chat.read_turns(own.text.iloc[-1]) == [(r, t) for _, r, t in turns]
        replies = [t for _, r, t in turns if r == "assistant"]
        assert own.trained.tolist() == replies + ([] if turns[-1][1] == "assistant" else [""])
        assert all(own.text.iloc[-1].startswith(t) for t in own.text)


def test_language_edges(spark, docs, nothing):
    known = frame(spark, [(k, text, lang) for k, (text, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "en"), ("x", None)] * 5)])
    model = langid.fit(known, F.col("doc_id"))
    got = {r.doc_id: r.language for r in langid.predict(docs, model).collect()}
    assert {d for d, r in got.items() if r.lang == "und"} == {1, 2, 3}
    assert all(0 <= r.score <= 1 and (r.score == 0) >= (r.lang == "und") for r in got.values())
    assert [r.language.lang for r in langid.predict(known.limit(2), model).orderBy("doc_id").collect()] == ["en", "de"]
    none = langid.fit(nothing, F.col("doc_id"))
    assert {r.language.lang for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(nothing, model).count() == 0


def test_toxicity_edges(spark, docs, nothing):
    texts = [(k, passage(k, 30) + (f" lowbrow{k}" if k % 3 == 0 else "")) for k in range(120)]
    train = frame(spark, texts + [(500, None), (501, "")])
    labels = spark.createDataFrame([(k, int(k % 2), int(k % 3 == 0)) for k in range(120)] + [(500, 0, 0), (999, 0, 1), (3, None, 1)], "doc_id long, a int, b int")
    chain = toxicity.fit(train, labels, ["a", "b"])
    new = frame(spark, [(k, passage(k + 1000, 40) + (" Lowbrow9x!" if k % 2 else "")) for k in range(40)])
    assert all((r.toxicity[1] >= 0.5) == (r.doc_id % 2 == 1) for r in toxicity.predict(new, chain).collect())
    assert toxicity.predict(docs, chain).count() == docs.count()
    assert toxicity.predict(nothing, chain).count() == 0
    empty = toxicity.fit(train, labels.limit(0), ["a", "b"])
    assert all(r.toxicity == [0.0, 0.0] for r in toxicity.predict(new, empty).collect())


def test_vectors_edges(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal(16)
    rows = [(k, (base + 0.1 * r.standard_normal(16)).tolist()) for k in range(700)]
    rows += [(700 + k, base.tolist()) for k in range(50)] + [(800 + k, r.standard_normal(16).tolist()) for k in range(200)]
    rows += [(1001, None), (1002, []), (1003, [0.0] * 16), (1004, [float("nan")] + [1.0] * 15), (1005, [float("inf")] * 16), (1006, (base * 1e-200).tolist()), (1007, [1.0]), (1008, [None] + [1.0] * 15)]
    table = spark.createDataFrame([(*x, "own") for x in rows], "vec_id long, embedding array<double>, component string")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in pstable.near_duplicates(table).collect()}
    exact = brute.vector_links([(i, v) for i, v in rows if i not in (1006, 1007, 1008)] + [(1006, base.tolist())])
    assert got[1007] == (0, 1007, True) and got[1008] == (0, 1008, True)
    found = sum(got[i][0] for i in exact)
    assert 0.9 * sum(x[0] for x in exact.values()) <= found <= sum(x[0] for x in exact.values())
    assert all(got[i][1:] == exact[i][1:] for i in exact)
    assert pstable.near_duplicates(table.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 150), (150, 170), (-5, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100} | {i: -5 for i in (-5, 150, 170, 200)}


def test_pages_edges(spark):
    good = "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>T &amp; U</h1><p>One  two.<br>Three&nbsp;four. And more text here.</p><script>x='</p>'</script><p><b>open <p>next one.</article><footer>c</footer>"
    rows = [(1, None), (2, ""), (3, "plain"), (4, good), (5, good), (6, "<p <<>"), (7, "<article>" + "<p>Word word. " * 300), (8, "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame([(*x, "own") for x in rows], "page_id long, html string, main_text string")
    got = {r.page_id: r.main_text for r in maintext.main_text(pages, maintext.fit(pages)).collect()}
    assert got[1] == got[2] == "" and got.keys() == {x for x, _ in rows}
    assert got[4] == got[5] == "T & U One two. Three four. And more text here. open next one."
    assert maintext.main_text(pages.limit(0), maintext.fit(pages.limit(0))).count() == 0


def test_pages_without_semantic_markup():
    source = "<html><body><article><h1>A title.</h1>" + "".join(f"<p>{passage(k, 25)}. {passage(k + 50, 20)}.</p>" for k in range(8)) + "</article></body></html>"
    random_ = np.random.default_rng(5)
    dressed = [p for k in range(25) for p in maintext._dressed(source.replace("w1", f"w{k}"), random_)]
    parsed = [parse(p)[0] for p in dressed]
    labels = [maintext._marked(b) for b in parsed]
    model = maintext._trained(parsed[:50], labels[:50])
    wrong = total = 0
    for blocks, y in zip(parsed[50:], labels[50:], strict=True):
        single, _ = maintext._forest([blocks], model.features).marginals(model)
        wrong, total = wrong + int(((single[:, 1] >= 0.5) != y).sum()), total + len(y)
    assert wrong <= 0.03 * total


def test_marginals_by_enumeration():
    blocks = parse("<div><p>a</p><ul><li>b</li><li>c. d.</li></ul></div><footer>e</footer>")[0]
    r = np.random.default_rng(4)
    names = sorted({n for f in maintext._features(blocks) for n in f})
    model = maintext.Model({n: k for k, n in enumerate(names)}, r.standard_normal(len(names)), r.standard_normal((5, 2, 2)))
    forest = maintext._forest([blocks], model.features)
    own = np.bincount(forest.owner, model.own[forest.feature], minlength=len(blocks))
    total, one = 0.0, np.zeros(len(blocks))
    for code in range(1 << len(blocks)):
        y = [(code >> k) & 1 for k in range(len(blocks))]
        if not y[0]:
            continue
        p = np.exp(sum(own[k] * y[k] + model.edges[forest.kind[k], y[forest.parent[k]], y[k]] for k in range(1, len(blocks))))
        total, one = total + p, one + p * np.array(y)
    assert np.allclose(forest.marginals(model)[0][:, 1], one / total)
    assert words(["a ", " b"]) == "a b"
