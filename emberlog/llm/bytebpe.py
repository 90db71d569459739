"""Byte-level BPE in Spark's higher-order functions.

A piece (a match of the tokenizer's pattern) is a string with one character for each of its
tokens: at first its bytes, as U+0000 to U+00FF. A merge puts the character of the joined token
in the place of two. Joined tokens have characters in the order of their ranks, so the character
of a pair is its rank as well. The last merge of a token is that of the two tokens which its own
bytes come to before it, in every text (what happens inside a token does not depend on what is
around it), so the literal rank map has one pair a token. Spark searches a map from end to end and
keeps an object for each key and value; the literal is therefore an array of short strings, addressed by
a hash of the pair, in which the joined token's character follows the pair.

Two folds follow each other. The first goes over the ``FIRST_MERGES`` merges of the lowest ranks,
a literal list, and replaces each in all unknown pieces of a text at once. That is the order of
the ranks as long as no merge makes a pair of a lower rank than its own; ``load`` looks for such
tokens and ends the list before them. The second fold goes over one piece and merges, again and
again, the leftmost pair of the lowest rank, until no pair has one. It keeps the ranks of all
pairs as a string too; a character that no token has stands at both ends, so that ends are no
special case.

Frequent words are folded once and come with their finished tokens from an array of small maps, a
scalar subquery: at most ``KNOWN_WORDS`` words of at most ``KNOWN_LENGTH`` characters, the most
frequent of a sample of about ``SAMPLE_DOCS`` documents, so its size has a bound. It only
saves work: every other piece is folded where it stands, with the same ids.

Decoding looks up the bytes of each id and concatenates them.

Defined cases: null text is empty and has no ids; special tokens in a text are
ordinary text; tables may be empty, rows may repeat, further columns pass
through. A vocabulary without one of the 256 bytes is refused. The second fold takes time with
the square of the length of one piece, so a single run of letters of a hundred thousand
characters takes minutes.
"""

from __future__ import annotations

import base64
import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.expressions import let
from emberlog.sources.scratch import staged

KNOWN_WORDS = 1 << 17
KNOWN_LENGTH = 64
SAMPLE_DOCS = 20_000
KNOWN_KEYS = 8  # a map by itself takes more room than a key
FIRST_MERGES = 128
_EDGE = "\u0100"  # above every byte and below every joined token
_ABSENT = "\U0010ffff"  # above every token
_SURROGATES = 0xD800, 0xE000


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by id."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[k] for k in range(len(ranks))]


def last_merges(tokens: list[bytes]) -> dict[int, tuple[int, int]]:
    """The two tokens each token is joined from; a token that merges do not reach has none."""
    ranks = {token: k for k, token in enumerate(tokens)}
    out = {}
    for k, token in enumerate(tokens):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [ranks.get(a + b, len(tokens)) for a, b in zip(parts, parts[1:], strict=False)]
            low = min(found)
            if low == len(tokens):
                break
            i = found.index(low)
            parts[i : i + 2] = [tokens[low]]
        if len(parts) == 2:
            out[k] = ranks[parts[0]], ranks[parts[1]]
    return out


def in_order(tokens: list[bytes], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Tokens to join one after the other: up to the first that has a part of a higher rank than its own."""
    late = [max(j for j in pair if len(tokens[j]) > 1) for k, pair in merges.items() if any(j > k and len(tokens[j]) > 1 for j in pair)]
    return [k for k in sorted(merges) if k < min(late, default=len(tokens))]


@dataclass
class Tokenizer:
    """The literal tables of a vocabulary's merges, and the table of frequent words."""

    tokens: list[bytes]
    pattern: str
    ranks: Column
    ranks_size: int
    first: Column
    known: Column | None = None
    known_size: int = 0

    @classmethod
    def load(cls, spark: SparkSession, path: str, pattern: str) -> Tokenizer:
        tokens = read_ranks(path)
        if len({t for t in tokens if len(t) == 1}) < 256:
            raise ValueError(f"{path} lacks some bytes")
        merges = last_merges(tokens)
        pair = lambda k: "".join(_sign(j, tokens[j]) for j in merges[k])
        size = _places(len(merges), 2)
        rows = [_ABSENT] * size
        for k in merges:
            rows[zlib.crc32(pair(k).encode()) & (size - 1)] += _EDGE + pair(k) + _sign(k, tokens[k])
        first = [{"pair": pair(k), "one": _sign(k, tokens[k])} for k in in_order(tokens, merges)[:FIRST_MERGES]]
        return cls(tokens, f"(?U){pattern}", _constant(rows, "array<string>"), size, _constant(first, "array<struct<pair:string,one:string>>"))

    def learn(self, docs: DataFrame, text_col: str = "text") -> Tokenizer:
        """Add the finished ids of frequent words."""
        some = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
        sample = docs.filter(F.pmod(F.xxhash64(text_col), F.lit(1 << 20)) < int(some * (1 << 20)))
        words = sample.select(F.explode(self.pieces(F.col(text_col))).alias("word")).filter(F.char_length("word") <= KNOWN_LENGTH)
        counted = staged(words.groupBy("word").count(), "word-counts")
        # from the highest count down, as many whole counts as there is room for
        room, least = KNOWN_WORDS, None
        for row in sorted(counted.groupBy("count").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["count"]):
            room -= row["n"]
            if room < 0:
                break
            least = row["count"]
        if least is None:
            return self
        known = counted.filter(F.col("count") >= least).repartition(counted.sparkSession.sparkContext.defaultParallelism, "word")
        folded = let(self._tables(None), lambda t: self._folded(_bytes(F.col("word")), t))
        self.known_size = _places(KNOWN_WORDS, KNOWN_KEYS)
        self.known = _map_table(staged(known.select(F.col("word").alias("key"), folded.alias("value")), "known-words"), self.known_size)
        return self

    def pieces(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def encode(self, text: Column, known: Column | None = None) -> Column:
        """Array of ids. The tables stand in the expression once; its parts take them from a lambda variable."""
        return self._ids(let(self._tables(known), lambda t: self._coded(text, t, known is not None)))

    def with_ids(self, docs: DataFrame, text_col: str = "text", column: str = "ids") -> DataFrame:
        """``docs`` and the ids of ``text_col``.

        A subquery may not be written inside a higher-order function, so the table is a column first; it is
        used once, and the optimizer puts the subquery in its place: no row ever holds the table.
        """
        if self.known is None:
            return docs.withColumn(column, self.encode(F.col(text_col)))
        kept = [c for c in docs.columns if c != column]
        tabled = docs.select("*", self.known.alias("__known"))
        return tabled.select(*kept, self.encode(F.col(text_col), F.col("__known")).alias(column))

    def decode(self, ids: Column) -> Column:
        """Bytes of the ids, as binary."""
        return F.unhex(self._mapped(ids, [t.hex() for t in self.tokens]))

    def packed(self, ids: Column) -> Column:
        """The ids as little-endian unsigned 32-bit integers, as binary."""
        digits = F.array_join(F.transform(ids, lambda i: F.hex(i.cast("long") + (1 << 32))), "")  # nine of each id, the first a 1
        return F.unhex(F.regexp_replace(digits, "1(..)(..)(..)(..)", "$4$3$2$1"))

    def _mapped(self, ids: Column, table: list[str]) -> Column:
        column = F.split(F.lit(" ".join(table)), " ")  # a constant, folded by the optimizer
        return F.array_join(F.transform(ids, lambda i: F.element_at(column, i + 1)), "")

    def _tables(self, known: Column | None) -> Column:
        kind = F.lit(None).cast("array<map<string,string>>")
        return F.struct(self.ranks.alias("ranks"), self.first.alias("first"), (kind if known is None else known).alias("known"))

    def _coded(self, text: Column, tables: Column, look: bool) -> Column:
        """``text`` with a character for each token; pieces that are not known stand between edges until they are folded."""
        unknown = lambda word: F.concat(F.lit(_EDGE), _bytes(word), F.lit(_EDGE))
        coded = lambda word: F.coalesce(_looked_up(tables["known"], self.known_size, word), unknown(word)) if look else unknown(word)
        parts = F.split(F.array_join(F.transform(self.pieces(text), coded), ""), _EDGE)
        return let(parts, lambda parts: self._filled(parts, tables))

    def _filled(self, parts: Column, tables: Column) -> Column:
        """``parts`` joined; every second one is a piece to fold."""
        pieces = F.array_join(F.filter(parts, lambda _, i: i.bitwiseAND(1) == 1), _EDGE)
        folded = lambda done: F.transform(parts, lambda part, i: F.when(i.bitwiseAND(1) == 0, part).otherwise(F.element_at(done, F.shiftright(i + 1, 1))))
        filled = let(F.transform(F.split(self._merged_first(pieces, tables), _EDGE), lambda piece: self._merged(piece, tables["ranks"])), folded)
        return F.array_join(F.when(F.size(parts) > 1, filled).otherwise(parts), "")

    def _ids(self, coded: Column) -> Column:
        of_byte = [0] * 256
        for k, token in enumerate(self.tokens):
            if len(token) == 1:
                of_byte[token[0]] = k
        below, above = _SURROGATES

        def number(sign: Column) -> Column:
            joined = F.ascii(sign) - (ord(_EDGE) + 1)
            if ord(_EDGE) + len(self.tokens) >= below:
                joined = F.when(sign >= chr(above), joined - (above - below)).otherwise(joined)
            return F.when(sign < _EDGE, F.element_at(F.lit(of_byte), F.ascii(sign) + 1)).otherwise(joined)

        return let(coded, lambda signs: F.when(signs == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(signs, ""), number)))

    def _rank(self, pair: Column, ranks: Column) -> Column:
        """What follows the pair in its row; a row begins with the sign of a pair that is not there."""
        row = F.element_at(ranks, F.crc32(pair.cast("binary")).bitwiseAND(self.ranks_size - 1).cast("int") + 1)
        return F.left(F.call_function("substring_index", row, F.concat(F.lit(_EDGE), pair), F.lit(-1)), F.lit(1))

    def _folded(self, piece: Column, tables: Column) -> Column:
        return self._merged(self._merged_first(piece, tables), tables["ranks"])

    def _merged_first(self, pieces: Column, tables: Column) -> Column:
        """``pieces`` after the merges of the lowest ranks."""
        return F.aggregate(tables["first"], pieces, lambda pieces, merge: F.replace(pieces, merge["pair"], merge["one"]))

    def _merged(self, piece: Column, ranks: Column) -> Column:
        """``piece`` after all merges. Sign k of ``ranks`` is that of the pair at k of ``signs``."""
        return F.when(F.char_length(piece) < 2, piece).otherwise(let(F.concat(F.lit(_EDGE), piece, F.lit(_EDGE)), lambda signs: self._all_merged(signs, ranks)))

    def _all_merged(self, signs: Column, ranks: Column) -> Column:
        n = F.char_length(signs)
        rank = lambda x: self._rank(x, ranks)
        between = F.transform(F.sequence(F.lit(2), n - 2), lambda k: rank(F.substr(signs, k, F.lit(2))))
        start = F.struct(signs.alias("signs"), F.concat(F.lit(_ABSENT), F.array_join(between, ""), F.lit(_ABSENT)).alias("ranks"))
        return F.aggregate(F.sequence(F.lit(1), n - 3), start, lambda s, _: self._step(s, rank), lambda s: F.substr(s["signs"], F.lit(2), F.char_length(s["signs"]) - 2))

    def _step(self, state: Column, rank) -> Column:
        """``state`` after merging its leftmost pair of the lowest rank."""
        merged = lambda low: let(F.instr(state["ranks"], low), lambda i: self._joined(state, low, i, rank))
        return let(F.array_min(F.split(state["ranks"], "")), lambda low: F.when(low == _ABSENT, state).otherwise(merged(low)))

    def _joined(self, state: Column, low: Column, i: Column, rank) -> Column:
        """The pair at i becomes ``low``, so the pairs beside it change; neither is ever the first or last place."""
        signs, ranks, one = state["signs"], state["ranks"], F.lit(1)
        before, behind = rank(F.concat(F.substr(signs, i - 1, one), low)), rank(F.concat(low, F.substr(signs, i + 2, one)))
        return F.struct(
            F.concat(F.left(signs, i - 1), low, F.substr(signs, i + 2)).alias("signs"),
            F.concat(F.left(ranks, i - 2), before, behind, F.substr(ranks, i + 2)).alias("ranks"),
        )


def _sign(k: int, token: bytes) -> str:
    """The character of token k."""
    code = ord(_EDGE) + 1 + k
    return token.decode("latin-1") if len(token) == 1 else chr(code if code < _SURROGATES[0] else code + _SURROGATES[1] - _SURROGATES[0])


def _constant(value: list, kind: str) -> Column:
    """Folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def _bytes(text: Column) -> Column:
    """``text`` with a character for each byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _map_table(rows: DataFrame, size: int) -> Column:
    """The same array of maps as a scalar subquery; the caller bounds ``rows``."""
    placed = rows.groupBy(_place(F.col("key"), size).alias("place")).agg(F.collect_list(F.struct("key", "value")).alias("entries"))
    every = rows.sparkSession.range(0, size, 1, 1).select(F.col("id").cast("int").alias("place")).join(placed, "place", "left")
    entries = F.sort_array(F.collect_list(F.struct("place", "entries")))
    empty = F.expr("map()").cast(f"map<string,{rows.schema['value'].dataType.simpleString()}>")
    maps = F.transform(entries, lambda e: F.coalesce(F.map_from_entries(e["entries"]), empty))
    return every.agg(maps.alias("maps")).scalar()


def _places(most: int, keys: int) -> int:
    """A power of two, for about so many keys a place."""
    return 1 << max(4, (most - 1).bit_length() - keys.bit_length() + 1)


def _place(key: Column, size: int) -> Column:
    return F.hash(key).bitwiseAND(size - 1)


def _looked_up(maps: Column, size: int, key: Column) -> Column:
    return F.element_at(F.element_at(maps, _place(key, size) + 1), key)
