"""Vectorised splitting of texts into the pieces a byte-level BPE merges within.

The pattern is that of the public byte-level tokenizers: contractions, an optional
space before letters, before digits and before other signs, and white space of
which the last sign is left to the next piece. All rules look at neighbouring
signs only, so they become comparisons of shifted arrays.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex

from emberlog.llm.words import _Powers, mix

_SPACE, _LETTER, _DIGIT, _OTHER, _EDGE = range(5)
_END = 0x110000  # stands between texts
_powers = _Powers(0xA0761D6478BD642F)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Kind of every code point."""
    kinds = np.full(_END + 1, _OTHER, np.uint8)
    kinds[_END] = _EDGE
    for kind, pattern in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_DIGIT, r"\p{N}")):
        rule = regex.compile(pattern)
        for start in range(0, _END, 4096):
            part = "".join(chr(c) for c in range(start, start + 4096) if not 0xD800 <= c < 0xE000)
            kinds[[ord(m) for m in rule.findall(part)]] = kind
    return kinds


@dataclass
class Pieces:
    signs: np.ndarray  # code points, _END before every text
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # piece number at which each text begins; one more at the end

    def hashes(self) -> np.ndarray:
        up, down = _powers.upto(len(self.signs) + 1)
        sums = np.zeros(len(self.signs) + 1, np.uint64)
        codes = self.signs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x1234567)
        np.cumsum((codes ^ (codes >> np.uint64(29))) * up[:-1], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def text(self, k: int) -> str:
        return self.signs[self.starts[k] : self.ends[k]].astype("<u4").tobytes().decode("utf-32-le")


def split(raw: np.ndarray, at: np.ndarray) -> Pieces:
    """Pieces of the texts whose UTF-8 bytes are ``raw[at[k]:at[k+1]]``."""
    signs = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    upto = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=upto[1:])
    edges = upto[at[:-1]]
    signs = np.insert(signs, edges, _END)
    n = len(signs)
    kind = _kinds()[signs]
    begin = np.ones(n + 1, bool)
    begin[1:n] = kind[1:] != kind[:-1]
    blank = kind == _SPACE
    # the last of several blanks before a sign stands alone or joins the next piece
    last = np.zeros(n, bool)
    last[:-1] = blank[:-1] & ~blank[1:] & (kind[1:] != _EDGE)
    joins = last & (signs == 0x20)
    begin[:n][last] = True
    begin[1:][joins] = False
    _contractions(signs, kind, joins, begin)
    starts = np.flatnonzero(begin[:n] & (kind != _EDGE))
    nexts = np.flatnonzero(begin)
    ends = nexts[np.searchsorted(nexts, starts, side="right")]
    texts = np.append(np.flatnonzero(kind == _EDGE), n)
    return Pieces(signs, starts, ends, np.searchsorted(starts, texts))


def _contractions(signs: np.ndarray, kind: np.ndarray, joins: np.ndarray, begin: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll where the apostrophe begins a piece: the rest of the letters is another piece."""
    n = len(signs)
    at = np.flatnonzero((signs == 0x27) & begin[:n])
    at = at[(at + 1 < n)]
    at = at[kind[at + 1] == _LETTER]
    if not len(at):
        return
    one = signs[at + 1]
    two = signs[np.minimum(at + 2, n - 1)]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        double |= (one == ord(a)) & (two == ord(b))
    double &= at + 2 < n
    begin[at[single | double] + 1] = False
    begin[at[single] + 2] = True
    begin[at[double] + 3] = True
