"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a binary variable: part of the main text or not. Its
own potential comes from its tag, the words in its class, id and role, its text, links and
sentences; the potential of a parent and a child from the kind of child. The DOM is a tree,
so one sum-product pass up and one down give exact marginals, for all pages of a batch at
once, level by level. A block's text is kept if its marginal is at least one half.

The potentials are trained by maximum likelihood, with the same two passes, on at most
about ``FIT_PAGES`` labelled pages made from the pages table: pages whose article is marked
up as such, and for each of them copies in which the article and its surroundings are
dressed in other markup (``_dressed``), so that the model also knows pages without it.

Defined cases: null or empty html has no text; broken markup is read as far as it
goes; a table without any marked article is read with potentials trained on a fixed
small page; rows may repeat, further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.dom import Block, parse, words

FIT_PAGES = 150
COPIES = 3
STEPS = 240
_PENALTY = 1e-5
_CURVATURE = 4.0  # a dozen weights meet in a block, a quarter each, and blocks pull on their neighbours
_KINDS = {"p": 0, "pre": 0, "blockquote": 0, "li": 1, "ul": 1, "ol": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "div": 3, "section": 3, "article": 3, "main": 3}
_OTHER_KIND = 4
_BATCH_PAGES = 500

#: Names that pages give to parts around the main text, and to the main text.
_AROUND = {
    "nav": "menu nav navbar navigation breadcrumb breadcrumbs topnav",
    "header": "header masthead site-header top branding",
    "footer": "footer site-footer copyright bottom legal",
    "aside": "sidebar related widget aside recommended trending popular tags",
    "ad": "ad ads advert advertisement sponsored promo banner sponsor",
    "notice": "cookie cookies consent notice gdpr alert popup overlay message",
    "form": "newsletter subscribe signup search login contact form",
    "comments": "comments comment discussion replies respond reader-comments",
    "share": "share social toolbar meta byline pagination pager",
}
_MAIN = "content article post entry story main body text article-body post-content entry-content main-content"
_PAGE = "<html><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><article><h1>A title.</h1><p>One sentence stands here, and another one follows it.</p><p>More text.</p></article><footer>Notice.</footer></body></html>"


@dataclass
class Model:
    features: dict[str, int]
    own: np.ndarray  # weight of each feature for being main text
    edges: np.ndarray  # kind of child, label of parent, label of child


@dataclass
class Forest:
    """Blocks of many pages; ``levels`` lists their numbers by depth."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    owner: np.ndarray  # block of each feature occurrence
    feature: np.ndarray

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Probability of both labels of each block, and of both labels of it and its parent."""
        n = len(self.parent)
        score = np.bincount(self.owner, model.own[self.feature], minlength=n)
        root = self.parent < 0  # the page itself leads to the main text
        local = np.stack([np.where(root, -1e4, 0.0), np.where(root, 0.0, score)], axis=1)
        table = model.edges[self.kind]  # block, label of parent, label of block
        up = local.copy()  # what a block and all below it say, by its label
        sent = np.zeros((n, 2))
        for level in reversed(self.levels[1:]):
            sent[level] = _logsum(table[level] + up[level][:, None, :], 2)
            np.add.at(up, self.parent[level], sent[level])
        down = np.zeros((n, 2))
        pair = np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            above = up[self.parent[level]] + down[self.parent[level]] - sent[level]
            joint = above[:, :, None] + table[level]
            down[level] = _logsum(joint, 1)
            pair[level] = _normal(joint + up[level][:, None, :], (1, 2))
        return _normal(up + down, 1), pair


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _normal(x: np.ndarray, axis) -> np.ndarray:
    e = np.exp(x - x.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def main_text(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``pages`` and a string column ``main_text``, which replaces one of that name."""
    pages = pages.drop("main_text")
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few hundred weights
    schema = pages.withColumn("main_text", F.lit(None).cast("string")).schema
    return pages.mapInArrow(partial(_extracted, pages.columns.index(html_col), shared), schema)


def fit(pages: DataFrame, html_col: str = "html") -> Model:
    marked = pages.filter(F.col(html_col).rlike("(?i)<article[\\s>]"))
    n = marked.count()
    share = int(min(1.0, FIT_PAGES / max(n, 1)) * (1 << 30))
    drawn = marked.filter(F.pmod(F.xxhash64(html_col), F.lit(1 << 30)) < share).select(html_col)
    sources = sorted(r[0] for r in drawn.limit(4 * FIT_PAGES).collect()) or [_PAGE]  # equal pages share a hash
    random = np.random.default_rng(5)
    labelled = [(*parse(s)[:1], None) for s in sources]
    for s in sources:
        labelled += [(parse(page)[0], True) for page in _dressed(s, random)]
    return _trained([blocks for blocks, _ in labelled], [_marked(b) if own else _in_article(b) for b, own in labelled])


def _in_article(blocks: list[Block]) -> np.ndarray:
    """Labels from markup: the article and what is in it; what is above it leads there."""
    y = np.zeros(len(blocks), int)
    for k, b in enumerate(blocks):
        y[k] = b.tag == "article" or (k > 0 and y[b.parent] and b.tag not in ("nav", "aside", "footer", "form", "header"))
    return _with_ancestors(blocks, y)


def _marked(blocks: list[Block]) -> np.ndarray:
    y = np.zeros(len(blocks), int)
    for k, b in enumerate(blocks):
        y[k] = b.marked
    return _with_ancestors(blocks, y)


def _with_ancestors(blocks: list[Block], y: np.ndarray) -> np.ndarray:
    for k in range(len(blocks) - 1, 0, -1):
        y[blocks[k].parent] |= y[k]
    return y


def _dressed(page: str, random: np.random.Generator) -> Iterator[str]:
    """Copies of a page in other markup; ``data-main`` marks blocks of the main text."""
    blocks, runs = parse(page)
    inside = _in_article(blocks)
    main = [(blocks[b].tag, words(t)) for b, t in runs if inside[b] and b and words(t)]
    rest = [words(t) for b, t in runs if not inside[b] and words(t)]
    sentences = [s for _, t in main for s in t.split(". ")] + rest
    pick = lambda options: str(random.choice(options.split()))
    some = lambda: _escaped(str(random.choice(sentences)))[:300] if sentences else "Text."

    def around(kind: str) -> str:
        name = pick(_AROUND[kind])
        where = f'{random.choice(["class", "id"])}="{name}"'
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        tag = tag if random.random() < 0.5 else "div"
        items = "".join(f'<li><a href="/x">{some()[:30]}</a></li>' for _ in range(random.integers(2, 7)))
        inner = {
            "nav": f"<ul>{items}</ul>", "header": f'<a href="/">{some()[:20]}</a>', "footer": f"&copy; {some()[:60]}",
            "aside": f"<h3>{some()[:30]}</h3><ul>{items}</ul>" if random.random() < 0.6 else f"<p>{some()}</p>",
            "form": f'<label>{some()[:40]}</label><input name="q"><button>{some()[:12]}</button>',
            "comments": "".join(f'<div class="comment"><p>{some()}</p></div>' for _ in range(random.integers(1, 5))),
        }.get(kind, f"<p>{some()}</p>" if random.random() < 0.5 else some())
        bare = tag != "div" and random.random() < 0.3
        return f"<{tag}>{inner}</{tag}>" if bare else f"<{tag} {where}>{inner}</{tag}>"

    kinds = list(_AROUND)
    for _ in range(COPIES):
        parts = []
        shown = main[: random.integers(2, 6)] if random.random() < 0.35 else main
        brief = random.random() < 0.25
        for k, (tag, text) in enumerate(shown):
            text = ". ".join(text.split(". ")[: random.integers(1, 3)])[:200] if brief else text
            inner = _escaped(text)
            if random.random() < 0.2:
                head, _, tail = inner.partition(" ")
                inner = f'{head} <a href="/y">{tail[:20]}</a>{tail[20:]}'
            if tag[:1] == "h" and tag[1:].isdigit():
                tag = str(random.choice(["h1", "h2", "h1"]))
            elif k and random.random() < 0.1:
                parts.append(f"<{(sub := str(random.choice(['h2', 'h3'])))} data-main=1>{inner[:40]}</{sub}>")
            if tag[:1] != "h" and random.random() < 0.12:
                items = "".join(f"<li data-main=1>{x}</li>" for x in inner.split(". ") if x.strip())
                parts.append(f"<ul data-main=1>{items}</ul>" if items else "")
            else:
                tag = tag if tag[:1] == "h" else str(random.choice(["p", "p", "p", "blockquote", "div"]))
                parts.append(f"<{tag} data-main=1>{inner}</{tag}>")
            if random.random() < 0.08:
                parts.append(around(str(random.choice(["ad", "share", "aside"]))))
        if random.random() < 0.4:
            parts.append(around("comments"))
        holder = str(random.choice(["article", "div", "main", "section"]))
        name = "" if random.random() < 0.2 else f' class="{pick(_MAIN)}"'
        before = "".join(around(k) for k in kinds if k not in ("footer", "comments") and random.random() < 0.45)
        after = "".join(around(k) for k in kinds if k not in ("nav", "header") and random.random() < 0.45)
        body = f"<{holder}{name} data-main=1>{''.join(parts)}</{holder}>"
        if random.random() < 0.4:
            body = f'<div class="{pick("container wrapper page row layout")}">{body}{around("aside") if random.random() < 0.5 else ""}</div>'
        yield f"<html><head><title>x</title></head><body>{before}{body}{after}</body></html>"


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def _named(block: Block, own: int, below: int, sentences: int) -> list[str]:
    """Features of a block."""
    share = block.linked / own if own else 0
    size = min(6, int(np.log2(own + 1) / 1.5))
    return [
        "any", f"tag {block.tag}", *[f"name {x}" for x in set(block.names)], f"own {size}", f"below {min(8, int(np.log2(below + 1) / 1.5))}",
        f"linked {int(min(share, 1) * 4) if own else 'no text'}", f"sentences {min(3, sentences)}", f"links {min(3, block.links)}", f"tag {block.tag} own {size}",
    ]


def _features(blocks: list[Block]) -> list[list[str]]:
    texts = [" ".join(words(p) for p in b.pieces) for b in blocks]
    own = [len(t.strip()) for t in texts]
    below = own.copy()
    for k in range(len(blocks) - 1, 0, -1):
        below[blocks[k].parent] += below[k]
    return [_named(b, o, s, t.count(". ") + t.endswith(".")) for b, t, o, s in zip(blocks, texts, own, below, strict=True)]


def _forest(pages: list[list[Block]], features: dict[str, int]) -> Forest:
    parent, kind, depth, owner, feature = [], [], [], [], []
    base = 0
    for blocks in pages:
        for k, (b, names) in enumerate(zip(blocks, _features(blocks), strict=True)):
            parent.append(base + b.parent if k else -1)
            kind.append(_KINDS.get(b.tag, _OTHER_KIND))
            depth.append(b.depth)
            for name in names:
                if name in features:
                    owner.append(base + k)
                    feature.append(features[name])
        base += len(blocks)
    depth = np.array(depth, int)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))
    return Forest(np.array(parent, int), np.array(kind, int), levels, np.array(owner, int), np.array(feature, int))


def _trained(pages: list[list[Block]], labels: list[np.ndarray]) -> Model:
    found: dict[str, int] = {}
    for blocks in pages:
        for name in chain.from_iterable(_features(blocks)):
            found[name] = found.get(name, 0) + 1
    features = {name: k for k, name in enumerate(sorted(n for n, c in found.items() if c >= 3))}
    forest, y = _forest(pages, features), np.concatenate(labels)
    model = Model(features, np.zeros(len(features)), np.zeros((_OTHER_KIND + 1, 2, 2)))
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.bincount(forest.feature, y[forest.owner], minlength=len(features))
    met = np.zeros_like(model.edges)
    np.add.at(met, (forest.kind[inner], y[forest.parent[inner]], y[inner]), 1)
    n, often = len(y), np.bincount(forest.feature, minlength=len(features))
    pairs = np.bincount(forest.kind[inner], minlength=len(model.edges))[:, None, None] * np.ones((1, 2, 2))
    # accelerated gradient steps; a weight's rate follows how often it is used
    rates = [1 / (_CURVATURE * c / n + _PENALTY) for c in (often, pairs)]
    now, t = [model.own, model.edges], 1.0
    for _ in range(STEPS):
        single, pair = forest.marginals(model)
        expected = np.bincount(forest.feature, single[forest.owner, 1], minlength=len(features))
        together = np.zeros_like(met)
        np.add.at(together, forest.kind[inner], pair[inner])
        slopes = [(seen - expected) / n - _PENALTY * model.own, (met - together) / n - _PENALTY * model.edges]
        new = [w + r * g for w, r, g in zip((model.own, model.edges), rates, slopes, strict=True)]
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        model.own, model.edges = (w + (before - 1) / t * (w - v) for w, v in zip(new, now, strict=True))
        now = new
    model.own, model.edges = now
    return model


def _extracted(place: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    for batch in batches:
        texts: list[str] = []
        for start in range(0, batch.num_rows, _BATCH_PAGES):
            parsed = [parse(p or "") for p in batch.column(place).slice(start, _BATCH_PAGES).to_pylist()]
            single, _ = _forest([b for b, _ in parsed], model.features).marginals(model)
            base = 0
            for blocks, runs in parsed:
                kept = single[base : base + len(blocks), 1] >= 0.5
                texts.append(" ".join(w for b, t in runs if kept[b] and (w := words(t))))
                base += len(blocks)
        yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "main_text"])
