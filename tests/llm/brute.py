"""Plain restatements of what the operators of emberlog.llm return, for small inputs."""

import hashlib
import re
import zlib


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def substring_dedup(docs, width=13, texts=False):
    """Digests, or the texts as the pipeline keeps them."""
    least = {}
    for doc, text in docs:
        w = spaced(text)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            least[key] = min(least.get(key, doc), doc)
    out = {}
    for doc, text in docs:
        w = spaced(text)
        gone = set()
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc] = (kept if gone else text) if texts else (len(w), len(gone), sha(kept))
    return out


def contamination(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = alnum(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = sorted({len(k) for k in windows})
    out = {}
    for doc, text in docs:
        w = alnum(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = sorted(map(str, found))
        out[doc] = (len(w), len(hit), len(names), sha(",".join(names)), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def token_files(docs, tokenizer, end_id=2):
    start, out = 0, {}
    for doc, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out[doc] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def jaccard_classes(docs, width=3, percent=90):
    """n_shingles and smallest id reachable, by comparing all pairs."""
    sets = {}
    for doc, text in docs:
        w = spaced(lower(text or ""))
        sets[doc] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    return {d: (len(sets[d]), c) for d, c in classes(sets, lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)).items()}


def classes(things, linked):
    parent = {d: d for d in things}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(things)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(things[a], things[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: top(d) for d in ids}


def chat(rows):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        trained = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(trained), sha(trained))
    return out


def byte_bpe(docs, encoding):
    out = {}
    for doc, text in docs:
        ids = encoding.encode_ordinary(text or "")
        out[doc] = (len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha((text or "").encode()))
    return out


def vector_links(rows, cosine=0.9):
    import numpy as np

    out, good, ids = {}, [], []
    for i, v in rows:
        v = np.array(v if v is not None else [], float)
        if len(v) and np.isfinite(v).all() and v.any():
            ids.append(i)
            good.append(v / np.linalg.norm(v))
        else:
            out[i] = (0, i, True)
    links = np.stack(good) @ np.stack(good).T >= cosine if good else np.zeros((0, 0), bool)
    near = {i: {ids[j] for j in np.flatnonzero(links[k])} - {i} for k, i in enumerate(ids)}
    part = classes(near, lambda a, b: False)
    for i in sorted(near):  # smallest id reachable
        if part[i] == i:
            todo = [i]
            while todo:
                x = todo.pop()
                for y in near[x]:
                    if part[y] > part[i]:
                        part[y] = part[i]
                        todo.append(y)
    return out | {i: (len(near[i]), part[i], part[i] == i) for i in ids}


def article_text(page):
    """Main text of the generated pages, whose article is marked up and holds nothing else."""
    import html

    inside = re.search(r"<article>(.*?)(</article>|$)", page or "", re.DOTALL)
    if not inside:
        return ""
    text = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|br|h1)>", " ", inside[1]))
    return " ".join(html.unescape(text).split())


def planted(doc, text):
    """The words of a document as the query on runs takes them."""
    w, h = spaced(text), zlib.crc32(str(doc).encode())
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def runs(w, least=12):
    """start, length, period of all runs, by start and period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start >= q and i - start + q >= least:
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def without_runs(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_variants(counts):
    """form, root, n, n_near, form_n by word; every word compared with every other."""
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    best = {w: min(xs, key=lambda x: (-counts[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in best.items() if counts[x] >= 5 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def damaged_words(docs):
    counts = {}
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 5}


def text_figures(text):
    w, lines = spaced(text), [x for x in (text or "").split("\n") if spaced(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    again = {i + k for i, g in enumerate(windows) if windows.count(g) > 1 for k in range(5)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)
