"""Plain versions of the corpus operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return text.translate({k: k + 32 for k in range(65, 91)})


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width=5):
    w = [lower(x) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def jaccard(docs):
    """doc_id -> (set size, component)."""
    sets = {d: shingles(t) for d, t in docs}
    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    common = {}
    for own in by.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    root = roots(sets, links)
    return {d: (len(s), root[d]) for d, s in sets.items()}


def line_dedup(docs):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    where = {}
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                where.setdefault(key(x), set()).add(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < 2 or min(where[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def repeats(docs, width=100):
    """doc_id -> (bytes, removed, runs, sha of the rest)."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            w = raw[i : i + width]
            if w in seen:
                gone[i : i + width] = b"\1" * width
            else:
                seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def edited(docs):
    docs = sorted((d, t or "") for d, t in docs)
    out = {}
    for k, (d, t) in enumerate(docs):
        n = docs[(k + 1) % len(docs)][1]
        q = len(t) // 4
        out[d] = t[: len(t) - q] + n[:q]
    return out


RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def spelling(docs, times=2, factor=10, shortest=7):
    """(word, form, root, n, n_near, form_n) of all words, near words found through words with one code point left out."""
    count = {}
    for d, t in docs:
        for run in RUN.findall(t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] = count.get(run, 0) + 1
    n = {w: c for w, c in count.items() if len(w) >= shortest and c >= times}
    holes, near = {}, {w: set() for w in n}
    for w in n:
        for k in range(len(w)):
            holes.setdefault((w[:k], w[k + 1 :]), []).append(w)
            less = w[:k] + w[k + 1 :]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] is not None else None) for w in sorted(n)]


BASE_PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_base(text):
    """(n_words, [(start, label), ...]) of the fixed phrases."""
    w = LICENSE_WORD.findall(lower(text or ""))
    found = [(k, label) for k in range(len(w)) for phrase, label in BASE_PHRASES.items() if tuple(w[k : k + len(phrase)]) == phrase]
    return len(w), found


def detections(text, rules):
    """(start, end, tier, rule, label) of all rules, each on every text, less those that a stronger or longer one contains."""
    words = "".join(f"{w} " for w in LICENSE_WORD.findall(lower(text or "")))
    found = []
    for k, r in enumerate(rules):
        for m in re.finditer(rf"(?<![^ ])(?:{r.pattern}) ", words):
            found.append((words.count(" ", 0, m.start()), words.count(" ", 0, m.end()), r.tier, k, r.label))

    def before(g, h):
        return (g[0], -g[1], g[2], g[3]) < (h[0], -h[1], h[2], h[3])

    return sorted((h for h in found if not any(before(g, h) and g[2] <= h[2] and g[1] >= h[1] for g in found)), key=lambda h: (h[0], -h[1], h[2], h[3]))


def vector_codes(rows, parts=16, entries=64, rounds=2):
    """vec_id -> (code, error, label), and the codebooks, of (id, vector, label) rows without odd vectors."""
    kept = sorted(((i, [int(np.floor(256.0 * float(x))) for x in v], label) for i, v, label in rows), key=lambda r: (r[0], r[1]))
    x = np.array([r[1] for r in kept], np.int64)
    w = x.shape[1] // parts
    code, error, books = np.zeros((len(x), parts), int), np.zeros(len(x), int), []
    for p in range(parts):
        y = x[:, p * w : (p + 1) * w]
        book = y[:entries].copy()
        for k in range(rounds + 1):
            near = ((y[:, None, :] - book[None]) ** 2).sum(2).argmin(1)
            if k < rounds:
                for e in range(len(book)):
                    if (near == e).any():
                        book[e] = y[near == e].sum(0) // (near == e).sum()
        code[:, p], error = near, error + ((y - book[near]) ** 2).sum(1)
        books.append(book)
    return [(r[0], bytes(c.tolist()), int(e), r[2]) for r, c, e in zip(kept, code, error, strict=True)], books
