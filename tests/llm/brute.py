"""Plain one-machine versions of the operators' contracts, written from the contracts alone."""

from __future__ import annotations

import hashlib
import re

UPPER = {c: c + 32 for c in range(65, 91)}


def ascii_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def decontaminate(docs, items):
    """docs, items: lists of (id, text) -> {id: (n_words, n_hit, n_items, sha, contaminated)}."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = ascii_words(text)
        if not w:
            continue
        for i in range(max(1, len(w) - 9)):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = {}
    for doc, text in docs:
        w = ascii_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def base_licenses(text):
    """(n_words, n_base, first_word, last_word, base_labels)"""
    w, starts, labels = ascii_words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url_rule(url):
    """(host, path, rule, verdict of the rule)"""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate(UPPER), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def simhash(text, n=3):
    import xxhash

    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(UPPER).encode())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    """{node: smallest node reachable} for pairs on which linked(a, b) holds."""
    nodes = sorted(nodes)
    parent = {x: x for x in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                ra, rb = sorted((top(a), top(b)))
                parent[rb] = ra
    return {x: top(x) for x in nodes}


def near_copies(docs):
    """[(fingerprint, component)] row by row; a component is named by its least id, None if no row has one."""
    fps = [simhash(t) for _, t in docs]
    cls = classes(set(fps), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (d, _), f in zip(docs, fps, strict=True):
        if d is not None:
            least[cls[f]] = min(d, least.get(cls[f], d))
    return [(f"{f:016x}", least.get(cls[f])) for f in fps]


def remove_repeats(docs, length=100):
    """[(n_bytes, n_removed, n_spans, bytes left)] row by row; a null id is smaller than all others."""
    texts = [(-(1 << 63) if d is None else d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, t in texts:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            first[s] = min((d, i), first.get(s, (d, i)))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if (d, i) > first[t[i : i + length]]:
                gone[i : i + length] = b"\1" * length
        left = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, left))
    return out


def pieces(docs, size=2048):
    """Counter of (id, piece, start, length, crc) by the tokenizer library itself."""
    import zlib
    from collections import Counter

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for d, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        cut = [0]
        if len(ids) > size and len(ids) % size:
            cut.append(len(ids) % size)
        while cut[-1] < len(ids):
            cut.append(min(len(ids), cut[-1] + size))
        for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            out[d, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return out


def vector_links(rows, cosine=0.9):
    """[(n_links, component)] row by row for (id, vector)."""
    import numpy as np

    units = []
    for d, v in rows:
        a = np.array([np.nan if x is None else x for x in v] if v else [np.nan], float)
        fine = d is not None and np.isfinite(a).all() and (a != 0).any()
        if fine:
            a = a / np.abs(a).max()
            a = a / np.sqrt((a * a).sum())
        units.append(a if fine else None)

    def linked(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and len(a) == len(b) and float(a @ b) >= cosine

    n = range(len(rows))
    cls = classes(n, linked)
    least = {}
    for i in n:
        d = rows[i][0]
        if d is not None:
            least[cls[i]] = min(d, least.get(cls[i], d))
    return [(sum(j != i and linked(i, j) for j in n), least.get(cls[i])) for i in n]
