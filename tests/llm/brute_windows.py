"""Plain one-machine version of the removal of repeated word windows, written from the contract alone."""

from __future__ import annotations

import re


def remove_windows(rows, size=13):
    """rows: (doc_id, text) -> [(n_words, n_removed, kept)] in the order of rows."""
    rank = lambda d: (d is not None, d or 0)
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (doc, _), w in zip(rows, texts, strict=True):
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            least[key] = min(least.get(key, rank(doc)), rank(doc))
    out = []
    for (doc, _), w in zip(rows, texts, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if least[tuple(w[i : i + size])] < rank(doc):
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out
