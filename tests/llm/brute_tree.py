"""Plain one-machine version of the Merkle manifest, written from the contract alone."""

from __future__ import annotations

import hashlib
import zlib


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout=16):
    """The root of a list of nodes, and for each node its path of (before, after)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, path in enumerate(paths):
            run = at[i] // fanout * fanout
            path.append(("".join(level[run : at[i]]), "".join(level[at[i] + 1 : run + fanout])))
            at[i] //= fanout
        level = [h(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def manifest(rows, fanout=16):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    key = lambda x: (x is not None, x if isinstance(x, int) else (x or "").encode())
    names = sorted(groups, key=key)
    if not names:
        return []
    trees = {}
    for name in names:
        own = sorted(((r, h(*map(field, r))) for r in groups[name]), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[name] = (own, *climb([x for _, x in own], fanout))
    root, tops = climb([trees[n][1] for n in names], fanout)
    out = []
    for name, top in zip(names, tops, strict=True):
        own, subroot, paths = trees[name]
        for (row, leaf), path in zip(own, paths, strict=True):
            path = path + top
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
                folded = h(*map(field, (*row[:4], low)))
            for before, after in path:
                folded = h(before, folded, after)
            proof = h("".join(b + a for b, a in path))
            out.append((row[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)
