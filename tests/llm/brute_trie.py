"""Plain one-machine version of the conversation trie, written from the contract alone."""

from __future__ import annotations

import hashlib
import zlib


def rebuilt(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: [(role, text)]}; equal turn numbers by hash."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(conv, []).append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t for *_, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = turns.get(base, [])[:h] + turns[c][h:]
    return out


def trie(rows):
    """-> sorted (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)"""
    paths = rebuilt(rows)
    members, ends, children = {}, {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, own in members.items():
        worth = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += node not in children
    out = []
    for node, own in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children.get(node, ())), leaves[node], saved[node], sha))
    return sorted(out, key=repr)
