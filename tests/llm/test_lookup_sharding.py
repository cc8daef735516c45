"""Lookup-table sharding: the table against a plain filling, balance, small moves, placement."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from estatelake.llm import lookup_sharding as S
from tests.llm.conftest import clashing


def plain_table(shards, size):
    orders = []
    for s in shards:
        h = hashlib.md5(s.encode()).digest()
        offset, skip = int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1
        orders.append(iter([(offset + j * skip) % size for j in range(size)]))
    table = {}
    while len(table) < size:
        for i, order in enumerate(orders):
            if len(table) == size:
                break
            table[next(x for x in order if x not in table)] = i
    return [table[i] for i in range(size)]


@pytest.mark.parametrize("n,size", [(1, 7), (3, 7), (7, 7), (5, 101), (32, 4099)])
def test_table(n, size):
    shards = [f"s{i}" for i in range(n)]
    table = S.fill(shards, size)
    assert table == plain_table(shards, size)
    counts = Counter(table).values()
    assert max(counts) - min(counts) <= 1 and len(counts) == n


def test_a_lost_shard_moves_little():
    shards = [f"s{i}" for i in range(20)]
    a = [shards[i] for i in S.fill(shards)]
    left = [s for s in shards if s != "s7"]
    b = [left[i] for i in S.fill(left)]
    assert sum(x != y for x, y in zip(a, b, strict=True) if x != "s7") < 0.1 * len(a)


@pytest.mark.parametrize("shards,size", [([], 7), (["a", "a"], 7), (["a"], 8), ([f"s{i}" for i in range(8)], 7)])
def test_bad_tables(shards, size):
    with pytest.raises(ValueError):
        S.fill(shards, size)


def test_placement(spark, documents, hard, no_documents):
    table = S.fill(S.SHARDS)
    want = []
    for d, _ in hard[0]:
        slot = int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16) % S.SIZE
        want.append((d, slot, S.SHARDS[table[slot]]))
    for df in (documents, clashing(documents)):
        assert sorted(map(tuple, S.place(df, "doc_id").collect()), key=repr) == sorted(want, key=repr)
    assert S.place(no_documents, "doc_id").count() == 0
