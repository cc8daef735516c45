"""Suffix-array dedup against a window-by-window version."""

from __future__ import annotations

import random

import numpy as np
import pytest

from estatelake.llm import suffix_dedup as S
from tests.llm import brute
from tests.llm.conftest import as_rows, clashing, expected


def result(df, **options):
    out = S.remove_repeats(df, **options)
    return as_rows(out.selectExpr("row.doc_id", "n_bytes", "n_removed", "n_spans", "coalesce(kept, cast('' as binary))"),
                   "*")


def wanted(rows, length=100):
    return expected([(d, n, g, r, bytearray(k)) for (d, _), (n, g, r, k) in zip(rows, brute.remove_repeats(rows, length), strict=True)])


@pytest.mark.parametrize("length", [100, 40])
def test_matches_windows(hard, documents, length):
    assert result(documents, length=length) == wanted(hard[0], length)


def test_clashing_columns_and_other_partitions(hard, documents):
    assert result(clashing(documents).repartition(2)) == wanted(hard[0])


def test_empty_table(no_documents):
    assert result(no_documents) == []


def test_small_blocks_units_and_buckets(hard, documents, monkeypatch):
    """Places cut over many blocks, units and buckets give the same result."""
    for name, value in (("BLOCK", 4096), ("UNIT", 9000), ("BUCKET", 3000), ("SORTED", 2000)):
        monkeypatch.setattr(S, name, value)
    rows = [(d, t) for d, t in hard[0]]
    found, payloads = {}, {}
    keyed = [(S.FIRST if d is None else d, hash((t or "")) & 0x7FFFFFFF, (t or "").encode()) for d, t in rows]
    for at in range(0, len(keyed), 7):
        for bucket, payload in S.cut_unit(keyed[at : at + 7], 9, 100):
            payloads.setdefault(bucket, []).append(payload)
    for bucket in payloads.values():
        for batch in S.solve(bucket, 100):
            for doc, mark, span in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = span >> S.SPAN_BITS
                found.setdefault((doc, mark), set()).update(range(start, start + (span & ((1 << S.SPAN_BITS) - 1))))
    for (doc, mark, _), (_, gone, _, _) in zip(keyed, brute.remove_repeats(rows), strict=True):
        assert len(found.get((doc, mark), ())) == gone, doc


def dealt_by_hand(rows, length, hot, buckets=64):
    """Removed places per (doc, mark), and the segment bytes that meet under each minimizer of each bucket."""
    payloads, found, groups = {}, {}, {}
    for at in range(0, len(rows), 7):
        for bucket, payload in S.cut_unit(rows[at : at + 7], buckets, length, hot):
            payloads.setdefault(bucket, []).append(payload)
    solved = S.repeated

    def watched(text, doc, start, mark, size, length):
        groups[len(groups)] = len(text)
        return solved(text, doc, start, mark, size, length)

    S.repeated = watched
    try:
        for bucket in payloads.values():
            for batch in S.solve(bucket, length):
                for doc, mark, span in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    start = span >> S.SPAN_BITS
                    found.setdefault((doc, mark), set()).update(range(start, start + (span & ((1 << S.SPAN_BITS) - 1))))
    finally:
        S.repeated = solved
    return found, groups


def common_gram(n, rng):
    """Texts that are all different but for one 16-byte string, which hashes low, and a passage in every fifth."""
    letters = b"abcdefghijklmnopqrstuvwxyz     "
    word = lambda k: bytes(rng.choice(letters) for _ in range(k))
    grams = [word(16) for _ in range(20000)]
    raw = np.frombuffer(b"".join(grams) + bytes(16), np.uint8)
    common = grams[int(S.gram_hash(S.words_at(raw), np.arange(20000) * 16).argmin())]
    passage = word(300)
    return [word(150) + common + word(150) + (passage + word(20) if i % 5 == 0 else b"") for i in range(n)]


def test_hot_minimizers_are_dealt_anew(monkeypatch):
    """A gram that all documents have, each with other words around it, gathers no group; nothing else changes."""
    monkeypatch.setattr(S, "SORTED", 2000)
    texts = common_gram(400, random.Random(8))
    rows = [(i, 0, t) for i, t in enumerate(texts)]
    want = [gone for _, gone, _, _ in brute.remove_repeats([(i, t.decode()) for i, t in enumerate(texts)])]
    cold, before = dealt_by_hand(rows, 100, None)
    hot = []
    for _ in S.grams(100):
        batch = S.weighed(texts, 100, hot)
        heavy = [h for h, size in zip(*(c.to_pylist() for c in batch.columns), strict=True) if size > 4000]
        hot.append(np.sort(np.array(heavy, np.int64).view(np.uint64)))
    assert len(hot[0]) and len(hot[1])  # the common gram, and at the passage's edges a longer one
    found, after = dealt_by_hand(rows, 100, hot)
    assert max(before.values()) > 50_000 and max(after.values()) < 25_000
    for got in (cold, found):
        assert [len(got.get((i, 0), ())) for i in range(len(texts))] == want


@pytest.mark.parametrize("length", [100, 40])
def test_hot_minimizers_found_by_spark(hard, documents, monkeypatch, length):
    """With a bound that nearly every sampled minimizer passes, windows go all three ways and the result is the same."""
    monkeypatch.setattr(S, "HOT", 2000)
    lists = []
    found = S.hot_minimizers
    monkeypatch.setattr(S, "hot_minimizers", lambda *a: lists.append(found(*a)) or lists[-1])
    assert result(documents, length=length) == wanted(hard[0], length)
    assert all(len(h) for h in lists[0])


def test_marks_stand_only_where_ids_repeat(spark, monkeypatch):
    rows = [(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, None), (None, ""), (3, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    again = S.repeated_ids(df, "doc_id")
    marks = {(r["doc"], bytes(r["bytes"])): r["mark"] for r in S.keyed(df, "doc_id", "text", again).collect()}
    assert marks[1, b"a"] == marks[3, b"e"] == 0
    assert len({marks[2, b"b"], marks[2, b"c"], marks[S.FIRST, b"d"], marks[S.FIRST, b""], 0}) == 5
    assert max(abs(m) for m in marks.values()) > 1 << 40
    monkeypatch.setattr(S, "BROADCAST_ROWS", 1)  # too many repeated ids for a broadcast: every row has its hash
    again = S.repeated_ids(df, "doc_id")
    assert all(r["mark"] for r in S.keyed(df, "doc_id", "text", again).collect())


def test_whole_characters(spark):
    shared = "".join(chr(0xE0 + i) for i in range(60))
    rows = [(1, "x" + shared + "yy"), (2, shared + "ß" * 10), (3, None)]
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True)
    kept = {r["doc_id"]: r["kept"] for r in out.selectExpr("row.doc_id", "kept").collect()}
    assert bytes(kept[1]).decode() == rows[0][1] and bytes(kept[2]).decode() == "ß" * 10 and kept[3] is None


def test_halves_of_two_characters_make_no_third(spark):
    """100 bytes from the second byte of one character to the first of another are removed: neither leaves a half."""
    hole = "\u00e9" + "x" * 98 + "\u00e8"
    first = "\u0169" + "x" * 98 + "\u00e0"  # has the second byte of the one and the first of the other
    assert first.encode()[1:101] == hole.encode()[1:101]
    rows = [(1, first), (2, hole + "tail")]
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True)
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in out.selectExpr("row.doc_id", "kept").collect()}
    assert kept == {1: first, 2: "tail"}


def test_suffix_order_is_the_sorted_order():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abA\0\xff") for _ in range(rng.randint(17, 60))) for _ in range(200)] + [b"a" * 50, b"ab" * 30]
    text = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    heads = ends - [len(t) for t in texts]
    windows = np.array([len(t) - 16 for t in texts])
    order, segment = S.suffix_order(text, heads, ends, windows, 100)
    suffixes = [text[p : ends[s]] for p, s in zip(order.tolist(), segment.tolist(), strict=True)]
    assert suffixes == sorted(suffixes)
    assert sorted(order.tolist()) == [p for h, w in zip(heads, windows, strict=True) for p in range(h, h + w)]
    words = S.words_at(np.frombuffer(text + bytes(8), np.uint8))
    assert S.common_prefix(words, order, 17).tolist() == [False] + [a[:17] == b[:17] for a, b in zip(suffixes, suffixes[1:], strict=False)]


def test_long_spans_are_split_and_merged():
    doc, mark = np.array([5, 5, 5]), np.array([1, 1, 1])
    batch = S.spans(doc, mark, np.array([10, 0, 3_000_000]), np.array([2_500_000, 20, 3_000_100]))
    got = [(s >> S.SPAN_BITS, s & ((1 << S.SPAN_BITS) - 1)) for s in batch.column(2).to_pylist()]
    assert sum(n for _, n in got) == 2_500_000 + 100 and got[0][0] == 0 and got[-1] == (3_000_000, 100)


@pytest.mark.parametrize("letters", [b"\0a", b"\0\1\xff", b"ab"])
def test_byte_order_is_that_of_the_strings(letters):
    """Sorting by words of eight bytes agrees with sorting the strings, with zeros, ends within a word and long ties."""
    rng = np.random.default_rng(5)
    text = bytes(rng.choice(list(letters), 400).astype(np.uint8)) + b"ab" * 60 + bytes(40)
    text += text[:200]
    begin = np.r_[rng.integers(0, len(text) + 1, 3000), len(text)]
    size = np.minimum(rng.integers(0, 101, len(begin)), len(text) - begin)
    strings = [text[b : b + s] for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
    order = S.byte_order(text, begin, size).tolist()
    assert sorted(order) == list(range(len(begin)))
    assert [strings[i] for i in order] == sorted(strings)
    assert len(S.byte_order(text, begin[:0], size[:0])) == 0
