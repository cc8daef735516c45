"""Super-k-mer dedup against a window-by-window version."""

from __future__ import annotations

import random

import numpy as np
import pytest

from estatelake.llm import superkmer_dedup as S
from tests.llm import brute_windows
from tests.llm.conftest import as_rows, clashing, expected

NOTHING = np.zeros(0, np.uint64)


def result(df):
    out = S.remove_windows(df)
    return as_rows(out.selectExpr("row.doc_id", "n_words", "n_removed", "coalesce(kept, cast('' as binary))"), "*")


def wanted(rows):
    return expected([(d, n, g, bytearray(k.encode())) for (d, _), (n, g, k) in zip(rows, brute_windows.remove_windows(rows), strict=True)])


def test_matches_windows(hard, documents):
    assert result(documents) == wanted(hard[0])


def test_other_partitions_and_clashing_columns(hard, documents):
    assert result(clashing(documents).repartition(2)) == wanted(hard[0])


def test_empty_table(no_documents):
    assert result(no_documents) == []


def odd_texts(seed=5):
    """Few words, all kinds of white space, windows at the ends, repeats inside a document, repeats of ids."""
    rng = random.Random(seed)
    words = ["a", "b", "bb", "é", "\xa0", " ", "\0", "x" * 300, "日本"]
    blanks = [" ", "  ", "\n", "\t \r\n", "\x0b", "\x0c"]
    line = [rng.choice(words) for _ in range(14)]
    rows = []
    for i in range(120):
        w = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = line[: rng.choice([12, 13, 14])]
        text = rng.choice(["", " ", "\n"]) + "".join(x + rng.choice(blanks) for x in w)
        rows.append((rng.choice([i, i, -i, 7, None]), text if rng.random() < 0.5 else text.rstrip()))
    return rows + [(900, " ".join(line * 5)), (901, " ".join(line * 3)), (None, None), (3, None)]


@pytest.mark.parametrize("repeated_ids", [200_000, 0], ids=["some marks", "all marks"])
def test_odd_texts(spark, monkeypatch, repeated_ids):
    monkeypatch.setattr(S, "BROADCAST_ROWS", repeated_ids)
    rows = odd_texts()
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)) == wanted(rows)


def plain(rows, unit, buckets, hot):
    """The removed words of each row by ``pack_unit`` and ``solve``, without Spark; and the bytes of the largest bucket."""
    keyed = [(S.FIRST if d is None else d, i, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    payloads, gone = {}, {}
    for at in range(0, len(keyed), unit):
        for bucket, payload in S.pack_unit(keyed[at : at + unit], buckets, hot):
            payloads.setdefault(bucket, []).append(payload)
    for bucket in payloads.values():
        for batch in S.solve(bucket):
            for _, mark, span in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = span >> S.SPAN_BITS
                gone.setdefault(mark, set()).update(range(start, start + (span & ((1 << S.SPAN_BITS) - 1))))
    return [len(gone.get(i, ())) for i in range(len(rows))], max(sum(map(len, p)) for p in payloads.values())


@pytest.mark.parametrize("hot", [False, True])
def test_small_blocks_units_and_buckets(hard, monkeypatch, hot):
    monkeypatch.setattr(S, "BLOCK", 2000)
    monkeypatch.setattr(S, "PART", 100)
    rows = hard[0] + odd_texts()
    some = NOTHING
    if hot:  # half of all minimizers
        parts = [(i, 0, 0, (t or "").encode()) for i, (_, t) in enumerate(rows)]
        some = np.unique(S.Superkmers(parts, NOTHING).key)[::2]
    got, _ = plain(rows, 9, 11, some)
    assert got == [g for _, g, _ in brute_windows.remove_windows(rows)]


def test_equal_hashes_are_told_apart(monkeypatch):
    """With a hash of two values, windows are still equal only if their words are."""
    true = S.sequence_hash
    monkeypatch.setattr(S, "sequence_hash", lambda w, n: true(w, n) & np.uint64(1) if n == S.WINDOW else true(w, n))
    rows = odd_texts(6)
    assert plain(rows, 10, 3, NOTHING)[0] == [g for _, g, _ in brute_windows.remove_windows(rows)]


def test_a_common_gram_fills_no_bucket(spark, monkeypatch):
    """A gram that is every window's minimizer, with other words around it in every document, is dealt by whole windows."""
    rng = random.Random(4)
    gram = None
    for _ in range(3000):
        w = [f"g{rng.random()}" for _ in range(3)]
        text = " ".join(w).encode()
        packed, starts, stops = S.packed_words(text)
        key = int(S.sequence_hash(S.word_hashes(packed, starts, stops), 3)[0])
        gram = min(gram or (key, w), (key, w))
    rows = [(i, " ".join([f"w{rng.random()}" for _ in range(10)] + gram[1] + [f"w{rng.random()}" for _ in range(10)])) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 400, 4)]
    monkeypatch.setattr(S, "SAMPLE", 1)
    monkeypatch.setattr(S, "BUCKET", 4000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    total, hot = S.surveyed(S.keyed(df, "doc_id", "text"))
    assert gram[0] in hot.tolist()
    buckets = total // S.BUCKET
    (got, spread), (same, crowded) = plain(rows, 50, buckets, hot), plain(rows, 50, buckets, NOTHING)
    assert got == same == [g for _, g, _ in brute_windows.remove_windows(rows)]
    assert spread < crowded / 4
    assert result(df) == wanted(rows)


def test_long_spans_are_split_and_merged():
    doc, mark, span = S.merged(np.array([5, 5, 5, 4]), np.array([1, 1, 1, 1]), np.array([10, 0, 3_000_000, 0]), np.array([2_500_000, 20, 3_000_013, 13]))
    got = [(d, s >> S.SPAN_BITS, s & ((1 << S.SPAN_BITS) - 1)) for d, s in zip(doc.tolist(), span.tolist(), strict=True)]
    assert got[0] == (4, 0, 13) and got[1][:2] == (5, 0) and got[-1] == (5, 3_000_000, 13) and sum(n for *_, n in got) == 2_500_026
