"""Benchmark decontamination against a window-by-window version."""

from __future__ import annotations

import hashlib

from estatelake.llm.decontaminate import clean_documents, decontaminate
from tests.llm import brute
from tests.llm.conftest import as_rows, clashing, expected


def wanted(rows, items):
    out = []
    for d, t in rows:
        n, hit, count, sha, _ = brute.decontaminate([(d, t)], items)[d]
        out.append((d, n, hit, count, sha))
    return expected(out)


def result(docs, items):
    out = decontaminate(docs, items)
    got = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest()) for d, n, h, i in out.select("doc", "n_words", "n_hit", "items").collect()]
    return expected(got)


def test_matches_windows(spark, hard, documents):
    rows, items = hard
    table = spark.createDataFrame(items + items[:2], "item_id long, text string")
    assert result(documents, table) == wanted(rows, items)


def test_clashing_columns_and_no_broadcast(spark, hard, documents, monkeypatch):
    """Beyond the broadcast bound the joins are shuffled, with the same result."""
    from estatelake.llm import shared

    monkeypatch.setattr(shared.small, "__defaults__", (0,))
    rows, items = hard
    table = spark.createDataFrame(items, "item_id long, text string")
    assert result(clashing(documents), clashing(table)) == wanted(rows, items)


def test_empty_tables(spark, documents, no_documents, hard):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(no_documents, none) == []
    assert result(documents, none) == wanted(hard[0], [])
    some = spark.createDataFrame(hard[1], "item_id long, text string")
    assert result(no_documents, some) == []


def test_clean_documents_keep_rows_and_columns(spark, hard, documents):
    rows, items = hard
    out = clean_documents(documents, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == documents.columns
    assert as_rows(out, "doc_id", "text") == expected([(d, t) for d, t in rows if not brute.decontaminate([(d, t)], items)[d][4]])
