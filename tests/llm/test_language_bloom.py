"""Language ID: held-out accuracy, the filter's masks and corrections, undefined texts."""

from __future__ import annotations

import zlib

import numpy as np

from estatelake.llm import language_bloom as L
from tests.conftest import SF_CHECK
from tests.llm.conftest import clashing


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = L.identify(docs).join(docs.selectExpr("doc_id AS id", "lang AS truth"), "id").where("truth IS NOT NULL").collect()
    assert len(rows) > 900 and all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 150 and sum(r["lang"] == r["truth"] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_columns_are_no_inputs(spark):
    """Other labels, sources and ids on held-out rows change nothing about their predictions."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    out = L.held_out(F.col("doc_id"))
    other = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a = {r["id"]: (r["lang"], r["score"]) for r in L.identify(docs).collect()}
    b = {r["id"]: (r["lang"], r["score"]) for r in L.identify(clashing(other)).collect()}
    assert a == b


def test_undefined_texts(spark, documents, hard):
    got = [(r["id"], r["lang"], r["score"]) for r in L.identify(documents).collect()]
    assert len(got) == len(hard[0])
    blank = {d for d, t in hard[0] if d is not None and not any(map(str.isalpha, t or ""))}
    for d, lang, score in got:
        if d in blank - {600}:
            assert (lang, score) == (L.UNKNOWN, 0.0)
        elif d is not None:
            assert lang in ("en", "fr")


def test_nothing_learned_and_empty(spark, no_documents):
    assert L.identify(no_documents).count() == 0
    rows = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [(r["lang"], r["score"]) for r in L.identify(rows).collect()] == [("und", 0.0)] * 2


def test_masks_and_correction():
    """A filter over known n-grams finds each language's own, and others at its own false-positive rate."""
    rng = np.random.default_rng(1)
    filter_ = L.Filter([f"l{i:02d}" for i in range(70)], np.zeros((2, 1 << 14), np.uint64))
    own = rng.integers(0, 1 << 63, (70, 300)).astype(np.uint64)
    for i, grams in enumerate(own):
        for slot in filter_.slots(grams):
            filter_.planes[i // 64][slot] |= np.uint64(1 << i % 64)
    for i in (0, 63, 64, 69):
        assert ((filter_.masks(own[i], i // 64) >> np.uint64(i % 64)) & np.uint64(1)).all()
    other = rng.integers(0, 1 << 63, 20000).astype(np.uint64)
    rates = filter_.false_positives()
    seen = ((filter_.masks(other, 0) >> np.uint64(3)) & np.uint64(1)).mean()
    assert abs(seen - rates[3]) < 0.002


def test_runs_cut_words():
    points, starts = L.runs(["Ab, c", None, "1 2", "é"])
    assert [bytes(points[a:b].astype(np.uint32).tobytes()).decode("utf-32-le") for a, b in zip(starts, [*starts[1:], len(points)], strict=True)] == [
        "\0ab\0c\0", "\0", "\0", "\0é\0"]


def test_known_language_keeps_rows(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "123 ...", "en", "s", 7), (10**6 + 1, None, "en", "s", 0), (10**6 + 2, "Привет мир как дела", "en", "s", 3)], docs.schema)
    out = L.known_language(docs.union(extra), 0.3)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
