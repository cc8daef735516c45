"""Merkle manifest against a plain tree."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from estatelake.llm import merkle_manifest as M
from estatelake.llm import queries as Q
from tests.llm import brute_tree
from tests.llm.conftest import SCHEMA, as_rows, clashing

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def table(spark, rows, parts=5):
    """rows: (doc_id, source, lang, n_chars, text)"""
    return spark.createDataFrame([(i, t, lang, s, n) for i, s, lang, n, t in rows], SCHEMA).repartition(parts)


def result(monkeypatch, spark, df):
    monkeypatch.setattr(Q, "read", lambda *_: df)
    return as_rows(Q.op12_merkle_manifest(spark, ""), "*")


def rows_of(seed, sizes):
    rng, out = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            i = rng.randint(-3000, 3000)
            text = rng.choice([None, "", "Some Text É", f"Text {i} " + "Ab ß " * rng.randint(0, 50)])
            out.append((i, source, rng.choice(["en", None, ""]), rng.choice([None, 5, -1]), text))
    return out


SIZES = {None: 3, "": 1, "a": 700, "b": 16, "é": 17, "Z": 257, "z\U0001f600": 2, "￮": 1} | {f"s{i}": 1 for i in range(20)}


def test_matches_plain_tree(spark, monkeypatch):
    rows = rows_of(1, SIZES)
    assert result(monkeypatch, spark, table(spark, rows)) == brute_tree.manifest(rows)


def test_other_partitions_and_clashing_columns(spark, monkeypatch):
    rows = rows_of(2, SIZES)
    df = clashing(table(spark, rows, 2)).withColumns({n: F.lit("x") for n in ("tree", "pos", "n", "hash", "more", "nth", "tie", "at", "task", "first", "grp")})
    assert result(monkeypatch, spark, df) == brute_tree.manifest(rows)


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None)], [(1, "a", "en", 3, "Abc"), (2, "b", "en", 3, "Abc")],
    [(7, "a", None, None, "same")] * 40 + [(None, "a", None, None, "same")] * 300,
], ids=["empty", "one, all null", "lone leaves", "repeats"])
def test_small_tables(spark, monkeypatch, rows):
    assert result(monkeypatch, spark, table(spark, rows)) == brute_tree.manifest(rows)


def test_long_texts_and_another_fanout(spark):
    rows = [(i, "a", "en", 0, "Word " * 200_000 if i == 3 else str(i)) for i in range(30)]
    out = M.manifest(table(spark, rows), "doc_id", "source", COLUMNS, fanout=3)
    got = as_rows(out.select("key", "leaf", "subroot", "root", F.sha2(M.siblings(F.col("path")), 256)), "*")
    assert got == sorted((r[:5] for r in brute_tree.manifest(rows, 3)), key=repr)


def test_any_change_is_noticed(spark):
    """Each column, changed in one row, gives another root; the proof of an untouched row still holds."""
    rows = rows_of(3, {"a": 40, "b": 5})
    df = table(spark, rows)
    root = M.manifest(df, "doc_id", "source", COLUMNS).first()["root"]
    for change in ({"text": F.concat(F.coalesce("text", F.lit("")), F.lit(" "))}, {"lang": F.lit("xx")}, {"n_chars": F.lit(99)}):
        assert M.manifest(df.withColumns(change), "doc_id", "source", COLUMNS).first()["root"] != root
    out = M.manifest(df, "doc_id", "source", COLUMNS)
    assert out.where(M.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_large_groups_table_is_joined_by_shuffle(spark, monkeypatch):
    rows = rows_of(4, SIZES)
    monkeypatch.setattr(M, "BROADCAST_BYTES", 0)
    assert result(monkeypatch, spark, table(spark, rows)) == brute_tree.manifest(rows)
