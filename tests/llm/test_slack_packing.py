"""Packing: ids like the tokenizer library, every piece placed once without gaps, full bins."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from estatelake.llm import slack_packing as S
from tests.llm import brute
from tests.llm.conftest import clashing


def check_places(rows, size=2048):
    """Sequences are filled from offset 0 without gaps; returns their number."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences)


def test_matches_the_tokenizer(hard, documents):
    for df in (documents, clashing(documents).repartition(3)):
        rows = S.pack(df).collect()
        assert Counter((r["doc"], r["piece"], r["start"], r["length"], r["crc"]) for r in rows) == brute.pieces(hard[0])
        n = check_places(rows)
        assert n <= 1.1 * sum(r["length"] for r in rows) / 2048 + 1


def test_empty_table(no_documents):
    assert S.pack(no_documents).count() == 0


def test_encoders_agree_on_characters():
    """Each character that goes the fast way, in several surroundings."""
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = S.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for c in map(chr, range(S.PLAIN)):
        for text in (c, f"a{c}b", f" {c}{c} x", f"1{c}2 {c}", f"{c}\n\n{c} 's'S{c}ll", f"  {c}  "):
            assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("text", [" " * 9000 + "x", "x" * 9000, "a" * 4100 + "é", "\n" * 5000, "日本 text", "<|endoftext|>", "x<|endoftext|> y"])
def test_encoders_agree_on_runs(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert S.encoder(path)(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_fullest_is_the_best_subset():
    rng = random.Random(4)
    for _ in range(60):
        counts = Counter(rng.randint(1, 30) for _ in range(rng.randint(0, 8)))
        room = rng.randint(0, 70)
        items = list(counts.elements())
        best = max(sum(s) for k in range(len(items) + 1) for s in itertools.combinations(items, k) if sum(s) <= room)
        got = S.fullest(dict(counts), room)
        assert sum(x * n for x, n in got.items()) == best and all(n <= counts[x] for x, n in got.items())


def test_plan_uses_every_piece_once():
    rng = random.Random(8)
    histogram = dict(Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20000)))
    plan = S.plan_bins(histogram)
    used = Counter()
    for bins, combination in plan:
        assert sum(x * n for x, n in combination.items()) <= 2048
        for x, n in combination.items():
            used[x] += bins * n
    assert used == Counter(histogram)
    table = S.places(plan)
    assert (np.diff(table[:, 0]) >= 0).all()
    assert sum(b for b, _ in plan) <= 1.01 * sum(x * n for x, n in histogram.items()) / 2048 + 1


def test_ranks_in_many_parts(hard, documents, monkeypatch):
    monkeypatch.setattr(S, "SALT_ROWS", 7)
    rows = S.pack(documents).collect()
    assert len(rows) == sum(brute.pieces(hard[0]).values())
    check_places(rows)


def test_equal_rows_are_ranked_in_many_parts(spark, monkeypatch):
    """Rows that repeat id and text are dealt over the parts of their length, and each finds a place of its own."""
    monkeypatch.setattr(S, "SALT_ROWS", 50)
    rows = [(None, "")] * 1000 + [(i, "one two three " * (i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = S.pack(df).collect()
    assert len(out) == 1300
    check_places(out)
    assert len({(r["sequence"], r["offset"]) for r in out}) == 1300
    cut = S.cut_lineage(S.pieces(df))
    parts = S.salted(cut, {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}, 2048)
    assert max(r["count"] for r in parts.groupBy("length", "salt").count().collect()) < 100


def test_other_tokenizer_files_go_through_the_library(tmp_path):
    """A file with another cut, a normalizer, or other merges than by id gives the ids of the tokenizer library."""
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    with open(S.default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    assert S.byte_level(spec)
    files = [public_tokenizers.path("word_bpe_49k.json")]
    for name, change in (
        ("prefix", {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}),
        ("lower", {"normalizer": {"type": "Lowercase"}}),
        ("merges", {"model": {**spec["model"], "merges": [*spec["model"]["merges"][1000:], *spec["model"]["merges"][:1000]]}}),
        ("dropped", {"model": {**spec["model"], "merges": spec["model"]["merges"][:1000]}}),
    ):
        other = {**spec, **change}
        assert not S.byte_level(other), name
        files.append(str(tmp_path / f"{name}.json"))
        with open(files[-1], "w", encoding="utf-8") as f:
            json.dump(other, f)
    for path in files:
        whole = Tokenizer.from_file(path)
        for text in ("The quick Brown fox, 123 times.", "naïve  ÉLAN\n\n日本 it's", " a", "<|endoftext|>x"):
            assert S.encoder(path)(text).tolist() == whole.encode(text, add_special_tokens=False).ids, (path, text)
