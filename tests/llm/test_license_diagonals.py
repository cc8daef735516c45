"""License scan: base places against a scan word by word, and the method's own labels."""

from __future__ import annotations

from estatelake.llm.license_diagonals import FILLERS, LONG, TEMPLATES, license_spans, scan_licenses
from tests.llm import brute
from tests.llm.conftest import as_rows, clashing, expected

COLUMNS = ("doc", "n_words", "n_base", "first_word", "last_word", "base_labels")


def test_base_matches_a_scan(hard, documents):
    rows, _ = hard
    want = expected([(d, *brute.base_licenses(t)) for d, t in rows])
    assert as_rows(scan_licenses(documents), *COLUMNS) == want
    assert as_rows(scan_licenses(clashing(documents)), *COLUMNS) == want


def test_empty_table(no_documents):
    assert scan_licenses(no_documents).count() == 0


def test_labels_and_score(documents):
    got = {r["doc"]: r for r in scan_licenses(documents).where("doc BETWEEN 700 AND 705").collect()}
    assert got[700]["labels"] == "mit" and got[700]["score"] == 1.0
    assert got[701]["base_labels"] == got[701]["labels"] == "apache-2,cc-by-nc" and got[701]["n_base"] == 3
    assert got[702]["base_labels"] == "cc-by-nc,mit"
    assert got[703]["labels"] == "" and got[703]["score"] == 0.0
    assert got[704]["base_labels"] == "" and got[704]["labels"] == "gpl-3" and got[704]["score"] == 1.0
    assert got[705]["labels"] == ""  # a word put in breaks the few grams of so short a line


def test_neighbouring_diagonals_merge(spark):
    line = "Redistribution and use in source and binary forms, with or without any modification, are permitted"
    out = scan_licenses(spark.createDataFrame([(1, line)], "doc_id long, text string")).first()
    assert out["labels"] == "" or 0.8 <= out["score"] < 1
    long = "Permission is hereby granted, free of charge, to any person obtaining one copy of this software"
    out = scan_licenses(spark.createDataFrame([(1, long)], "doc_id long, text string"), templates={
        "permission is hereby granted free of charge to any person obtaining copy of this software and associated files to deal": "mit"})
    assert out.first()["score"] <= 1
    moved = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    words = moved.split()
    text = " ".join(words[:10] + ["inserted"] + words[10:])
    out = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"), templates={moved: "greek"}).first()
    assert out["labels"] == "greek" and abs(out["score"] - 16 / 18) < 1e-9


def labels_of(spark, texts):
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {texts[r["doc"]]: set(r["labels"].split(",")) for r in rows}


def test_one_word_of_a_long_line_may_differ(spark):
    want = {}
    for phrase, label in TEMPLATES.items():
        w = phrase.split()
        if len(w) >= LONG:
            for i in range(len(w)):
                for edited in (w[:i] + ["zzz"] + w[i:], w[:i] + w[i + 1 :], w[:i] + ["zzz"] + w[i + 1 :]):
                    want["x " + " ".join(edited) + " y"] = label
    assert len(want) > 80
    got = labels_of(spark, list(want))
    assert [t for t, label in want.items() if label not in got[t]] == []


def test_fillers_in_every_line(spark):
    want = {"licensed under the terms of the gnu general public license version 3": "gpl-3", "Released under an MIT license": "mit"}
    for phrase, label in TEMPLATES.items():
        w = phrase.split()
        for i in range(1, len(w)):
            want[" ".join(w[:i] + ["the", "terms", "of", "the"] + w[i:])] = label
            if w[i] in FILLERS:
                want[" ".join(w[:i] + w[i + 1 :])] = want[" ".join(w[:i] + ["a"] + w[i + 1 :])] = label
    got = labels_of(spark, list(want))
    assert [t for t, label in want.items() if got[t] != {label}] == []
    other = ["licensed under the gnu affero general public license", "subject to the terms of the eclipse public license", "released under the bsd license"]
    assert set().union(*labels_of(spark, other).values()) == {""}


def test_place_of_a_reworded_line(spark):
    text = "x the x licensed under the terms of the cc by sa 4 0 the end"
    spans, _ = license_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert [(r["label"], r["start"], r["last"], r["cover"]) for r in spans.collect()] == [("cc-by-sa", 3, 13, 7 / 11)]
