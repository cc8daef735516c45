from __future__ import annotations

import random

import pytest

from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def hard_texts(seed=1):
    """Rows (id, text): copies, near copies, shared passages, blanks, nulls, repeats, long and odd texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubcdrst") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    words += ["élan", "Über", "naïve", "x1", "日本", "ß", "\u212aelvin"]
    passage = sentence(rng, words, 60)
    item = sentence(rng, words, 25)
    base = sentence(rng, words, 220)
    rows = [(i, sentence(rng, words, rng.randint(1, 120))) for i in range(30)]
    rows += [(100 + i, base) for i in range(5)]  # copies
    for i in range(6):  # near copies: one word changed
        w = base.split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{sentence(rng, words, 30)}\n{passage}\n{sentence(rng, words, 20)}") for i in range(6)]
    rows += [(400 + i, f"{sentence(rng, words, 15)} {item} {sentence(rng, words, 5)}") for i in range(3)]
    rows += [(450, item.upper()), (451, item[: len(item) // 2])]
    rows += [(500, "a" * 1000), (501, "a" * 350), (502, "ab" * 300), (503, "\0" * 150 + "z"), (504, " \n\t "), (505, ""), (506, None)]
    rows += [(507, sentence(rng, words, 15000)), (508, "one"), (509, "two words"), (510, "<|endoftext|> special <|endoftext|>")]
    rows += [(600, rows[0][1]), (600, rows[0][1]), (600, rows[1][1]), (600, base)]  # an id that repeats
    rows += [(None, "no id " + base), (None, None), (None, sentence(rng, words, 40)), (-7, base + " more")]
    rows += [
        (700, "Released under the MIT License."), (701, "Licensed under the Apache License, Version 2.0. Cc BY-NC, cc-by-nc"),
        (702, "under the the mit license under the mit license cc by nc"), (703, "MIT license"),
        (704, "This work is licensed under the GNU General Public License, version 3."),
        (705, "this work is licensed under the old GNU General Public License, version 3."),
    ]
    return rows, [(1, item), (2, passage[: len(passage) // 2]), (2, item), (3, "two words"), (4, None), (5, ""), (6, "..."), (7, "one")]


@pytest.fixture(scope="session")
def hard():
    return hard_texts()


@pytest.fixture(scope="session")
def documents(spark, hard):
    rows, _ = hard
    langs = ["en", "fr", None]
    return spark.createDataFrame([(d, t, langs[i % 3], None, len(t or "")) for i, (d, t) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """``df`` with columns named like the operators' own ones."""
    from pyspark.sql import functions as F

    names = ("doc id row mark bytes key slot text_hash n_words pos gram w fp component kept found packed label cell stored "
             "vec hash unit node copies host part count salt rank length piece score url2 h d m given spans cut").split()
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})


def as_rows(df, *columns):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def expected(rows):
    return sorted(rows, key=repr)


__all__ = ["brute"]
