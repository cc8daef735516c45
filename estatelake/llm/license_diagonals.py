"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word 3-gram of a text is hashed and joined with the 3-grams of the
license templates.  A match of text place ``p`` with template place ``t`` votes for
the diagonal ``p - t``.  Votes are counted per diagonal, diagonals that lie within
``DRIFT`` words of each other are merged (an inserted or missing word moves the rest
of a license line to a neighbouring diagonal), and a merged run is a license if its
distinct template places cover at least ``COVER`` of the template.  A template of ``LONG``
words or more is also met if the words of its places are ``COVER`` of its words (rounded down):
any one word put in, missing or replaced leaves that much.  The grams
themselves are compared beside their hashes, so a vote is exact, and a phrase that
has all its votes on one diagonal stands there word for word.

In a shorter line nearly each word tells licenses apart (GNU General and GNU Affero General,
Mozilla and Eclipse Public License), so words are verified there one by one: the line may
differ by any number of ``FILLERS``, put in, missing or replaced, and by no other word inside it.
The cover of such a place is the number of agreeing words over the longer of template and place.

Defined results: a null, empty or wordless text has no words and no license;
repeated rows each get their own result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage, gram_postings, words

GRAM = 3
DRIFT = 2
COVER = 0.8
LONG = 10  # words from which on a template may differ in any one word

# Words that a license line may have or lack without naming another license.
FILLERS = ("a", "an", "of", "term", "terms", "the", "this")

# The phrases of the base scan and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening lines of common licenses and the labels the method adds.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "licensed under the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this work is dedicated to the public domain": "public-domain",
}


def template_grams(spark, base: dict[str, str], templates: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(grams, kinds)``: grams with their places in templates, and the templates (bounded by the two dicts)."""
    kinds, rows = [], []
    for number, (phrase, label, is_base) in enumerate(
        [(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in templates.items()]
    ):
        parts = phrase.split()
        kinds.append((number, label, is_base, len(parts) - GRAM + 1, len(parts)))
        rows += [(" ".join(parts[i : i + GRAM]), number, i) for i in range(len(parts) - GRAM + 1)]
    grams = spark.createDataFrame(rows, "gram string, template int, place int")
    grams = grams.groupBy("gram").agg(F.collect_list(F.struct("template", "place")).alias("at"))
    return grams, spark.createDataFrame(kinds, "template int, label string, base boolean, need int, n int")


def line_at(phrase: str, own: list[str], label: str) -> Callable[[Column, Column], Column]:
    """Whether the words ``own`` of a template stand from a place of ``kept`` on: the place, else null."""

    def place(x: Column, i: Column) -> Column:
        fits = x["w"] == own[0]
        for j, word in enumerate(own[1:], 1):
            fits = fits & (F.get("kept", i + j)["w"] == word)
        fields = {"label": F.lit(label), "n": F.lit(len(phrase.split())), "met": F.lit(len(own))}
        fields |= {"start": x["at"], "last": F.get("kept", i + (len(own) - 1))["at"]}
        return F.when(fits, F.struct(*[value.alias(name) for name, value in fields.items()]))

    return place


def reworded(docs: DataFrame, id_col: str, text_col: str, templates: dict[str, str]) -> DataFrame:
    """``doc, text_hash, label, base, start, last, cover`` of the lines that agree with a template but for ``FILLERS``."""
    bare = {p: [w for w in p.split() if w not in FILLERS] for p in templates}
    bare = {p: own for p, own in bare.items() if len(own) >= 2}
    # A quick necessary condition: all those words occur in the text.
    lowered, hopeful = F.lower(F.col(text_col)), F.lit(False)
    for own in bare.values():
        every = F.lit(True)
        for word in sorted(set(own), key=lambda w: (-len(w), w)):
            every = every & F.contains(lowered, F.lit(word))
        hopeful = hopeful | every
    placed = F.transform(words(F.col(text_col)), lambda w, i: F.struct(w.alias("w"), i.alias("at")))
    texts = docs.where(hopeful).select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.filter(placed, lambda x: ~x["w"].isin(*FILLERS)).alias("kept"),
    )
    found = F.array().cast("array<struct<label:string,n:int,met:int,start:int,last:int>>")
    for phrase, own in bare.items():
        found = F.concat(found, F.filter(F.transform("kept", line_at(phrase, own, templates[phrase])), lambda x: x.isNotNull()))
    met = texts.select("doc", "text_hash", F.explode(found).alias("at")).select("doc", "text_hash", "at.*")
    cover = F.col("met") / F.greatest(F.col("n"), F.col("last") - F.col("start") + 1)
    return met.select("doc", "text_hash", "label", F.lit(False).alias("base"), "start", "last", cover.alias("cover"))


def license_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Verified license places, and the list of documents.

    Returns ``(spans, listed)``: ``spans`` has ``doc, text_hash, label, base, start, last, cover``
    (first and last word of the place), ``listed`` has ``doc, text_hash, n_words`` for each row.
    """
    spark = docs.sparkSession
    base, templates = BASE if base is None else base, TEMPLATES if templates is None else templates
    grams, kinds = template_grams(spark, base, templates)
    # Both tables hold one row per word of the fixed templates.
    places = cut_lineage(gram_postings(docs, id_col, text_col, F.broadcast(grams), [GRAM]))
    votes = (
        places.where("pos >= 0")
        .select("doc", "text_hash", "pos", F.explode("at").alias("v"))
        .select("doc", "text_hash", "v.template", F.col("v.place").alias("place"), (F.col("pos") - F.col("v.place")).alias("diagonal"))
        .distinct()
    )
    diagonals = votes.groupBy("doc", "text_hash", "template", "diagonal").agg(F.collect_set("place").alias("places"))
    diagonals = diagonals.join(F.broadcast(kinds), "template")
    exact = diagonals.where("base AND size(places) = need").select(
        "doc",
        "text_hash",
        "label",
        "base",
        F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("need") + (GRAM - 2)).alias("last"),
        F.lit(1.0).alias("cover"),
    )
    along = Window.partitionBy("doc", "text_hash", "template").orderBy("diagonal")
    runs = diagonals.where("NOT base").withColumn(
        "opens", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True)).cast("int")
    )
    runs = runs.withColumn("run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("doc", "text_hash", "template", "label", "base", "need", "n", "run").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("met"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("places") + (GRAM - 1)).alias("last"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("met", lambda p: F.sequence(p, p + (GRAM - 1))))))
    enough = (F.col("cover") >= COVER) | (F.col("n") >= LONG) & (covered >= F.floor(F.col("n") * COVER))
    close = merged.withColumn("cover", F.size("met") / F.col("need")).where(enough).select(*exact.columns)
    close = close.withColumn("sure", F.col("cover") == 1)
    close = close.unionByName(reworded(docs, id_col, text_col, templates).withColumn("sure", F.lit(True)))
    close = close.groupBy("doc", "text_hash", "label", "base", "start").agg(
        F.max("last").alias("last"), F.max("cover").alias("cover"), F.max("sure").alias("sure")
    )
    # Templates that differ in a word or two claim the same place: the one whose words all stand there, or that covers it best, has it.
    rank = F.struct("sure", "cover")
    best = F.max(rank).over(Window.partitionBy("doc", "text_hash", "start"))
    close = close.withColumn("best", best).where(F.col("best") == rank)
    spans = exact.unionByName(close.select(*exact.columns))
    return spans, places.where("pos = -1").select("doc", "text_hash", "n_words")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: base places, first and last of them, base labels, all labels and the best cover as score."""
    spans, listed = license_spans(docs, id_col, text_col, **options)
    is_base = F.col("base")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.groupBy("doc", "text_hash").agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        joined(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("cover").alias("score"),
    ).withColumnsRenamed({"doc": "d", "text_hash": "h"})
    return listed.join(
        found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left"
    ).select(
        "doc",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
