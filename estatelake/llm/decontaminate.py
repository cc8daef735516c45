"""Benchmark decontamination: a prefix-filtered set join over item-sized windows.

A window is ``window`` consecutive words of an item (an item with fewer words is
one window).  As a set it holds its word shingles; a document contains the
window only if it holds all of them, so with the shingles in order of rarity the
necessary prefix is the single rarest one.  Steps, all DataFrame operations:

1. one pass over the documents finds the places of every benchmark shingle;
2. their counts over the whole corpus give the order of rarity, and a window with
   a shingle that occurs nowhere is out (length bound: all shingles are needed);
3. only the rarest shingle of each remaining window is joined with the places;
   the place fixes the start of the window, which must lie inside the text
   (positional bound);
4. exact verification: every shingle of the window stands at its place.

Defined results: a null or wordless text has no words and no hits; a null or
wordless item has no window; an item without id marks words but cannot be listed;
repeated document rows each get their own result; repeated items count once per id;
other columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage, gram_postings, small, words

SHINGLE = 5
WINDOW = 10


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows: ``win`` (its words joined by a space), ``win_len``, ``items`` (ids as strings)."""
    by_word = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    by_word = by_word.withColumn("n", F.size("w")).where("n > 0")
    places = F.sequence(F.lit(1), F.greatest(F.col("n") - (window - 1), F.lit(1)))
    cut = by_word.select("item", "w", "n", F.explode(places).alias("at")).select(
        "item",
        F.array_join(F.slice("w", F.col("at"), F.least(F.col("n"), F.lit(window))), " ").alias("win"),
        F.least(F.col("n"), F.lit(window)).alias("win_len"),
    )
    return cut.groupBy("win", "win_len").agg(F.collect_set("item").alias("items"))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``win, win_len, j, gram, need``: the shingle at word ``j`` of a window, ``need`` of them in all."""
    parts = windows.select("win", "win_len", F.split("win", " ").alias("w"))
    k = F.least(F.col("win_len"), F.lit(shingle))
    parts = parts.withColumn("k", k).withColumn("need", F.col("win_len") - F.col("k") + 1)
    return parts.select(
        "win", "win_len", "need", "k", "w", F.explode(F.sequence(F.lit(0), F.col("need") - 1)).alias("j")
    ).select("win", "win_len", "need", "k", "j", F.array_join(F.slice("w", F.col("j") + 1, F.col("k")), " ").alias("gram"))


def find_windows(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """All occurrences of item windows, and the list of documents.

    Returns ``(found, listed)``: ``found`` has ``doc, text_hash, start, win_len, items``
    for each place of each distinct window, ``listed`` has ``doc, text_hash, n_words``
    for each input row.
    """
    windows = cut_lineage(item_windows(items, item_id_col, item_text_col, window))
    shingles = cut_lineage(window_shingles(windows, shingle))
    lengths = sorted(r["k"] for r in shingles.select("k").distinct().collect())  # at most `shingle` values
    places = cut_lineage(gram_postings(docs, id_col, text_col, small(shingles.select("gram").distinct()), lengths))
    known = places.where("pos >= 0").select("doc", "text_hash", "n_words", "pos", "gram")
    known = known.distinct()  # repeated rows have the same places
    rarity = known.groupBy("gram").count()
    ranked = shingles.join(rarity, "gram", "left")
    prefix = (
        ranked.groupBy("win", "win_len", "need")
        .agg(
            F.count("count").alias("present"),
            F.min_by(F.struct("gram", "j"), F.struct("count", "j")).alias("rarest"),
        )
        .where("present = need")
        .select("win", "win_len", "need", F.col("rarest.gram").alias("gram"), F.col("rarest.j").alias("offset"))
    )
    prefix = cut_lineage(prefix)
    candidates = (
        known.join(small(prefix), "gram")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where((F.col("start") >= 0) & (F.col("start") + F.col("win_len") <= F.col("n_words")))
        .select("doc", "text_hash", "start", "win", "win_len", "need")
    )
    expected = candidates.join(small(shingles.select("win", "j", "gram")), "win").withColumn(
        "pos", F.col("start") + F.col("j")
    )
    there = known.select(
        F.col("doc").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("p"), F.col("gram").alias("g")
    )
    met = expected.join(
        there,
        expected["doc"].eqNullSafe(there["d"])
        & (expected["text_hash"] == there["h"])
        & (expected["pos"] == there["p"])
        & (expected["gram"] == there["g"]),
    )
    verified = met.groupBy("doc", "text_hash", "start", "win", "win_len", "need").count().where("`count` = need")
    found = verified.join(small(windows.select("win", "items")), "win").select(
        "doc", "text_hash", "start", "win_len", "items"
    )
    return found, places.where("pos = -1").select("doc", "text_hash", "n_words")


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: its words, the words inside window occurrences and the ids of the items found.

    Returns ``doc, text_hash, n_words, n_hit, items`` (sorted array of item ids as strings).
    """
    found, listed = find_windows(docs, items, **options)
    found = cut_lineage(found)
    # Words covered by overlapping places count once: each place adds what lies beyond all earlier ends.
    end = F.col("start") + F.col("win_len")
    spans = found.select("doc", "text_hash", "start", end.alias("end")).groupBy("doc", "text_hash", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("doc", "text_hash").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0)))
    hits = spans.groupBy("doc", "text_hash").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.col("seen")))).alias("n_hit")
    )
    listed_items = (
        found.select("doc", "text_hash", F.explode("items").alias("item"))
        .distinct()
        .groupBy("doc", "text_hash")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    per_doc = hits.join(
        listed_items.withColumnsRenamed({"doc": "d", "text_hash": "h"}),
        F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")),
        "left",
    ).select(F.col("doc").alias("hd"), F.col("text_hash").alias("hh"), "n_hit", "items")
    return listed.join(
        per_doc, F.col("doc").eqNullSafe(F.col("hd")) & (F.col("text_hash") == F.col("hh")), "left"
    ).select(
        "doc",
        "text_hash",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any word inside a window occurrence."""
    found, _ = find_windows(docs, items, id_col, text_col, **options)
    hit = cut_lineage(found.select(F.col("doc").alias("hit_doc"), F.col("text_hash").alias("hit_hash")).distinct())
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    same = F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("text_hash") == F.col("hit_hash"))
    return rows.join(small(hit), same, "left_anti").select("row.*")
