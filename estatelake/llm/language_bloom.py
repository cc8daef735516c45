"""Language identification with bit-sliced Bloom filters of character n-grams.

One filter table serves all languages: a slot is a bitmask with one bit per language,
and the AND of an n-gram's ``PROBES`` slots is the mask of all languages that
contain it.  A text's n-grams are looked up together; per language the masks' bits are
counted, the hits that the filter's own false positives explain are taken off, and the
language with the largest corrected count wins.

Learning: of each language, rows are sampled by a hash of their id so that about
``SAMPLE`` rows are expected (a documented bound on the fit; all rows of a smaller
language).  N-grams are counted by Spark; one enters a language's slice if it was
counted ``LEAST`` times there and its share is at least ``SHARE`` of its share in the
language that has most of it, so that a foreign passage does not teach its words.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for every text
if nothing could be learned; ties go to the language first in order; the score is the
winner's corrected share of the text's n-grams, between 0 and 1; rows without language, text
or id teach nothing; repeated rows each get their own result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.shared import give_back
from estatelake.session import ship_package

ORDERS = (3, 4)
PROBES = 2
SAMPLE = 2500
LEAST = 4
SHARE = 0.1
SLOTS_PER_GRAM = 12
UNKNOWN = "und"
CHUNK = 1 << 18  # characters looked up at once; an array of them takes a few MB

# Odd multipliers of the hash, from the fractional part of the golden ratio.
MIX = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64) for i in range(8)]


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, lower-cased, with one 0 for whatever stands between words and at both ends.

    Returns the points of all texts and where each text starts (its letters, if any, follow a 0).
    """
    parts, starts, at = [], [], 0
    for text in texts:
        points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = letters()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        starts.append(at)
        parts.append(np.where(letter, points, np.uint32(0))[keep])
        at += len(parts[-1])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array(starts, np.int64)


def gram_hashes(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order, the hash of the n-gram that starts at each point (the last ones are short)."""
    wide = points.astype(np.uint64)
    for n in ORDERS:
        total = wide[: max(0, len(wide) - n + 1)] * MIX[0]
        for i in range(1, n):
            total += wide[i : len(wide) - n + 1 + i] * MIX[i]
        total ^= total >> np.uint64(29)
        total *= MIX[n]
        total ^= total >> np.uint64(32)
        yield n, total


@dataclass
class Filter:
    """Slots of language bits, and the languages in the order of their bits (64 to a plane)."""

    languages: list[str]
    planes: np.ndarray  # planes x slots

    def slots(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        bits = np.uint64(self.planes.shape[1].bit_length() - 1)
        for i in range(PROBES):
            yield (hashes * MIX[7 - i]) >> (np.uint64(64) - bits)

    def masks(self, hashes: np.ndarray, plane: int) -> np.ndarray:
        """The languages that contain each n-gram."""
        first, *rest = self.slots(hashes)
        found = self.planes[plane][first]
        for slot in rest:
            found &= self.planes[plane][slot]
        return found

    def false_positives(self) -> np.ndarray:
        """For each language, the chance that an n-gram it lacks is found."""
        one = self.planes.dtype.type(1)
        per = 8 * self.planes.itemsize
        return np.array([
            ((self.planes[i // per] >> self.planes.dtype.type(i % per)) & one).mean() ** PROBES for i in range(len(self.languages))
        ])

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        hits, grams = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for first, last in blocks(texts):
            points, starts = runs(texts[first:last])
            lengths = np.diff(np.r_[starts, len(points)])
            owner = np.repeat(np.arange(last - first), lengths)
            # An n-gram counts if it lies in its text and does not start or end beyond a word's mark.
            left = np.repeat(starts + lengths, lengths) - np.arange(len(points))
            for n, hashes in gram_hashes(points):
                inside = np.flatnonzero(left[: len(hashes)] >= n)
                hashes, of = hashes[inside], owner[inside]
                grams[first:last] += np.bincount(of, minlength=last - first)
                per = 8 * self.planes.itemsize
                for plane in range(len(self.planes)):
                    masks = self.masks(hashes, plane)
                    for i in range(plane * per, min(len(self.languages), (plane + 1) * per)):
                        has = (masks >> masks.dtype.type(i % per)) & masks.dtype.type(1)
                        hits[first:last, i] += np.bincount(of, weights=has, minlength=last - first)
        known = [bool(t) and any(map(str.isalpha, t)) for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        wrong = np.minimum(self.false_positives(), 0.999)
        corrected = (hits - grams[:, None] * wrong) / (1 - wrong)
        best = corrected.argmax(axis=1)
        score = np.clip(corrected[np.arange(len(texts)), best] / np.maximum(grams, 1), 0, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``CHUNK`` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def learn(rows: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> Filter:
    """The filter learned from the labelled ``rows``."""
    ship_package(rows.sparkSession)
    known = rows.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # One row per language: what the mask's bits stand for.
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Filter([], np.zeros((1, 2), np.uint8))
    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, sample / sizes[lang])).otherwise(share)
    picked = known.where(chance < share).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for first, last in blocks(mine):
                    points, starts = runs(mine[first:last])
                    left = np.repeat(np.r_[starts[1:], len(points)], np.diff(np.r_[starts, len(points)])) - np.arange(len(points))
                    for n, hashes in gram_hashes(points):
                        grams, counts = np.unique(hashes[left[: len(hashes)] >= n], return_counts=True)
                        yield pa.record_batch(
                            [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(np.full(len(grams), n)), pa.array(counts)],
                            ["lang", "gram", "n", "count"],
                        )

    counts = picked.mapInArrow(counted, "lang string, gram long, n long, count long")
    counts = counts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))
    totals = counts.groupBy("lang", "n").agg(F.sum("count").alias("total"))
    shares = counts.join(F.broadcast(totals), ["lang", "n"]).withColumn("share", F.col("count") / F.col("total"))
    most = F.max("share").over(Window.partitionBy("n", "gram"))
    entries = shares.withColumn("most", most).where((F.col("count") >= LEAST) & (F.col("share") >= SHARE * F.col("most")))
    table = entries.select("lang", "gram").toArrow()  # n-grams of the bounded sample
    number = {lang: i for i, lang in enumerate(languages)}
    bit = np.array([number[x] for x in table["lang"].to_pylist()], np.int64)
    grams = table["gram"].to_numpy().view(np.uint64)
    size = 1 << max(10, (SLOTS_PER_GRAM * max(1, len(np.unique(grams))) - 1).bit_length())
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * k().itemsize or k is np.uint64)
    per = 8 * kind().itemsize
    made = Filter(languages, np.zeros((-(-len(languages) // per), size), kind))
    for slot in made.slots(grams):
        for i in range(len(languages)):
            made.planes[i // per][slot[bit == i]] |= kind(1 << i % per)
    return made


def language(text: Column, filter_: Filter) -> Column:
    """``struct<lang, score>`` of a text."""

    @F.pandas_udf("lang string, score double")
    def decided(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = filter_.decide([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang": langs, "score": scores})
        give_back()

    return decided(text)


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id as text, modulo the folds, is 0 (false for a null id)."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``id, held_out, lang, score`` for every row, learned from the rows that are not held out."""
    filter_ = learn(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col, sample)
    found = docs.select(
        F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), language(F.col(text_col), filter_).alias("found")
    )
    return found.select("id", "held_out", "found.lang", "found.score")


def known_language(docs: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a score of ``least`` or more."""
    filter_ = learn(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.select(row.alias("row"), language(F.col(text_col), filter_).alias("found"))
    return found.where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least)).select("row.*")
