"""Helpers shared by the operators: words, gram postings, cut lineage, checked broadcasts."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.session import shared_root

# Fixed value of the word contract: everything that is neither 0-9, a-z (after lowering) nor beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The largest table that `small` broadcasts, in rows; every caller broadcasts rows of at most a few hundred bytes.
BROADCAST_ROWS = 200_000


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else (``lower`` would change other alphabets too)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text, in order; a null or wordless text has an empty array."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def gram_postings(
    docs: DataFrame, id_col: str, text_col: str, grams: DataFrame, lengths: Sequence[int]
) -> DataFrame:
    """Places of known word grams in every whole text, in one pass over the texts.

    ``grams``: one row per known gram, in column ``gram`` (words joined by one
    space) plus any columns to carry.  ``lengths``: the gram lengths that occur.
    Every rolling gram of those lengths is joined; only known ones are kept.

    Returns ``doc, text_hash, n_words, pos, gram, ...``.  ``doc, text_hash`` tells rows
    apart that repeat an id.  Each input row also gives one row with ``pos = -1``
    and a null ``gram``, so that texts without any known gram stay visible.
    """
    base = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        words(F.col(text_col)).alias("w"),
    ).withColumn("n_words", F.size("w"))

    def rolling(k: int, count: Column) -> Column:
        rest = lambda i: [F.get(F.col("w"), i + j) for j in range(1, k)]
        return F.transform(F.slice("w", F.lit(1), count), lambda x, i: F.concat_ws(" ", x, *rest(i)))

    runs, starts, at = [F.array(F.lit(""))], [], F.lit(1)
    for k in lengths:
        count = F.greatest(F.col("n_words") - (k - 1), F.lit(0))
        starts.append((at, count))
        at = at + count
        runs.append(rolling(k, count))
    rolled = base.select("doc", "text_hash", "n_words", F.posexplode(F.concat(*runs)).alias("at", "rolled"))
    pos = F.lit(-1)
    for first, count in starts:
        pos = F.when((F.col("at") >= first) & (F.col("at") < first + count), F.col("at") - first).otherwise(pos)
    placed = rolled.withColumn("pos", pos.cast("int")).drop("at")
    joined = placed.join(grams, placed["rolled"] == grams["gram"], "left")
    return joined.where(F.col("gram").isNotNull() | (F.col("pos") == -1)).drop("rolled")


def tuples(batch: pa.RecordBatch, step: int = 64) -> Iterator[tuple]:
    """The rows of a batch, turned into Python objects a few at a time."""
    for at in range(0, batch.num_rows, step):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns), strict=True)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
