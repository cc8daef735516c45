"""Random row samples.

``bernoulli_sample`` is Spark's ``sample``: each row is kept with probability
``fraction``; the size varies around ``n * fraction``.  ``exact_sample`` keeps
exactly ``round(n * fraction)`` rows (what a pandas ``sample(frac=...)`` gives)
without sorting the data or limiting it through one task:

1. every row gets a 64-bit hash of (seed, unique key), the same on any retry; without a unique key
   the rows are written to the shared checkpoint folder first and hashed by their place there, so that
   repeated rows are drawn one by one like all others;
2. the k-th smallest hash is found by radix selection: at most four passes,
   each a partial-aggregated histogram of the next 16 bits of the hash among
   rows that share the prefix chosen so far (at most 65,536 rows come back per
   pass, a fixed bound whatever the data size);
3. the sample is a filter ``hash <= threshold`` evaluated on all partitions in
   parallel.  Rows that share the threshold hash exactly (a 64-bit collision, or a key that was not
   unique) are counted per task, and each task keeps its share of those still needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.session import shared_root

DIGIT_BITS = 16
PASSES = 64 // DIGIT_BITS
DIGIT_MASK = (1 << DIGIT_BITS) - 1


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_size(n: int, fraction: float) -> int:
    """``round(n * fraction)`` with Python's rounding, as pandas does."""
    return int(round(n * fraction))


def _some_of(rows: DataFrame, need: int) -> DataFrame:
    """``need`` of the rows: the first ones of the first tasks, by a count per task; no task gets rows of another."""
    shared_root(rows.sparkSession)
    held = rows.checkpoint().withColumn("_at", F.monotonically_increasing_id())
    held = held.withColumns({"_task": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    last = 0
    for last, n in sorted((r["_task"], r["n"]) for r in held.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect()):
        if need <= n:
            break
        need -= n
    return held.where((F.col("_task") < last) | ((F.col("_task") == last) & (F.col("_at") < need))).drop("_at", "_task")


def exact_sample(
    df: DataFrame,
    fraction: float,
    key: Sequence[str] | None,
    seed: int = 0,
) -> DataFrame:
    """Exactly ``round(n * fraction)`` rows, each row as likely as any other.

    ``key`` identifies a row (the sample is then the same for any partitioning); ``None`` says that nothing does: rows may repeat.
    """
    h = F.col("_h")
    if key is None:
        shared_root(df.sparkSession)
        df = df.checkpoint()
        identity = [F.monotonically_increasing_id()]
    else:
        identity = [F.col(c) for c in key]
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), *identity))
    prefix = 0  # value of the chosen high bits, as an arithmetic right shift of h
    below = 0  # rows whose hash prefix is smaller than the chosen one
    k = None
    for level in range(PASSES):
        shift = 64 - DIGIT_BITS * (level + 1)
        top = F.shiftright(h, shift)  # high bits in signed order
        scope = hashed if level == 0 else hashed.where(F.shiftright(h, shift + DIGIT_BITS) == F.lit(prefix))
        hist = sorted(
            (r["d"], r["c"])
            for r in scope.groupBy(top.alias("d")).agg(F.count(F.lit(1)).alias("c")).collect()
        )
        if k is None:
            n = sum(c for _, c in hist)
            k = sample_size(n, fraction)
            if k <= 0:
                return hashed.where(F.lit(False)).drop("_h")
            if k >= n:
                return hashed.drop("_h")
        need = k - below
        for d, c in hist:
            if need <= c:
                break
            need -= c
            below += c
        prefix = d
        if need == c:  # the whole bucket completes the sample
            return hashed.where(top <= F.lit(prefix)).drop("_h")
    # 64 bits fixed and several rows share this exact hash: any ``need`` of them.
    threshold = prefix
    ties = _some_of(hashed.where(h == F.lit(threshold)), need)
    return hashed.where(h < F.lit(threshold)).unionByName(ties).drop("_h")
