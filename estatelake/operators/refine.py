"""Silver refinement: dedup → null filter → cast → derive (in that order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.exact import round2, safe_ratio
from estatelake.functions.timefmt import parse_published_at
from estatelake.schemas import CRITICAL, DEDUP_KEY, SILVER

# Casts of the numeric message fields (no-ops on typed bronze, real on text input).
NUMERIC_TYPES = {
    "price": "double",
    "area": "double",
    "rooms": "int",
    "floor": "int",
    "total_floors": "int",
}


def key_hash(rows: DataFrame, key: Sequence[str], salt: str) -> Column:
    """64 bits of the hash of a key: NULL differs from '', signed zeros are one."""
    parts = []
    for c in key:
        value = F.col(c)
        if dict(rows.dtypes)[c] == "double":
            value = F.when(value == 0.0, F.lit(0.0)).otherwise(value)
        parts += [value.isNull(), value]
    return F.xxhash64(F.lit(salt), *parts)


def deduplicate(
    df: DataFrame,
    key: Sequence[str] = DEDUP_KEY,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per ``key`` (NULLs equal, NaNs equal, -0.0 = 0.0).

    ``order_by=None`` keeps an arbitrary survivor (``dropDuplicates``; columns that are not read later are
    not carried).  With ``order_by`` the survivor is the smallest row
    under ``order_by`` and then every remaining column, NULLs first: a total order, so the result does
    not depend on partitioning or retries.  Either is an aggregate with a partial one before the
    shuffle, so a key that holds a third of all rows still reaches the reducer as one row per map task.

    With ``order_by`` rows are grouped by fixed-width values only: text columns of the key stand as 128 bits of
    their hash, so the sorts of the aggregate compare numbers, and the row travels as one struct beside them.  The
    other columns of the key stay as they are, so that filters on them still move below the aggregate.
    """
    key = list(key)
    if order_by is None:
        return df.dropDuplicates(key)
    kinds = dict(df.dtypes)
    texts = [c for c in key if kinds[c] in ("string", "binary")]
    hashes = [f"_key_{i}" for i in (1, 2)] if texts else []
    fixed = [c for c in key if c not in texts]
    rest = [c for c in df.columns if c not in key]
    order = [c for c in order_by if c not in key] + [c for c in rest if c not in order_by] + texts
    if not order:
        return df.dropDuplicates(key)
    row = F.struct(*[F.col(f"`{c}`") for c in order])
    hashed = df.withColumns({name: key_hash(df, texts, name) for name in hashes})
    picked = hashed.groupBy(*hashes, *fixed).agg(F.min(row).alias("_survivor"))
    return picked.select(
        *fixed, *[F.col("_survivor").getField(c).alias(c) for c in order]
    ).select(*df.columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``columns`` (as ``dropna(how='any')``).

    Written as ``isNotNull & ~isnan`` so that the ``IsNotNull`` part reaches the
    Parquet scan as a pushed filter; ``dropna`` itself is not source-pushable.
    """
    cond = None
    for c in columns:
        term = F.col(c).isNotNull() & ~F.isnan(F.col(c))
        cond = term if cond is None else cond & term
    return df.where(cond)


def normalize_types(df: DataFrame) -> DataFrame:
    """Numeric casts (``try_cast``: bad text → NULL) and strict timestamp parse."""
    cols = {c: F.col(c).try_cast(t) for c, t in NUMERIC_TYPES.items()}
    cols["published_at"] = parse_published_at("published_at")
    # '' cannot survive a partitioned write (it comes back NULL), so make it NULL now.
    cols["district"] = F.when(F.col("district") == "", F.lit(None)).otherwise(F.col("district"))
    return df.withColumns(cols)


def derive(df: DataFrame) -> DataFrame:
    """``price_per_sqm = round(price / area, 2)``; zero area → NULL, not a failure."""
    return df.withColumns(
        {
            "price_per_sqm": round2(safe_ratio("price", "area")),
            "silver_loaded_at": F.current_timestamp(),
        }
    )


def refine(
    bronze: DataFrame,
    order_by: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bronze → silver.  Returns the silver columns (district last) plus ``keep``.

    Dedup runs on the raw text of ``published_at`` (two spellings of one instant
    stay two rows).  Because ``price`` and ``area`` are dedup keys, Catalyst moves
    the null filter below the aggregate, so invalid rows never reach the shuffle.
    """
    df = deduplicate(bronze, DEDUP_KEY, order_by)
    df = drop_incomplete(df, CRITICAL)
    df = derive(normalize_types(df))
    return df.select(*[f.name for f in SILVER.fields], *keep)
