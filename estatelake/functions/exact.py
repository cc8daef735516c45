"""Numeric expressions whose results do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Six decimals are exact; 22 integer digits leave room for 10^10 such values in a sum of 38 digits.
EXACT = DecimalType(28, 6)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: str | Column) -> Column:
    """``round(x, 2)``: HALF_UP on the printed (shortest) decimal digits of the double."""
    return F.round(_col(c), 2)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` that gives NULL for a zero or NULL denominator instead of failing."""
    return F.try_divide(_col(num), _col(den))


def exact_parts(c: str | Column) -> dict[str, Column]:
    """What a row gives to ``exact_sums``: ``sum`` (decimal, where it fits), ``rest`` (double, where it does not) and ``n``, the value."""
    x = _col(c)
    fitting = x.try_cast(EXACT)
    return {"sum": fitting, "rest": F.when(fitting.isNull(), x), "n": x}


def sums_of_parts(parts: dict[str, Column]) -> dict[str, Column]:
    """``exact_sums`` of a column from its ``exact_parts``, which may have been made before (below an Expand, say)."""
    return {"sum": F.sum(parts["sum"]), "rest": F.sum(parts["rest"]), "n": F.count(parts["n"])}


def exact_sums(c: str | Column) -> dict[str, Column]:
    """The aggregates that an exact average is made of: ``sum`` (decimal), ``rest`` (double) and ``n``.

    They can be added up over any parts of the rows and in any order: ``merged_sums``.
    """
    return sums_of_parts(exact_parts(c))


def merged_sums(prefix: str) -> dict[str, Column]:
    """``exact_sums`` of the union of parts, from the columns ``prefix_sum``, ``prefix_rest``, ``prefix_n``."""
    return {k: F.sum(f"{prefix}_{k}") for k in ("sum", "rest", "n")}


def avg_of_sums(sums: dict[str, Column], digits: int = 2) -> Column:
    """The average that ``exact_sums`` stand for, rounded to ``digits``."""
    total = F.coalesce(sums["sum"].cast("double"), F.lit(0.0)) + F.coalesce(sums["rest"], F.lit(0.0))
    return F.round(F.try_divide(total, sums["n"].cast("double")), digits)


def exact_avg(c: str | Column, digits: int = 2) -> Column:
    """Average of ``c`` rounded to ``digits``, independent of partitioning below a magnitude of 10^22.

    ``avg(double)`` sums in whatever order the partial aggregates arrive, so the
    last bit (and sometimes the rounded cent) depends on the plan.  Values that
    fit ``EXACT`` are summed as decimals, at six decimals each; what does not fit (a
    magnitude of 10^22 or more, Infinity, NaN) is summed beside them as doubles, so that
    Infinity and NaN reach the average as they do in ``avg``; finite values of that size keep the
    order dependence of ``avg`` in their last bits.  Both buffers are
    hash-aggregatable, so map-side partial aggregation is kept.  NULLs are
    skipped as in ``avg``; an all-NULL group gives NULL.
    """
    return avg_of_sums(exact_sums(c), digits)
