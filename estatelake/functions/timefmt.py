"""Strict timestamp parsing and the producer's ISO-8601 stamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelake.schemas import TS_FORMAT

# ISO-8601 with microseconds and the numeric offset of UTC.
ISO_STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_STAMP_UTC = "+00:00"


def parse_published_at(c: str | Column, fmt: str = TS_FORMAT) -> Column:
    """Text → timestamp in exactly ``fmt``; any other text (or an impossible date) → NULL."""
    x = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(x, F.lit(fmt))


def iso_stamp(ts: Column | None = None) -> Column:
    """ISO-8601 UTC text of ``ts`` (default: the batch's ``current_timestamp()``), whatever zone the session is in."""
    at = ts if ts is not None else F.current_timestamp()
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
    return F.concat(F.date_format(utc, ISO_STAMP_FORMAT), F.lit(ISO_STAMP_UTC))
