"""Listing messages: record ↔ JSON text.

``encode`` is the producer's data step (NaN → null, ISO stamp, JSON with nulls
kept); ``parse`` is the bronze step (PERMISSIVE ``from_json`` under the fixed
message schema, struct flattened, broker time and load time attached).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from estatelake.functions.timefmt import iso_stamp
from estatelake.schemas import MESSAGE, MESSAGE_FIELDS

# to_json options: keep ``"field": null`` instead of omitting the field.
JSON_WRITE_OPTIONS = {"ignoreNullFields": "false"}

INT_FIELDS = ("rooms", "floor", "total_floors")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN → NULL on every floating column (JSON has no NaN)."""
    cols = {
        f.name: F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (DoubleType, FloatType))
    }
    return df.withColumns(cols) if cols else df


def encode(
    records: DataFrame, stamp: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Records with the message fields → one ``value`` string column of JSON.

    ``current_timestamp`` is the producer's ISO-8601 UTC send time unless the
    records already carry one.  Extra columns are not sent; ``keep`` carries
    some of them along next to ``value``.
    """
    df = nan_to_null(records)
    if "current_timestamp" not in df.columns:
        df = df.withColumn("current_timestamp", iso_stamp(stamp))
    payload = F.struct(*[F.col(c) for c in MESSAGE_FIELDS])
    return df.select(F.to_json(payload, JSON_WRITE_OPTIONS).alias("value"), *keep)


def parse(
    raw: DataFrame,
    value_col: str = "value",
    time_col: str | None = "timestamp",
    lenient_ints: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw messages → bronze rows.

    ``value_col`` may be binary (Kafka) or text; it is read as UTF-8.  Malformed
    text gives a row of NULLs (kept, as the reference keeps it); a wrong-typed
    field gives NULL for that field only.  ``lenient_ints`` accepts ``2.0`` for
    the integer fields (parsed as double, then cast), which is what a pandas
    producer sends for an integer column with gaps.  ``keep`` carries raw
    columns along.
    """
    schema = MESSAGE
    if lenient_ints:
        schema = StructType(
            [
                StructField(f.name, DoubleType(), True) if f.name in INT_FIELDS else f
                for f in MESSAGE.fields
            ]
        )
    text = F.col(value_col).cast("string")
    broker_time = F.col(time_col) if time_col else F.lit(None).cast("timestamp")
    out = raw.select(
        F.from_json(text, schema).alias("data"),
        broker_time.alias("kafka_timestamp"),
        *[F.col(c) for c in keep],
    ).select("data.*", "kafka_timestamp", *keep)
    if lenient_ints:
        out = out.withColumns(
            {c: F.col(c).try_cast("int") for c in INT_FIELDS}
        )
    return out.withColumn("bronze_loaded_at", F.current_timestamp())
