"""Batch file and JDBC readers, always with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from estatelake.schemas import BRONZE, MART_TABLES, SILVER, ddl
from estatelake.sinks import versions
from estatelake.sinks.compaction import silver_rows


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a declared schema (no inference pass over the data), by column name.

    The header says where each declared column stands; columns it has beside
    the declared ones are left out, and a declared column that is missing is an error.
    Every file must have the same header (``enforceSchema=false`` checks each one).
    Quotes inside a quoted field are doubled.  ``multiline`` allows line breaks in
    quoted fields; such files cannot be split, so each is read by one task.
    Without a header the declared order counts.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    options = {"escape": '"', "multiLine": str(multiline).lower(), "header": str(header).lower()}
    if not header:
        return spark.read.options(**options).schema(wanted).csv(path)
    names = spark.read.options(**options).csv(path).columns  # reads the first line only
    missing = [f.name for f in wanted.fields if f.name not in names]
    if missing:
        raise ValueError(f"the CSV header lacks {', '.join(missing)}")
    types = {f.name: f.dataType for f in wanted.fields}
    placed = StructType([StructField(n, types.get(n, StringType()), True) for n in names])
    rows = spark.read.options(enforceSchema="false", **options).schema(placed).csv(path)
    return rows.select(*[f"`{f.name}`" for f in wanted.fields])


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned silver with the declared schema.

    An inferred read would turn district values such as ``'1'`` or ``'02'`` into
    integers; the explicit schema keeps them strings.  ``WHERE district = ...``
    on the result prunes partitions.
    """
    return silver_rows(spark, path, ddl(SILVER))


def read_mart(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    """A stored mart, of the version that was written whole last: all marts come from one run."""
    version = versions.current(spark, gold_path)
    if version is None:
        raise ValueError(f"no marts have been written to {gold_path} yet")
    return spark.read.schema(MART_TABLES[name]).parquet(f"{version}/{name}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A table (or ``(subquery) alias``) over JDBC.

    A mart is small and is read through one connection.  For a large table,
    ``column`` with bounds and ``num_partitions`` splits the read into that many
    range queries run in parallel (the bounds only set the stride; no row is
    left out).
    """
    if column is not None:
        return spark.read.jdbc(
            url=url, table=table, column=column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=properties or {},
        )
    return spark.read.jdbc(url=url, table=table, properties=properties or {})
