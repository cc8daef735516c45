"""Table contracts: message, bronze, silver and the three marts."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The message fields and their types, in message order.
MESSAGE = StructType(
    [
        StructField("price", DoubleType(), True),
        StructField("area", DoubleType(), True),
        StructField("rooms", IntegerType(), True),
        StructField("floor", IntegerType(), True),
        StructField("total_floors", IntegerType(), True),
        StructField("district", StringType(), True),
        StructField("address", StringType(), True),
        StructField("building_type", StringType(), True),
        StructField("published_at", StringType(), True),
        StructField("current_timestamp", StringType(), True),
    ]
)

MESSAGE_FIELDS = [f.name for f in MESSAGE.fields]

BRONZE = StructType(
    MESSAGE.fields
    + [
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("bronze_loaded_at", TimestampType(), True),
    ]
)

# The dedup key and the columns that must be present.
DEDUP_KEY = ["district", "address", "price", "area", "published_at"]
CRITICAL = ["price", "area"]

# Fixed value: the format of ``published_at``; anything else parses to NULL.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The columns of silver as written (district is the partition column and comes last on read).
SILVER = StructType(
    [
        StructField("price", DoubleType(), True),
        StructField("area", DoubleType(), True),
        StructField("rooms", IntegerType(), True),
        StructField("floor", IntegerType(), True),
        StructField("total_floors", IntegerType(), True),
        StructField("address", StringType(), True),
        StructField("building_type", StringType(), True),
        StructField("published_at", TimestampType(), True),
        StructField("current_timestamp", StringType(), True),
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("bronze_loaded_at", TimestampType(), True),
        StructField("price_per_sqm", DoubleType(), True),
        StructField("silver_loaded_at", TimestampType(), True),
        StructField("district", StringType(), True),
    ]
)

# A listing as its CSV has it: the message fields without the send stamp.
LISTING = StructType(MESSAGE.fields[:-1])

# The columns of the three marts.
MART_BY_DISTRICT = StructType(
    [
        StructField("district", StringType(), True),
        StructField("avg_price", DoubleType(), True),
        StructField("avg_price_per_sqm", DoubleType(), True),
        StructField("listing_count", LongType(), False),
    ]
)

MART_BY_DAY = StructType(
    [
        StructField("listing_date", DateType(), True),
        StructField("listings_count", LongType(), False),
        StructField("avg_price", DoubleType(), True),
        StructField("avg_price_per_sqm", DoubleType(), True),
    ]
)

MART_BY_ROOMS = StructType(
    [
        StructField("rooms", IntegerType(), True),
        StructField("avg_price", DoubleType(), True),
        StructField("avg_price_per_sqm", DoubleType(), True),
        StructField("avg_area_sqm", DoubleType(), True),
        StructField("listing_count", LongType(), False),
    ]
)

# Mart table names as the dashboard knows them.
MART_TABLES = {
    "mart_avg_price_by_district": MART_BY_DISTRICT,
    "mart_listings_by_day": MART_BY_DAY,
    "mart_avg_price_by_rooms": MART_BY_ROOMS,
}


def ddl(schema: StructType) -> str:
    """A schema as text, with names in quotes."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
