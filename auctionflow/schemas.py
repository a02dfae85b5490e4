"""Record schemas (fixed; never inferred).  Times are epoch milliseconds."""

from pyspark.sql.types import (BinaryType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

PERSON = StructType([
    StructField("ts", LongType()),
    StructField("person_id", LongType()),
    StructField("name", StringType()),
    StructField("email", StringType()),
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("province", StringType()),
    StructField("zipcode", StringType()),
    StructField("homepage", StringType()),
    StructField("creditcard", StringType()),
    StructField("ingestion_ts", LongType()),
])

AUCTION = StructType([
    StructField("ts", LongType()),
    StructField("auction_id", LongType()),
    StructField("person_id", LongType()),
    StructField("item_id", LongType()),
    StructField("initial_price", DoubleType()),
    StructField("start", LongType()),
    StructField("end", LongType()),
    StructField("category_id", LongType()),
    StructField("ingestion_ts", LongType()),
    StructField("name", StringType()),
    StructField("descr", StringType()),
])

BID = StructType([
    StructField("ingestion_ts", LongType()),
    StructField("ts", LongType()),
    StructField("auction_id", LongType()),
    StructField("person_id", LongType()),
    StructField("bid_id", LongType()),
    StructField("bid", DoubleType()),
])

# Kafka source columns; page files written by this library use the same names.
PAGE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

NEW_USER_OUTPUT = ["window_evicting_ts", "person_creation_ts", "person_ingestion_ts",
                   "auction_creation_ts", "auction_ingestion_ts", "person_id"]

BID_STATS_OUTPUT = ["auction_id", "max_price", "last_ts", "last_ingestion_ts", "bid_count"]


def names(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]
