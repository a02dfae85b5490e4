"""Driver tables -> persons / auctions / bids (the test bindings).

`events` rows become the three event streams; `orders` / `lineitem` give a
larger auction / bid volume.  Every column is a deterministic function of one
input row, so the bindings are narrow projections: Catalyst prunes the scan
to the columns used and pushes the `event_type` filter into Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auctionflow.functions.time import epoch_ms

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ingestion_delay(event_id: Column) -> Column:
    """0-24 h pseudo-random ingestion delay, so latest-by-ingestion differs
    from latest-by-event-time."""
    return F.pmod(event_id * F.lit(7919), F.lit(25)) * F.lit(HOUR_MS)


def _events(spark: SparkSession | DataFrame, sf_dir: str | None, types: list[str]) -> DataFrame:
    """``spark, sf_dir`` reads the events table; a DataFrame (batch or
    stream) of the events schema may be passed instead as ``spark``."""
    ev = spark if isinstance(spark, DataFrame) else table(spark, sf_dir, "events")
    ev = ev.where(F.col("event_type").isin(types))
    return ev.select(
        "event_id",
        epoch_ms("ts").alias("ts"),
        (F.col("user_id") + 1).alias("person_id"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "value",
    )


def persons(spark: SparkSession | DataFrame, sf_dir: str | None = None) -> DataFrame:
    e = _events(spark, sf_dir, ["signup"])
    first = F.concat(F.lit("F"), F.col("person_id").cast("string"))
    last = F.concat(F.lit("L"), F.col("k").cast("string"))
    email = F.concat(first, F.lit("."), last, F.lit("@mail"), F.pmod("k", F.lit(7)).cast("string"), F.lit(".com"))
    return e.select(
        "ts",
        "person_id",
        F.concat(first, F.lit(" "), last).alias("name"),
        email.alias("email"),
        F.concat(F.lit("city"), F.pmod("k", F.lit(13)).cast("string")).alias("city"),
        F.concat(F.lit("country"), F.pmod("person_id", F.lit(5)).cast("string")).alias("country"),
        (F.pmod("event_id", F.lit(1000)) - 500).cast("string").alias("province"),
        F.pmod("event_id", F.lit(97)).cast("string").alias("zipcode"),
        email.alias("homepage"),
        (F.col("event_id") * 1_000_003).cast("string").alias("creditcard"),
        (F.col("ts") + ingestion_delay(F.col("event_id"))).alias("ingestion_ts"),
    )


def auctions(spark: SparkSession | DataFrame, sf_dir: str | None = None) -> DataFrame:
    e = _events(spark, sf_dir, ["view"])
    return e.select(
        "ts",
        F.col("k").alias("auction_id"),
        "person_id",
        F.col("event_id").alias("item_id"),
        F.col("value").alias("initial_price"),
        F.col("ts").alias("start"),
        (F.col("ts") + DAY_MS).alias("end"),
        F.pmod("event_id", F.lit(10)).alias("category_id"),
        (F.col("ts") + ingestion_delay(F.col("event_id"))).alias("ingestion_ts"),
        F.concat(F.lit("item"), F.col("k").cast("string")).alias("name"),
        F.concat(F.lit("auction "), F.col("event_id").cast("string")).alias("descr"),
    )


def bids(spark: SparkSession | DataFrame, sf_dir: str | None = None) -> DataFrame:
    e = _events(spark, sf_dir, ["click", "purchase"])
    return e.select(
        (F.col("ts") + ingestion_delay(F.col("event_id"))).alias("ingestion_ts"),
        "ts",
        F.col("k").alias("auction_id"),
        "person_id",
        F.col("event_id").alias("bid_id"),
        F.col("value").alias("bid"),
    )


def volume_auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ts = epoch_ms("o_orderdate")
    return o.select(
        ts.alias("ts"),
        F.col("o_orderkey").alias("auction_id"),
        (F.col("o_custkey") + 1).alias("person_id"),
        F.col("o_orderkey").alias("item_id"),
        F.col("o_totalprice").alias("initial_price"),
        ts.alias("start"),
        (ts + 365 * DAY_MS).alias("end"),
        F.pmod("o_orderkey", F.lit(10)).alias("category_id"),
        (ts + ingestion_delay(F.col("o_orderkey"))).alias("ingestion_ts"),
        F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("descr"),
    )


def volume_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ts = epoch_ms("l_shipdate")
    bid_id = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        (ts + ingestion_delay(bid_id)).alias("ingestion_ts"),
        ts.alias("ts"),
        F.col("l_orderkey").alias("auction_id"),
        (F.col("l_suppkey") + 1).alias("person_id"),
        bid_id.alias("bid_id"),
        F.col("l_extendedprice").alias("bid"),
    )


def person_wire_fields(spark: SparkSession | DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Raw person page fields whose decoding (with padding stripped) equals
    :func:`persons` except for the ingestion time."""
    e = _events(spark, sf_dir, ["signup"])
    return e.select(
        "person_id",
        F.concat(F.lit("F"), F.col("person_id").cast("string")).alias("first"),
        F.concat(F.lit("L"), F.col("k").cast("string")).alias("last"),
        F.concat(F.lit("mail"), F.pmod("k", F.lit(7)).cast("string"), F.lit(".com")).alias("domain"),
        F.concat(F.lit("city"), F.pmod("k", F.lit(13)).cast("string")).alias("city"),
        F.concat(F.lit("country"), F.pmod("person_id", F.lit(5)).cast("string")).alias("country"),
        (F.col("event_id") * 1_000_003).alias("card0"),
        F.lit(0).cast("long").alias("card1"),
        (F.pmod("event_id", F.lit(1000)) - 500).cast("int").alias("a"),
        F.pmod("event_id", F.lit(97)).cast("int").alias("b"),
        F.lit(0).cast("int").alias("c"),
        F.pmod("event_id", F.lit(2)).cast("short").alias("sex"),
        "ts",
    )
