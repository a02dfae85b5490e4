"""Deterministic event generators.

The reference draws from an unseeded thread-local random source and stamps
wall-clock times.  Here every value is a function of (subtask, event counter
``e``, seed) through :func:`functions.hashing.portable_hash`, so runs repeat
exactly, any slice can be regenerated on any executor (no driver state), and
DuckDB can recompute the same rows.

Id arithmetic follows the reference: ratios person:auction:bid = 1:4:4
(9 events per epoch), ``epoch = e div 9``, ``offset = e % 9``; per-subtask
id ranges start at ``subtask * 10_800_000`` (persons) and
``subtask * 10_800_000_000`` (auctions), at most 50 subtasks; 14 % of sellers,
bidders and auctions are "hot".  Times are ``base_ms + e * 1000 div
rows_per_second``.

Counters come from ``spark.range`` (batch), the ``rate`` source (stream) or
any DataFrame with ``subtask`` and ``e`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auctionflow.functions.hashing import portable_hash

# Fixed generator constants (id layout and hot-key rules of the workload).
MAX_SUBTASKS = 50
PERSON_STRIDE = 540_000_000 // MAX_SUBTASKS
AUCTION_STRIDE = 540_000_000_000 // MAX_SUBTASKS
EVENTS_PER_EPOCH = 9
AUCTIONS_PER_EPOCH = 4
HOT_PERCENT_ABOVE = 85
HOT_RATIO = 100
ACTIVE_SELLERS = 20_000
ACTIVE_BIDDERS = 60_000
ACTIVE_AUCTIONS = 20_000
AUCTION_LENGTH_MS = 10_000
MINI_BATCH = 5
TEXT_POOL = 2_000

DEFAULT_BASE_MS = 1_704_067_200_000
DEFAULT_RATE = 1_000

# Short value dictionaries of our own (the workload only needs plausible text).
CITIES = ["Springfield", "Riverton", "Lakeside", "Fairview", "Greenville", "Oakdale", "Hillcrest",
          "Brookfield", "Maplewood", "Cedar Falls", "Ashford", "Kingsport"]
COUNTRIES = ["Atlantis", "Borduria", "Freedonia", "Genovia", "Latveria", "Elbonia", "Ruritania", "Syldavia"]
DOMAINS = ["example.com", "example.org", "example.net", "mail.test", "post.invalid", "inbox.example"]
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dara", "Eli", "Fay", "Gus", "Hana", "Ivo", "Jun", "Kai", "Lia",
               "Milo", "Nia", "Oto", "Pia"]
LAST_NAMES = ["Abbott", "Baker", "Cole", "Dunn", "Ellis", "Frost", "Grant", "Hale", "Irwin", "Joyce",
              "Keane", "Lowe", "Moss", "Noble", "Orr", "Pike"]


def counters(spark: SparkSession, n_per_subtask: int, subtasks: int = 1) -> DataFrame:
    """(subtask, e) for e in [0, n rounded up to a multiple of 5)."""
    check_subtasks(subtasks)
    n = -(-n_per_subtask // MINI_BATCH) * MINI_BATCH
    r = spark.range(0, n * subtasks)
    return r.select(F.pmod("id", F.lit(subtasks)).cast("int").alias("subtask"),
                    F.expr(f"id div {subtasks}").alias("e"))


def stream_counters(spark: SparkSession, rows_per_second: int, subtasks: int = 1) -> DataFrame:
    """Streaming counters from the ``rate`` source (S18 pacing)."""
    check_subtasks(subtasks)
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return r.select(F.pmod("value", F.lit(subtasks)).cast("int").alias("subtask"),
                    F.expr(f"value div {subtasks}").alias("e"))


def check_subtasks(subtasks: int) -> None:
    if not 1 <= subtasks <= MAX_SUBTASKS:
        raise ValueError(f"subtasks must be in [1, {MAX_SUBTASKS}]")


def _rand(seed: int, salt: int) -> Column:
    return portable_hash(F.col("e") * 64 + F.col("subtask") + F.lit(seed * 7919), salt)


def _pick(values: list[str], r: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (r % len(values) + 1).cast("int"))


def _common(c: DataFrame, base_ms: int, rate: int) -> DataFrame:
    return c.select("subtask", "e",
                    F.expr("e div 9").alias("epoch"), F.expr("e % 9").alias("offset"),
                    (F.col("subtask").cast("long") * PERSON_STRIDE).alias("min_person"),
                    (F.col("subtask").cast("long") * AUCTION_STRIDE).alias("min_auction"),
                    (F.lit(base_ms) + F.expr(f"(e * 1000) div {int(rate)}")).alias("ts"))


def generate_persons(c: DataFrame, seed: int = 42, base_ms: int = DEFAULT_BASE_MS,
                     rows_per_second: int = DEFAULT_RATE) -> DataFrame:
    """``person_id = min_person + epoch`` (each id 9 times); e-mail and
    province hold a domain, homepage a first name, creditcard a constant."""
    g = _common(c, base_ms, rows_per_second)
    return g.select(
        "ts",
        (F.col("min_person") + F.col("epoch")).alias("person_id"),
        F.concat(_pick(FIRST_NAMES, _rand(seed, 4)), F.lit(" "), _pick(LAST_NAMES, _rand(seed, 5))).alias("name"),
        _pick(DOMAINS, _rand(seed, 3)).alias("email"),
        _pick(CITIES, _rand(seed, 1)).alias("city"),
        _pick(COUNTRIES, _rand(seed, 2)).alias("country"),
        _pick(DOMAINS, _rand(seed, 6)).alias("province"),
        F.lit(None).cast("string").alias("zipcode"),
        _pick(FIRST_NAMES, _rand(seed, 7)).alias("homepage"),
        F.lit("00000000000").alias("creditcard"),
        F.col("ts").alias("ingestion_ts"),
    )


def text_pool(spark: SparkSession, width: int, seed: int = 42) -> DataFrame:
    """``TEXT_POOL`` strings of ``width`` letters a-z with about one
    space in 13 (no trailing NUL)."""
    def char(i: Column) -> Column:
        h = portable_hash(F.col("id") * 1024 + i + F.lit(seed * 7919 + width), 31)
        return F.when(h % 13 == 0, F.lit(" ")).otherwise(F.char((h % 26 + 97).cast("long")))
    return spark.range(TEXT_POOL).select(
        F.col("id").alias("_pool_id"),
        F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long")), char), "")
        .alias("_text"))


def generate_auctions(c: DataFrame, seed: int = 42, base_ms: int = DEFAULT_BASE_MS,
                      rows_per_second: int = DEFAULT_RATE) -> DataFrame:
    """``auction_id = min_auction + 4*epoch' + 3`` (epoch' = epoch - 1
    for the person slot), 14 % hot sellers; ``end = ts + 10 s``; item,
    price and category are 0.  Names and descriptions come from two
    2,000-string pools joined by broadcast (fixed size)."""
    spark = c.sparkSession
    g = _common(c, base_ms, rows_per_second)
    ep = F.when(F.col("offset") < 1, F.col("epoch") - 1).otherwise(F.col("epoch"))
    p = F.col("epoch") + 1
    active = F.least(p, F.lit(ACTIVE_SELLERS))
    cold = F.col("min_person") + p + active - _rand(seed, 12) % (active + 100)
    hot = F.col("min_person") + F.expr(f"epoch div {HOT_RATIO}") * HOT_RATIO
    a = g.select(
        "ts",
        (F.col("min_auction") + ep * AUCTIONS_PER_EPOCH + (AUCTIONS_PER_EPOCH - 1)).alias("auction_id"),
        F.when(_rand(seed, 11) % 100 > HOT_PERCENT_ABOVE, hot).otherwise(cold).alias("person_id"),
        (_rand(seed, 13) % TEXT_POOL).alias("_n20"), (_rand(seed, 14) % TEXT_POOL).alias("_n200"))
    p20 = F.broadcast(text_pool(spark, 20, seed).withColumnRenamed("_text", "name"))
    p200 = F.broadcast(text_pool(spark, 200, seed).withColumnRenamed("_text", "descr"))
    a = (a.join(p20, a["_n20"] == p20["_pool_id"]).drop("_pool_id")
          .join(p200, a["_n200"] == p200["_pool_id"]).drop("_pool_id"))
    return a.select("ts", "auction_id", "person_id", F.lit(0).cast("long").alias("item_id"),
                    F.lit(0.0).alias("initial_price"), F.col("ts").alias("start"),
                    (F.col("ts") + AUCTION_LENGTH_MS).alias("end"), F.lit(0).cast("long").alias("category_id"),
                    F.col("ts").alias("ingestion_ts"), "name", "descr")


def generate_bids(c: DataFrame, seed: int = 42, base_ms: int = DEFAULT_BASE_MS,
                  rows_per_second: int = DEFAULT_RATE) -> DataFrame:
    """14 % of bids go to hot auctions (``(4*epoch+3) div 100 * 100``),
    the rest to one of the last ~20,000 auctions; bidders alike with 60,000
    active; price uniform in [0, 10^7) with cents; ``bid_id = -1``."""
    g = _common(c, base_ms, rows_per_second)
    b = F.col("epoch") * AUCTIONS_PER_EPOCH + (AUCTIONS_PER_EPOCH - 1)
    lo = F.greatest(F.lit(0).cast("long"), b - ACTIVE_AUCTIONS)
    auction = F.when(_rand(seed, 21) % 100 > HOT_PERCENT_ABOVE, F.floor(b / HOT_RATIO).cast("long") * HOT_RATIO) \
               .otherwise(lo + _rand(seed, 22) % (b - lo + 101))
    active = F.least(F.col("epoch"), F.lit(ACTIVE_BIDDERS))
    bidder = F.when(_rand(seed, 23) % 100 > HOT_PERCENT_ABOVE,
                    F.col("min_person") + F.expr(f"epoch div {HOT_RATIO}") * HOT_RATIO) \
              .otherwise(F.col("min_person") + F.col("epoch") + active - _rand(seed, 24) % (active + 100))
    return g.select(F.col("ts").alias("ingestion_ts"), "ts",
                    F.abs(F.col("min_auction") + auction).alias("auction_id"),
                    F.abs(bidder).alias("person_id"), F.lit(-1).cast("long").alias("bid_id"),
                    ((_rand(seed, 25) % 1_000_000_000) / 100.0).alias("bid"))
