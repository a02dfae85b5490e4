"""Skew benchmark: one auction holds a third of all bids.

usage: python tools/skew_bench.py [rows] [cpus] [operator ...]
Runs the ordered operators with slicing off (rows_per_slice above the hot
key's size: one task owns the hot key) and on, and prints one JSON line of
seconds per operator.  Data is generated with ``spark.range`` (nothing is
written).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from auctionflow.operators import chunks, rounds, sampling, sessions  # noqa: E402
from auctionflow.session import local_session  # noqa: E402


def skewed_bids(spark, n: int):
    r = spark.range(n)
    hot = (F.col("id") % 3) == 0
    return r.select(
        (F.col("id") * 1000 + F.lit(1_704_067_200_000)).alias("ingestion_ts"),
        (F.col("id") * 1000 + F.lit(1_704_067_200_000)).alias("ts"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 50_000 + 100).alias("auction_id"),
        (F.col("id") % 9973).alias("person_id"),
        F.col("id").alias("bid_id"),
        (F.col("id") % 1000).cast("double").alias("bid"))


def timed(fn):
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 2)


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = local_session(cpus, int(cpus), app="skew-bench", extra={"spark.driver.memory": "8g"})
    bids = skewed_bids(spark, n)
    off, on = n, max(n // 48, 1000)
    ops = {
        "bid_chunks": lambda r: chunks.bid_chunks(bids, 32, rows_per_slice=r),
        "sample_every_per_auction": lambda r: sampling.sample_every(bids, 1000, ["ts", "bid_id"], "auction_id", 1,
                                                                   rows_per_slice=r),
        "bidder_sessions_1s_gap": lambda r: sessions.bidder_sessions(
            bids.withColumn("person_id", F.when(F.col("auction_id") == 7, F.lit(1)).otherwise(F.col("person_id"))),
            1_000, rows_per_slice=r),
        "last_bids_per_round": lambda r: rounds.last_bids_per_round(
            bids, bids.select("ts", "auction_id", "person_id", F.col("bid_id").alias("item_id"), "ingestion_ts",
                              (F.col("ts") + 600_000).alias("end")).where(F.col("bid_id") % 500 == 0),
            rows_per_slice=r),
        # a third of the bids are candidates of one key; rounds of fixed length whose phases never meet
        "bid_rounds": lambda r: rounds.bid_rounds(bids, 3_600_000, rows_per_slice=r, chain_rows=r),
    }
    only = sys.argv[3:]
    ops = {k: f for k, f in ops.items() if not only or k in only}
    timed(lambda: bids)
    out = {}
    for name, fn in ops.items():
        out[name] = {"one_task_hot_key": timed(lambda: fn(off)), "sliced": timed(lambda: fn(on))}
    print(json.dumps({"rows": n, "hot_share": 1 / 3, "cpus": int(cpus), "seconds": out}))


if __name__ == "__main__":
    main()
