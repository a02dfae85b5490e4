"""Bids of an auction cut into consecutive chunks of ``size`` (32) in
arrival order, as the reference stages them before writing state.

Row numbers per auction come from :func:`plans.ordered.sequence_numbers`,
so a hot auction is numbered in parallel time slices; the per-chunk summary
is a partial aggregate.  Chunks are bounded (``size`` rows) by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, sequence_numbers

BID_ORDER = ["ts", "ingestion_ts", "bid_id"]


def bid_chunks(bids: DataFrame, size: int = 32, rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """``auction_id, chunk, bid_count, first_ts, last_ts, last_ingestion_ts,
    max_price`` per chunk (the last chunk of an auction may be partial)."""
    if size < 1:
        raise ValueError("chunk size must be >= 1")
    b = bids.select("auction_id", *BID_ORDER, "bid")
    numbered = sequence_numbers(b, ["auction_id"], BID_ORDER, out="_seq", rows_per_slice=rows_per_slice)
    return (numbered.groupBy("auction_id", F.expr(f"(_seq - 1) div {int(size)}").alias("chunk"))
                    .agg(F.count(F.lit(1)).alias("bid_count"), F.min("ts").alias("first_ts"),
                         F.max("ts").alias("last_ts"), F.max("ingestion_ts").alias("last_ingestion_ts"),
                         F.max("bid").alias("max_price")))
