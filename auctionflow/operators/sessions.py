"""Session windows.

Batch: a session splits where two consecutive events of a key are more than
``gap`` apart (events exactly ``gap`` apart merge, as in Spark's
``session_window``).  Events are first reduced to buckets of width ``gap``:
any two events of one bucket are less than ``gap`` apart and so belong to the
same session.  The bucket reduction is a plain partial aggregation (map-side
combine), and the ordered pass then runs over at most one row per key and
bucket, so a hot key costs time-span / gap rows instead of its event count;
keys with more buckets than ``rows_per_slice`` are numbered in parallel
slices (:func:`session_ids`).

Streaming: ``session_window`` with a watermark (append mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.functions.time import from_event_time, ms_interval
from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, add_slices, placed
from auctionflow.session import ensure_checkpoint_dir


def gap_bucket(ts_col: str, gap_ms: int) -> Column:
    """floor(ts / gap), exact for negative times too."""
    return F.expr(f"({ts_col} - pmod({ts_col}, {int(gap_ms)})) div {int(gap_ms)}")


def session_ids(buckets: DataFrame, keys: list[str], gap_ms: int, lo: str = "_lo", hi: str = "_hi",
                rows_per_slice: int = DEFAULT_ROWS_PER_SLICE, at_most: DataFrame | int | None = None) -> DataFrame:
    """Number the sessions of a bucket table (one row per key and bucket with
    the min ``lo`` / max ``hi`` event time).  Adds ``_sid`` (per key).  Buckets
    without a key or time are dropped.

    A key with more than ``rows_per_slice`` buckets is cut into slices of
    buckets; each slice looks back within itself (``lag``) and, for its first
    bucket, to the latest end of the slices before it; session starts per
    slice become prefix offsets.  One join of a per-slice table."""
    if buckets.isStreaming:
        raise ValueError("use session_window on streams")
    buckets = placed(buckets, keys, "_bucket")
    sliced, any_hot = add_slices(buckets, keys, ["_bucket"], rows_per_slice, at_most=at_most)
    if not any_hot:
        w = Window.partitionBy(*keys).orderBy("_bucket")
        prev_hi = F.lag(hi).over(w)
        new = F.when(prev_hi.isNull() | ((F.col(lo) - prev_hi) > F.lit(gap_ms)), 1).otherwise(0)
        return (buckets.withColumn("_new", new)
                       .withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                       .drop("_new"))
    part = [*keys, "_slice"]
    w = Window.partitionBy(*part).orderBy("_bucket")
    loc = (sliced.withColumn("_prev", F.lag(hi).over(w))
                 .withColumn("_lnew", F.when(F.col("_prev").isNull(), 0)
                                      .when((F.col(lo) - F.col("_prev")) > F.lit(gap_ms), 1).otherwise(0)))
    # read twice below (slice summary, final pass): write it once rather than
    # re-running the bucket aggregation over all events for each read
    ensure_checkpoint_dir(buckets.sparkSession)
    loc = loc.checkpoint()
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    summ = (loc.groupBy(*part)
               .agg(F.min(lo).alias("_flo"), F.max(hi).alias("_shi"), F.sum("_lnew").alias("_sn"))
               .withColumn("_carry_hi", F.max("_shi").over(before)))
    summ = summ.withColumn("_fnew", F.when(F.col("_carry_hi").isNull() |
                                           ((F.col("_flo") - F.col("_carry_hi")) > F.lit(gap_ms)), 1).otherwise(0))
    summ = summ.withColumn("_off", F.coalesce(F.sum(F.col("_sn") + F.col("_fnew")).over(before), F.lit(0)))
    out = loc.join(summ.select(*part, "_fnew", "_off"), part)
    new = F.when(F.col("_prev").isNull(), F.col("_fnew")).otherwise(F.col("_lnew"))
    return (out.withColumn("_sid", F.col("_off") + F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
               .select(*buckets.columns, "_sid"))


def session_table(df: DataFrame, keys: list[str], gap_ms: int, ts_col: str = "ts",
                  rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """Map every (key, bucket) to its session: ``keys, _bucket, session_start,
    session_end`` (end = last event + gap, as ``session_window``)."""
    b = (df.groupBy(*keys, gap_bucket(ts_col, gap_ms).alias("_bucket"))
           .agg(F.min(ts_col).alias("_lo"), F.max(ts_col).alias("_hi")))
    b = session_ids(b, keys, gap_ms, rows_per_slice=rows_per_slice, at_most=df)
    w = Window.partitionBy(*keys, "_sid")
    return b.select(*keys, "_bucket",
                    F.min("_lo").over(w).alias("session_start"),
                    (F.max("_hi").over(w) + F.lit(gap_ms)).alias("session_end"))


def streaming_session(df: DataFrame, gap_ms: int, ts_col: str = "ts") -> Column:
    """Session window on the watermarked ``event_time`` column of a stream."""
    return F.session_window(F.col("event_time"), ms_interval(gap_ms))


def bidder_sessions(bids: DataFrame, gap_ms: int, allowed_lateness_ms: int = 0,
                    key: str = "person_id", rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """A5: per bidder session ``person_id, session_start, session_end, last_ts,
    last_ingestion_ts, bid_count`` (max ts and max ingestion are independent).

    ``allowed_lateness_ms`` only widens the streaming watermark (T4)."""
    if bids.isStreaming:
        s = streaming_session(bids, gap_ms)
        out = (bids.groupBy(key, s.alias("window"))
                   .agg(F.max("ts").alias("last_ts"), F.max("ingestion_ts").alias("last_ingestion_ts"),
                        F.count(F.lit(1)).alias("bid_count")))
        return out.select(key, "window", from_event_time("window.start").alias("session_start"),
                          from_event_time("window.end").alias("session_end"),
                          "last_ts", "last_ingestion_ts", "bid_count")
    b = (bids.groupBy(key, gap_bucket("ts", gap_ms).alias("_bucket"))
             .agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi"),
                  F.max("ingestion_ts").alias("_ing"), F.count(F.lit(1)).alias("_n")))
    b = session_ids(b, [key], gap_ms, rows_per_slice=rows_per_slice, at_most=bids)
    return (b.groupBy(key, "_sid")
             .agg(F.min("_lo").alias("session_start"), F.max("_hi").alias("last_ts"),
                  F.max("_ing").alias("last_ingestion_ts"), F.sum("_n").alias("bid_count"))
             .select(key, "session_start", (F.col("last_ts") + F.lit(gap_ms)).alias("session_end"),
                     "last_ts", "last_ingestion_ts", "bid_count"))
