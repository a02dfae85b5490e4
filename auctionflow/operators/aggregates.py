"""Aggregations A2-A8.

All are built-in aggregates, so Spark plans partial (map-side) aggregation
before the shuffle: a hot auction or a single global window costs one
partial row per input partition, never a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.functions.ordering import order_key
from auctionflow.functions.time import event_time, from_event_time, ms_interval
from auctionflow.operators.windows import (SESSION, WindowSpec, explode_pane, pane_start, panes_apply,
                                           window_column)


def _last_bid(ts: str = "ts", ing: str = "ingestion_ts") -> list[Column]:
    """``last_ts`` and the ingestion time of that bid (equal ts -> smallest
    ingestion), as fixed-width aggregates (hash aggregation)."""
    return [F.max(ts).alias("last_ts"),
            F.max_by(ing, order_key(ts, ing, b_desc=True)).alias("last_ingestion_ts")]


def bid_stats(bids: DataFrame, spec: WindowSpec, key: str = "auction_id",
              extra_keys: list[Column] | None = None) -> DataFrame:
    """A2-A4: per window and auction ``max_price, last_ts, last_ingestion_ts,
    bid_count``.  Works on streams (with a watermark set by the caller)."""
    if spec.kind == SESSION:
        raise ValueError("bid_stats takes tumbling or sliding windows")
    if panes_apply(spec) and not bids.isStreaming:
        return _bid_stats_panes(bids, spec, key, extra_keys)
    groups = [window_column(spec, streaming=bids.isStreaming).alias("window"), F.col(key)] + list(extra_keys or [])
    out = (bids.groupBy(*groups)
               .agg(F.max("bid").alias("max_price"), *_last_bid(), F.count(F.lit(1)).alias("bid_count")))
    rest = [c for c in out.columns if c not in ("window", "max_price", "last_ts", "last_ingestion_ts", "bid_count")]
    return out.select(from_event_time("window.start").alias("window_start"),
                      from_event_time("window.end").alias("window_end"),
                      *rest, "max_price", "last_ts", "last_ingestion_ts", "bid_count")


def _bid_stats_panes(bids: DataFrame, spec: WindowSpec, key: str, extra_keys) -> DataFrame:
    extra = list(extra_keys or [])
    panes = (bids.groupBy(pane_start("ts", spec).alias("_pane"), F.col(key), *extra)
                 .agg(F.max("bid").alias("_mx"), *_last_bid(), F.count(F.lit(1)).alias("_n")))
    rest = [c for c in panes.columns if c not in ("_pane", "_mx", "last_ts", "last_ingestion_ts", "_n")]
    wins = panes.select(explode_pane("_pane", spec).alias("window_start"), *rest, "_mx",
                        F.col("last_ts").alias("_lt"), F.col("last_ingestion_ts").alias("_li"), "_n")
    out = (wins.groupBy("window_start", *rest)
               .agg(F.max("_mx").alias("max_price"), *_last_bid("_lt", "_li"), F.sum("_n").alias("bid_count")))
    return out.select("window_start", (F.col("window_start") + F.lit(spec.size_ms)).alias("window_end"),
                      *rest, "max_price", "last_ts", "last_ingestion_ts", "bid_count")


def bid_stats_by(bids: DataFrame, keys: list[Column | str]) -> DataFrame:
    """A2 over arbitrary grouping columns (no window)."""
    return (bids.groupBy(*keys)
                .agg(F.max("bid").alias("max_price"), *_last_bid(), F.count(F.lit(1)).alias("bid_count")))


def highest_per_window(df: DataFrame, window_ms: int, order_col: str = "last_ts",
                       time_col: str = "session_end", key: str = "person_id") -> DataFrame:
    """In each tumbling window over all keys, the row with the greatest
    ``order_col``; ties go to the smallest ``key``.  (key, order value)
    must identify a row, as it does for sessions of one key.  A row belongs
    to the window holding ``time_col - 1 ms`` (the last instant of a
    session).  Every output column is a hash-aggregated ``max_by`` on one
    fixed-width key, so the global window is reduced map-side and never
    funnels its rows through one task."""
    payload = [c for c in df.columns]
    if df.isStreaming:
        # chained after a windowed stream aggregate: the input window's last instant
        w = F.window(F.window_time("window"), ms_interval(window_ms))
        payload = [c for c in payload if c != "window"]
    else:
        w = F.window(event_time(F.col(time_col) - 1), ms_interval(window_ms))
    k = order_key(order_col, key, b_desc=True)
    out = df.groupBy(w.alias("window")).agg(*[F.max_by(c, k).alias(c) for c in payload])
    return out.select(from_event_time("window.start").alias("window_start"),
                      from_event_time("window.end").alias("window_end"), *payload)


def exact_std(n: Column, s: Column, ss: Column) -> Column:
    """Sample standard deviation from count, integer sum and integer sum of
    squares (DECIMAL(38,0)).  n = 1 gives 0.

    The squares are centred at the whole part q of the mean, D = sum (x - q)^2
    with remainder r = s - q n, since n D - r^2 = n ss - s^2 has far fewer
    digits.  It is exact up to the final division while it fits in 38 digits
    (10^11 day-long latencies and more) and taken in doubles beyond, where
    the centring has already removed the cancellation."""
    dec = lambda c: c.cast("decimal(38,0)")
    q = F.floor(s / n)
    r = dec(s) - dec(q) * dec(n)
    d = dec(ss) - dec(q) * dec(s) * 2 + dec(dec(q) * dec(q)) * dec(n)
    exact = dec(F.try_subtract(F.try_multiply(dec(n), dec(d)), F.try_multiply(dec(r), dec(r)))).cast("double")
    rough = n.cast("double") * d.cast("double") - r.cast("double") * r.cast("double")
    num = F.greatest(F.coalesce(exact, rough), F.lit(0.0))
    den = n.cast("double") * (n - 1).cast("double")
    return F.when(n > 1, F.sqrt(num / den)).when(n == 1, F.lit(0.0))


def exact_quantiles(df: DataFrame, value_cols: list[str], quantiles: list[float], bucket: int = 4096) -> DataFrame:
    """One row: for each series and q the smallest value whose rank is at
    least ceil(q n), as ``{v}_p{100 q}``; NULL values are not counted.

    The values are integers, so they are first counted per distinct value (a
    partial aggregate).  Running counts go over buckets of ``bucket`` values,
    then over the values of one bucket, so no task sorts all values."""
    parts = []
    for v in value_cols:
        seen = df.where(F.col(v).isNotNull()).groupBy(F.col(v).cast("long").alias("v")).agg(F.count("*").alias("c"))
        parts.append(seen.select(F.lit(v).alias("series"), "v", "c"))
    counts = parts[0]
    for more in parts[1:]:
        counts = counts.unionByName(more)
    counts = counts.withColumn("b", F.floor(F.col("v") / bucket))
    before = Window.partitionBy("series").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    totals = (counts.groupBy("series", "b").agg(F.sum("c").alias("t"))
                    .withColumn("base", F.coalesce(F.sum("t").over(before), F.lit(0))))
    n = totals.groupBy("series").agg(F.sum("t").alias("n"))
    own = Window.partitionBy("series", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (counts.join(totals.select("series", "b", "base"), ["series", "b"]).join(n, "series")
                    .withColumn("upto", F.col("base") + F.sum("c").over(own)))
    picked = [F.min(F.when((F.col("series") == v) & (F.col("upto") >= F.ceil(F.lit(q) * F.col("n"))), F.col("v")))
              .alias(f"{v}_p{round(100 * q)}") for v in value_cols for q in quantiles]
    return ranked.groupBy().agg(*picked)


def latency_summary(df: DataFrame, value_cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """Count, mean, min, max, sum, sample std per series (integer ms
    values).  :func:`exact_quantiles` gives the histogram's quantiles."""
    group_cols = group_cols or []
    aggs = []
    for v in value_cols:
        aggs += [F.count(v).alias(f"{v}_count"), F.sum(v).alias(f"{v}_sum"),
                 F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max"),
                 F.sum(F.col(v).cast("decimal(38,0)") * F.col(v).cast("decimal(38,0)")).alias(f"_{v}_ss")]
    out = df.groupBy(*group_cols).agg(*aggs)
    cols = list(group_cols)
    for v in value_cols:
        n, s, ss = F.col(f"{v}_count"), F.col(f"{v}_sum"), F.col(f"_{v}_ss")
        cols += [n.alias(f"{v}_count"), (s / n).alias(f"{v}_mean"), F.col(f"{v}_min"),
                 F.col(f"{v}_max"), s.alias(f"{v}_sum"), exact_std(n, s, ss).alias(f"{v}_std")]
    return out.select(*cols)
