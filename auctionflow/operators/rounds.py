"""Rounds (J3, A1, W7): sequential per-key interval chains.

A round of a key opens at an event and closes at a time fixed by that event
(the auction's ``end`` for J3, ``ts + duration`` for A1); while it is open
further openers are ignored, and the first event at or after the close opens
the next round.  Whether an event opens a round depends on the previous
round, so the chain is a fold in (ts, tie-break) order.

Plan:
* only *candidate openers* enter the chain: auctions collapsed to one row
  per (id, ts), or bids collapsed to one row per (auction, ts) by a partial
  aggregate;
* ordinary keys are folded in one pass over data hash-partitioned by key and
  sorted within partitions, streaming through Arrow batches with O(1) state
  per key (key, close, round number) and never holding a group;
* keys with more than ``chain_rows`` candidates are folded in slices, all
  at once, by :mod:`plans.chains` (same result);
* everything else is built-in: bids are assigned to rounds by an as-of
  lookup (:func:`plans.ordered.next_marker`, parallel within hot keys) or
  by the fold's annotation, and rounds are summarised by partial aggregates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctionflow.functions.ordering import order_key
from auctionflow.plans.chains import parallel_rounds
from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, hot_keys, next_marker, placed
from auctionflow.session import ensure_checkpoint_dir

# A key with more candidates than one slice is folded in slices: no task
# holds more than a slice of it.
DEFAULT_CHAIN_ROWS = DEFAULT_ROWS_PER_SLICE

_FOLD_FIELDS = [("round_no", pa.int64()), ("open_t", pa.int64()), ("round_close", pa.int64()),
                ("opener", pa.bool_())]


def _fold_batches(batches):
    """Annotate rows sorted by (key, t) with their round.

    State carried between batches: the current key and its open round's
    close, opening time and number.  Runs that fit in one round are
    assigned with array operations; the other runs are walked round by round
    with ``searchsorted``, so Python work is per round of multi-round keys,
    never per row.  Input columns pass through unchanged."""
    cur_key = None
    cur_close = cur_open = 0
    cur_no = 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        key = batch.column("key").to_numpy(zero_copy_only=False)
        t = batch.column("t").to_numpy(zero_copy_only=False)
        close_t = batch.column("close_t").to_numpy(zero_copy_only=False)
        opener = np.zeros(n, dtype=bool)
        round_no = np.empty(n, dtype=np.int64)
        open_t = np.empty(n, dtype=np.int64)
        round_close = np.empty(n, dtype=np.int64)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[starts[1:], n]
        # Runs that fit in their first round (the usual case) are assigned
        # without Python work per run; only the others are walked below.
        single = t[ends - 1] < close_t[starts]
        if len(starts) and key[0] == cur_key:
            single[0] = False
        lengths = ends - starts
        mask = np.repeat(single, lengths)
        round_no[mask] = 1
        open_t[mask] = np.repeat(t[starts], lengths)[mask]
        round_close[mask] = np.repeat(close_t[starts], lengths)[mask]
        opener[starts[single]] = True
        for s, e in zip(starts[~single].tolist(), ends[~single].tolist()):
            k = key[s]
            if k != cur_key:
                cur_key, cur_no = k, 0
                i = s
            else:
                # the key continues from the previous batch: its round is open
                i = s + int(np.searchsorted(t[s:e], cur_close, side="left"))
            if i > s:
                round_no[s:i], open_t[s:i], round_close[s:i] = cur_no, cur_open, cur_close
            while i < e:
                opener[i] = True
                cur_no += 1
                cur_open, cur_close = int(t[i]), int(close_t[i])
                j = max(s + int(np.searchsorted(t[s:e], cur_close, side="left")), i + 1)
                round_no[i:j], open_t[i:j], round_close[i:j] = cur_no, cur_open, cur_close
                i = j
        if single[-1]:
            # the batch ends inside a single-round run: carry its open round
            cur_key, cur_no = key[starts[-1]], 1
            cur_open, cur_close = int(t[starts[-1]]), int(close_t[starts[-1]])
        cols = list(batch.columns) + [pa.array(round_no), pa.array(open_t), pa.array(round_close),
                                      pa.array(opener)]
        yield pa.RecordBatch.from_arrays(cols, names=list(batch.schema.names) + [f for f, _ in _FOLD_FIELDS])


def fold_rounds(df: DataFrame, key: str, t: str, close_t, tie: list[str] | None = None,
                rows_per_slice: int = DEFAULT_ROWS_PER_SLICE, chain_rows: int = DEFAULT_CHAIN_ROWS,
                at_most: DataFrame | int | None = None) -> DataFrame:
    """Annotate every row with its round: ``round_no`` (1-based per key),
    ``open_t``, ``round_close`` and ``opener``.  Rows are renamed to ``key``,
    ``t``, ``close_t``; other columns pass through.  ``(key, t)`` must be
    unique (callers collapse equal times first).  Rows without a key, a time
    or a close are dropped: they neither open nor belong to a round.

    Keys with more than ``chain_rows`` rows are cut into slices of
    ``rows_per_slice`` (:mod:`plans.chains`); all others are folded in one
    sorted streaming pass."""
    close_col = F.col(close_t) if isinstance(close_t, str) else close_t
    rest = [c for c in df.columns if c not in (key, t) and not (isinstance(close_t, str) and c == close_t)]
    inp = df.select(F.col(key).cast("long").alias("key"), F.col(t).cast("long").alias("t"),
                    close_col.cast("long").alias("close_t"), *rest)
    inp = placed(inp, ["key", "close_t"], "t")
    hot, n_hot = hot_keys(inp, ["key"], chain_rows, at_most)
    if n_hot == 0:
        return _fold_sorted(inp, tie)
    hk = hot.select("key")
    normal = _fold_sorted(inp.join(hk, "key", "left_anti"), tie)
    return normal.unionByName(parallel_rounds(inp.join(hk, "key", "left_semi"), hot, n_hot, rows_per_slice))


def _fold_sorted(inp: DataFrame, tie: list[str] | None) -> DataFrame:
    sorted_in = inp.repartition("key").sortWithinPartitions("key", "t", *(tie or []))
    schema = inp.schema
    for name, _ in _FOLD_FIELDS:
        schema = schema.add(name, "boolean" if name == "opener" else "long", nullable=False)
    return sorted_in.mapInArrow(_fold_batches, schema)


def auction_rounds(auctions: DataFrame, rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
                   chain_rows: int = DEFAULT_CHAIN_ROWS) -> DataFrame:
    """J3 rounds: per auction id, ``round_no, open_ts, close_ts,
    auctions_in_round``.  Auctions of one id are taken in (ts, ingestion_ts,
    item_id) order; only the first of equal ts can open a round, so they are
    collapsed by a partial aggregate before the fold."""
    firsts = (auctions.groupBy("auction_id", "ts")
                      .agg(F.min_by(F.col("end"), order_key("ingestion_ts", "item_id")).alias("end"),
                           F.count(F.lit(1)).alias("_n")))
    folded = fold_rounds(firsts, "auction_id", "ts", "end", rows_per_slice=rows_per_slice, chain_rows=chain_rows,
                         at_most=auctions)
    return (folded.groupBy(F.col("key").alias("auction_id"), "round_no")
                  .agg(F.min("open_t").alias("open_ts"), F.min("round_close").alias("close_ts"),
                       F.sum("_n").alias("auctions_in_round")))


def open_auctions(auctions: DataFrame) -> DataFrame:
    """J4's round openers: the auctions that open a round."""
    r = auction_rounds(auctions)
    return r.select("auction_id", "round_no", "open_ts", "close_ts")


def last_bids_per_round(bids: DataFrame, auctions: DataFrame, strict: bool = False,
                        rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
                        chain_rows: int = DEFAULT_CHAIN_ROWS) -> DataFrame:
    """J3 output: per round with bids, ``auction_id, round_no, close_ts,
    last_ts, last_ingestion_ts, bid_count`` (independent maxima; rounds whose
    max ts is not > 0 are not emitted).  Round i owns bids with
    close(i-1) <= ts < close(i); ``strict`` keeps only open_ts <= ts."""
    rounds = auction_rounds(auctions, rows_per_slice, chain_rows)
    # all bids of an auction at one ts fall in the same round: collapse them
    # (map-side) before the ordered lookup, which then sorts fewer rows
    b = (bids.groupBy("auction_id", "ts")
             .agg(F.max("ingestion_ts").alias("_ing"), F.count(F.lit(1)).alias("_n")))
    owned = next_marker(b, rounds, ["auction_id"], "ts", "close_ts",
                        ["round_no", "open_ts", "close_ts"], strict=True, rows_per_slice=rows_per_slice,
                        at_most=bids)
    owned = owned.where(F.col("round_no").isNotNull())
    if strict:
        owned = owned.where(F.col("ts") >= F.col("open_ts"))
    out = (owned.groupBy("auction_id", "round_no")
                .agg(F.min("close_ts").alias("close_ts"), F.max("ts").alias("last_ts"),
                     F.max("_ing").alias("last_ingestion_ts"), F.sum("_n").alias("bid_count")))
    return out.where(F.col("last_ts") > 0)


def bid_rounds(bids: DataFrame, duration_ms: int, rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
               chain_rows: int = DEFAULT_CHAIN_ROWS) -> DataFrame:
    """A1: per auction, rounds anchored at the first bid: [first.ts,
    first.ts + duration); output ``auction_id, round_no, round_start,
    round_end, max_price, last_ts, last_ingestion_ts, bid_count`` with the
    last bid's ingestion (equal ts -> smallest ingestion).  Bids are reduced
    to one row per (auction, ts) before the fold."""
    per_ts = (bids.groupBy("auction_id", "ts")
                  .agg(F.max("bid").alias("_max"), F.count(F.lit(1)).alias("_n"),
                       F.min("ingestion_ts").alias("_ing")))
    folded = fold_rounds(per_ts, "auction_id", "ts", F.col("ts") + F.lit(duration_ms),
                         rows_per_slice=rows_per_slice, chain_rows=chain_rows, at_most=bids)
    return (folded.groupBy(F.col("key").alias("auction_id"), "round_no")
                  .agg(F.min("open_t").alias("round_start"), F.min("round_close").alias("round_end"),
                       F.max("_max").alias("max_price"), F.max("t").alias("last_ts"),
                       F.max_by("_ing", "t").alias("last_ingestion_ts"), F.sum("_n").alias("bid_count")))


def bid_round_snapshots(bids: DataFrame, duration_ms: int, n: int = 300_000, subtasks: int = 1,
                        rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
                        chain_rows: int = DEFAULT_CHAIN_ROWS) -> DataFrame:
    """A1's intermediate output (P5, third variant): among the bids that are
    not the first of their round, every n-th per subtask (the first, then
    every n; subtask = pmod(auction, subtasks)) reports its round's
    accumulator at that bid: ``auction_id, round_no, max_price, last_ts,
    last_ingestion_ts, bid_count``.  Arrival order is (ts, ingestion_ts,
    bid_id).  The running accumulator is a running aggregate per round
    (parallel within hot rounds); the last-bid ingestion comes from the
    round's latest ts so far (equal ts -> smallest ingestion)."""
    from auctionflow.operators.sampling import sample_every
    from auctionflow.plans.ordered import running_aggregates
    order = ["ts", "ingestion_ts", "bid_id"]
    n_bids = bids.count()
    # last ts so far is the bid's own ts (arrival order is by ts); its
    # ingestion is the smallest ingestion of the round's bids at that ts
    # that arrived so far, i.e. the first bid at that ts
    per_ts = bids.groupBy("auction_id", "ts").agg(F.min("ingestion_ts").alias("last_ingestion_ts"))
    folded = fold_rounds(per_ts, "auction_id", "ts", F.col("ts") + F.lit(duration_ms),
                         rows_per_slice=rows_per_slice, chain_rows=chain_rows, at_most=n_bids)
    b = (bids.select("auction_id", *order, "bid")
             .join(folded.select(F.col("key").alias("auction_id"), F.col("t").alias("ts"), "round_no", "last_ingestion_ts"),
                   ["auction_id", "ts"]))
    if n_bids > rows_per_slice:
        # with hot rounds the annotated bids are read more than once: write
        # them to the session's checkpoint folder instead of folding again
        ensure_checkpoint_dir(bids.sparkSession)
        b = b.checkpoint()
    # running accumulator per (auction, round): count and max price so far
    run = running_aggregates(b, ["auction_id", "round_no"], order, ["bid"], rows_per_slice=rows_per_slice, at_most=n_bids)
    non_first = run.where(F.col("bid_rcount") > 1)
    out = sample_every(non_first, n, order, "auction_id", subtasks, "first", rows_per_slice, n_bids)
    return out.select("auction_id", "round_no", F.col("bid_rmax").alias("max_price"), F.col("ts").alias("last_ts"),
                      "last_ingestion_ts", F.col("bid_rcount").alias("bid_count"))
