"""Greedy interval chains for hot keys, in parallel (speculative slices).

Rounds (J3, A1) follow a chain: the first candidate of a key opens a round,
and the next opener is the first candidate at or after the current close.
For an ordinary key the chain is folded in one sorted pass
(:func:`operators.rounds.fold_rounds`).  A key holding a large share of the
data would make that pass one long task, so hot keys are cut into slices of
like size (:func:`plans.ordered.slice_cuts`) and take this route:

1. Every slice is folded from *each* of its candidates at once, by pointer
   doubling in numpy: where a chain that starts there leaves the slice, and
   how many rounds it opened.  Chains meet, so the distinct exits of a slice
   are few (at most the candidates within one round of its end).
2. Each exit is looked up in the slice it lands in and linked with the exit
   that slice answers with.  These links are the whole key in small: one row
   per slice and possible entry, not per candidate.
3. The true entries are the links followed from the key's first candidate,
   by pointer doubling over the links (O(log slices) joins of small tables).
4. Each slice is folded once more, from its true entry.

No task holds more than a slice, and work is linear in the candidates.
Tables that two steps read are written with ``checkpoint()`` to the session's
checkpoint folder, so a lost executor only recomputes one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from auctionflow.plans.ordered import MAX_BROADCAST_CUTS, apply_slices, slice_cuts
from auctionflow.session import ensure_checkpoint_dir

#: The entry of a slice at its first candidate: before every time.
START = -(2 ** 60)


def _bound(t: np.ndarray, close: np.ndarray) -> np.ndarray:
    """The earliest time of the opener after one at ``t``."""
    return np.maximum(close, t + 1)


def chains_within(t: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the chain from each candidate (ascending ``t``) of a slice: its
    last opener in the slice and the number of its openers there."""
    n = len(t)
    last, count = np.arange(n), np.ones(n, dtype=np.int64)
    jump = np.searchsorted(t, _bound(t, close))
    while (inside := jump < n).any():
        to = jump[inside]
        # all three are read before any is written: one doubling step
        last[inside], count[inside], jump[inside] = last[to], count[inside] + count[to], jump[to]
    return last, count


def _whole_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, slice, times of nodes, times and closes of candidates) of rows sorted by (key, _slice, kind, t)."""
    now, held = None, []

    def done():
        kind, t, close = (np.concatenate(x) for x in zip(*held))
        return (*now, t[kind == 0], t[kind == 1], close[kind == 1])

    for batch in batches:
        key, part, kind, t, close = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
            if s == e:
                continue
            own = (int(key[s]), int(part[s]))
            if own != now and held:
                yield done()
                held = []
            now = own
            held.append((kind[s:e], t[s:e], close[s:e]))
    if held:
        yield done()


def _longs(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, _, _, t, close in _whole_slices(batches):
        last, _ = chains_within(t, close)
        found = np.unique(_bound(t[last], close[last]))
        yield _longs(["key", "e"], [np.full(len(found), key), found])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "slice", "e", "to", "open", "close", "count"]
    for key, part, entries, t, close in _whole_slices(batches):
        last, count = chains_within(t, close)
        at = np.searchsorted(t, entries)
        inside = at < len(t)
        first = np.where(inside, at, 0)
        end = last[first] if len(t) else first
        value = lambda x: np.where(inside, x, 0) if len(t) else np.zeros(len(entries), np.int64)
        columns = [value(_bound(t, close)[end]), value(t[end]), value(close[end]), value(count[first])] if len(t) else [value(0)] * 4
        yield _longs(names, [np.full(len(entries), key), np.full(len(entries), part), entries, *columns])


def _fold_from_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Annotate rows sorted by (key, _slice, t), each slice from its entry (columns _e, _open, _close, _no)."""
    now = None
    bound = open_t = close_t = number = 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        column = lambda name: batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)
        key, part, t, close = (column(c) for c in ("key", "_slice", "t", "close_t"))
        entry, first_open, first_close, first_no = (column(c) for c in ("_e", "_open", "_close", "_no"))
        opener = np.zeros(n, dtype=bool)
        number_of, open_of, close_of = np.empty((3, n), dtype=np.int64)
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), n]):
            if (key[s], part[s]) != now:
                now = (key[s], part[s])
                bound, open_t, close_t, number = (int(x[s]) for x in (entry, first_open, first_close, first_no))
            own = t[s:e]
            then = np.searchsorted(own, _bound(own, close[s:e])).tolist()
            at, i = [], int(np.searchsorted(own, bound))
            number_of[s:s + i], open_of[s:s + i], close_of[s:s + i] = number, open_t, close_t
            while i < e - s:
                at.append(i)
                i = then[i]
            if at:
                starts = s + np.array(at)
                sizes = np.diff(np.append(starts, e))
                opener[starts] = True
                number_of[starts[0]:e] = np.repeat(number + 1 + np.arange(len(at)), sizes)
                open_of[starts[0]:e], close_of[starts[0]:e] = np.repeat(t[starts], sizes), np.repeat(close[starts], sizes)
                number, open_t, close_t = number + len(at), int(t[starts[-1]]), int(close[starts[-1]])
                bound = max(close_t, open_t + 1)
        kept = [c for c in batch.schema.names if c not in ("_slice", "_e", "_open", "_close", "_no")]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, (number_of, open_of, close_of, opener))],
                                         names=[*kept, "round_no", "open_t", "round_close", "opener"])


def _followed(links: DataFrame, keys: DataFrame) -> DataFrame:
    """The entries that the chain of each key really takes: key, slice, e, and the round it comes from (open, close; none
    at the head) with its number."""
    level, levels = links, []
    while not level.isEmpty():
        levels.append(level)
        a, b = level.alias("a"), level.alias("b")
        level = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.to_slice") == F.col("b.slice")) & (F.col("a.to") == F.col("b.e"))).select(
            "a.key", "a.slice", "a.e", "b.to_slice", "b.to", F.coalesce("b.open", "a.open").alias("open"), F.coalesce("b.close", "a.close").alias("close"),
            (F.col("a.count") + F.col("b.count")).alias("count")).checkpoint()
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    chain = keys.select("key", zero.alias("slice"), F.lit(START).cast("long").alias("e"), none.alias("open"), none.alias("close"), zero.alias("no"))
    for level in reversed(levels):
        step = chain.alias("c").join(level.alias("l"), ["key", "slice", "e"]).select(
            "key", F.col("l.to_slice").alias("slice"), F.col("l.to").alias("e"), F.coalesce("l.open", "c.open").alias("open"),
            F.coalesce("l.close", "c.close").alias("close"), (F.col("c.no") + F.col("l.count")).alias("no"))
        chain = chain.unionByName(step).checkpoint()
    return chain


def parallel_rounds(rows: DataFrame, hot: DataFrame, n_hot: int, rows_per_slice: int) -> DataFrame:
    """``rows`` (key, t, close_t, any others; only hot keys, ``(key, t)``
    unique) with ``round_no, open_t, round_close, opener``, as the fold gives
    them.  ``hot`` and ``n_hot`` are as of :func:`plans.ordered.hot_keys`."""
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.checkpoint()  # the cuts and the slices are taken from it
    cuts = slice_cuts(rows, hot, ["key"], "t", rows_per_slice).checkpoint()
    place = lambda df, t: apply_slices(df, cuts, n_hot, ["key"], t)
    sliced = place(rows, "t").checkpoint()
    candidates = sliced.select("key", "_slice", F.lit(1).alias("kind"), "t", "close_t")

    def by_slice(df: DataFrame, run, schema: str) -> DataFrame:
        return df.repartition("key", "_slice").sortWithinPartitions("key", "_slice", "kind", "t").mapInArrow(run, schema)

    exits = place(by_slice(candidates, _exits, "key long, e long").distinct(), "e")
    parts = cuts.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.size("_cuts").cast("long"))).alias("_slice"))
    nodes = exits.select("key", "_slice", "e").unionByName(parts.withColumn("e", F.lit(START).cast("long")))
    nodes = nodes.select("key", "_slice", F.lit(0).alias("kind"), F.col("e").alias("t"), F.lit(0).cast("long").alias("close_t"))
    links = by_slice(candidates.unionByName(nodes), _links, "key long, slice long, e long, to long, open long, close long, count long")
    # where the slice has no candidate left, the chain goes on at the next slice's first
    past = F.col("count") == 0
    on = past | (F.col("_slice") == F.col("slice"))
    links = place(links, "to").select(
        "key", "slice", "e", F.when(on, F.col("slice") + 1).otherwise(F.col("_slice")).alias("to_slice"), F.when(on, F.lit(START)).otherwise(F.col("to")).alias("to"),
        F.when(~past, F.col("open")).alias("open"), F.when(~past, F.col("close")).alias("close"), "count").checkpoint()

    entries = _followed(links, cuts.select("key")).withColumnRenamed("slice", "_slice")
    # a slice without an entry lies within the round that ends at the next entry
    ahead = Window.partitionBy("key").orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    info = parts.join(entries, ["key", "_slice"], "left").withColumn("_i", F.last(F.when(F.col("no").isNotNull(), F.struct("e", "open", "close", "no")), ignorenulls=True).over(ahead))
    info = info.select("key", "_slice", F.col("_i.e").alias("_e"), F.col("_i.open").alias("_open"), F.col("_i.close").alias("_close"), F.col("_i.no").alias("_no")).checkpoint()
    if info.count() <= MAX_BROADCAST_CUTS:
        info = F.broadcast(info)
    added = [StructField(n, BooleanType() if n == "opener" else LongType(), False) for n in ("round_no", "open_t", "round_close", "opener")]
    schema = StructType([*rows.schema.fields, *added])
    return (sliced.join(info, ["key", "_slice"]).repartition("key", "_slice").sortWithinPartitions("key", "_slice", "t")
                  .select(*rows.columns, "_slice", "_e", "_open", "_close", "_no").mapInArrow(_fold_from_entries, schema))
