"""``transformWithState`` processors for the sequential operators.

All share :class:`OrderedProcessor`: input rows of a key are buffered in map
state by time bucket until the watermark passes them, then fed to
``on_event`` in event-time order (ties broken by the row's ``order``
fields), so a stream gives the same answer as the batch fold whatever the
arrival order within the watermark delay.  One event-time timer per key is
kept (at the smallest pending time, or at the open round's close).  A timer
reads the buckets that the watermark has reached and rewrites at most the
one it stands in; rows of later buckets are neither read nor sorted nor
written again.  The per-key state is an aggregate, not a copy of the rows:
buffers only hold rows newer than the watermark.

Timers fire when the watermark reaches them; late rows (older than the
watermark) are dropped before buffering (T8).

Every output row carries ``event_time`` = the watermark at emission (the
oldest time Spark lets an operator emit), declared as the output event-time
column, so processors can be chained (e.g. rounds -> latency lines).
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

NO_TIMER = -(2**63)


class OrderedProcessor(StatefulProcessor):
    """Subclasses define ``row_fields`` (buffered fields, first is the event
    time in ms), ``state_fields`` and ``on_event`` / ``on_close_time``."""

    row_fields: list[tuple[str, object]] = []
    state_fields: list[tuple[str, object]] = []
    #: Width of a bucket of pending rows.
    bucket_ms = 1_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        longs = lambda *names: StructType([StructField(n, LongType()) for n in names])
        rows = StructType([StructField(n, t) for n, t in self.row_fields])
        # rows that come together are one chunk: a new row never rewrites the rows before it
        self.pending = handle.getMapState("pending", longs("bucket", "chunk"), StructType([StructField("rows", ArrayType(rows))]))
        # (bucket, chunks, smallest time) of the pending rows
        self.index = handle.getValueState("index", StructType([StructField("buckets", ArrayType(longs("bucket", "chunks", "low")))]))
        self.state = handle.getValueState("state", StructType([StructField(n, t) for n, t in self.state_fields]))
        self.timer = handle.getValueState("timer", StructType([StructField("at", LongType())]))

    # -- helpers ----------------------------------------------------------------
    def _load(self) -> dict:
        s = self.state.get() if self.state.exists() else None
        if s is None:
            return self.initial_state()
        return dict(zip([n for n, _ in self.state_fields], s))

    def _store(self, st: dict) -> None:
        self.state.update(tuple(st[n] for n, _ in self.state_fields))

    def _set_timer(self, at: int | None) -> None:
        cur = self.timer.get()[0] if self.timer.exists() else None
        if cur == at:
            return
        if cur is not None:
            self.handle.deleteTimer(cur)
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _load_index(self) -> dict[int, tuple[int, int]]:
        return {b: (n, low) for b, n, low in self.index.get()[0]} if self.index.exists() else {}

    def _store_index(self, index: dict[int, tuple[int, int]]) -> None:
        self.index.update(([(b, n, low) for b, (n, low) in index.items()],))

    def _hold(self, index: dict[int, tuple[int, int]], rows: list[tuple]) -> None:
        """Add pending rows, one chunk a bucket."""
        buckets: dict[int, list[tuple]] = {}
        for r in rows:
            buckets.setdefault(r[0] // self.bucket_ms, []).append(r)
        for b, own in buckets.items():
            n, low = index.get(b, (0, own[0][0]))
            self.pending.updateValue((b, n), (own,))
            index[b] = (n + 1, min(low, *(r[0] for r in own)))

    def _take(self, index: dict[int, tuple[int, int]], wm: int) -> list[tuple]:
        """Remove and return the pending rows before ``wm``."""
        ready: list[tuple] = []
        for b in [b for b, (_, low) in index.items() if low < wm]:
            n, _ = index.pop(b)
            for chunk in range(n):
                ready += [tuple(r) for r in self.pending.getValue((b, chunk))[0]]
                self.pending.removeKey((b, chunk))
        self._hold(index, [r for r in ready if r[0] >= wm])  # of the bucket that wm stands in
        return [r for r in ready if r[0] < wm]

    def _next_timer(self, st: dict, index: dict[int, tuple[int, int]]) -> int | None:
        cands = [min(low for _, low in index.values()) + 1] if index else []
        close = self.close_time(st)
        if close is not None:
            cands.append(close)
        return min(cands) if cands else None

    # -- StatefulProcessor API ---------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        names = [n for n, _ in self.row_fields]
        new = [tuple(r[n] for n in names) for r in rows]
        new = [r for r in new if wm <= 0 or r[0] >= wm]
        if new:
            index = self._load_index()
            self._hold(index, new)
            self._store_index(index)
            # New rows can only move the timer earlier: no need to read the
            # buffered rows back (the timer already covers them and any close).
            at = min(r[0] for r in new) + 1
            cur = self.timer.get()[0] if self.timer.exists() else None
            self._set_timer(at if cur is None else min(cur, at))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        st = self._load()
        index = self._load_index()
        ready = sorted(self._take(index, wm), key=self.sort_key)
        out = []
        names = [n for n, _ in self.row_fields]
        for r in ready:
            out.extend(self.on_event(key, st, dict(zip(names, r))))
        close = self.close_time(st)
        if close is not None and close <= wm:
            out.extend(self.on_close_time(key, st))
        self._store_index(index)
        self._store(st)
        self._set_timer(self._next_timer(st, index))
        stamp = datetime.datetime.fromtimestamp(max(wm, 0) / 1000.0, tz=datetime.timezone.utc)
        return iter(Row(**r.asDict(), event_time=stamp) for r in out)

    def close(self) -> None:
        pass

    # -- to override ----------------------------------------------------------
    def sort_key(self, r: tuple):
        return r

    def initial_state(self) -> dict:
        raise NotImplementedError

    def close_time(self, st: dict) -> int | None:
        return None

    def on_event(self, key, st: dict, ev: dict) -> list[Row]:
        raise NotImplementedError

    def on_close_time(self, key, st: dict) -> list[Row]:
        return []


_L, _D, _B = LongType(), DoubleType(), BooleanType()

LAST_BIDS_SCHEMA = StructType([StructField(n, _L) for n in
                               ["auction_id", "round_no", "close_ts", "last_ts", "last_ingestion_ts", "bid_count"]])


class LastBidsPerRound(OrderedProcessor):
    """J3 on the tagged union of auctions (``is_auction``) and bids of one
    auction id: rounds open at the first auction at or after the previous
    close; a round is reported when the watermark passes its close (the
    event-time form of the reference's timer)."""

    row_fields = [("ts", _L), ("is_auction", _B), ("end", _L), ("ingestion_ts", _L), ("tie", _L)]
    state_fields = [("round_no", _L), ("open_ts", _L), ("close_ts", _L), ("n", _L), ("last_ts", _L),
                    ("last_ing", _L)]

    def __init__(self, strict: bool = False):
        self.strict = strict

    def sort_key(self, r):
        return (r[0], 0 if r[1] else 1, r[4])

    def initial_state(self):
        return {"round_no": 0, "open_ts": None, "close_ts": None, "n": 0, "last_ts": None, "last_ing": None}

    def close_time(self, st):
        return st["close_ts"]

    def _emit(self, key, st):
        out = []
        if st["n"] > 0 and st["last_ts"] is not None and st["last_ts"] > 0:
            out.append(Row(auction_id=key[0], round_no=st["round_no"], close_ts=st["close_ts"],
                           last_ts=st["last_ts"], last_ingestion_ts=st["last_ing"], bid_count=st["n"]))
        st.update(close_ts=None, open_ts=None, n=0, last_ts=None, last_ing=None)
        return out

    def on_event(self, key, st, ev):
        out = []
        if st["close_ts"] is not None and ev["ts"] >= st["close_ts"]:
            out = self._emit(key, st)
        if ev["is_auction"]:
            if st["close_ts"] is None:
                st["round_no"] += 1
                st["open_ts"], st["close_ts"] = ev["ts"], ev["end"]
        elif not (self.strict and st["close_ts"] is None):
            st["n"] += 1
            st["last_ts"] = ev["ts"] if st["last_ts"] is None else max(st["last_ts"], ev["ts"])
            st["last_ing"] = ev["ingestion_ts"] if st["last_ing"] is None else max(st["last_ing"], ev["ingestion_ts"])
        return out

    def on_close_time(self, key, st):
        return self._emit(key, st)


BID_ROUNDS_SCHEMA = StructType([StructField("auction_id", _L), StructField("round_no", _L),
                                StructField("round_start", _L), StructField("round_end", _L),
                                StructField("max_price", _D), StructField("last_ts", _L),
                                StructField("last_ingestion_ts", _L), StructField("bid_count", _L)])


class BidRounds(OrderedProcessor):
    """A1: rounds anchored at the first bid, [first.ts, first.ts + duration)."""

    row_fields = [("ts", _L), ("ingestion_ts", _L), ("bid", _D), ("tie", _L)]
    state_fields = [("round_no", _L), ("start", _L), ("close", _L), ("n", _L), ("mx", _D), ("last_ts", _L),
                    ("last_ing", _L)]

    def __init__(self, duration_ms: int):
        self.duration = duration_ms

    def sort_key(self, r):
        return (r[0], r[1], r[3])

    def initial_state(self):
        return {"round_no": 0, "start": None, "close": None, "n": 0, "mx": None, "last_ts": None, "last_ing": None}

    def close_time(self, st):
        return st["close"]

    def _emit(self, key, st):
        out = []
        if st["n"] > 0:
            out.append(Row(auction_id=key[0], round_no=st["round_no"], round_start=st["start"], round_end=st["close"],
                           max_price=st["mx"], last_ts=st["last_ts"], last_ingestion_ts=st["last_ing"],
                           bid_count=st["n"]))
        st.update(start=None, close=None, n=0, mx=None, last_ts=None, last_ing=None)
        return out

    def on_event(self, key, st, ev):
        out = []
        if st["close"] is not None and ev["ts"] >= st["close"]:
            out = self._emit(key, st)
        if st["close"] is None:
            st["round_no"] += 1
            st["start"], st["close"] = ev["ts"], ev["ts"] + self.duration
        st["n"] += 1
        st["mx"] = ev["bid"] if st["mx"] is None else max(st["mx"], ev["bid"])
        if st["last_ts"] is None or ev["ts"] > st["last_ts"]:
            st["last_ts"], st["last_ing"] = ev["ts"], ev["ingestion_ts"]
        elif ev["ts"] == st["last_ts"]:
            st["last_ing"] = min(st["last_ing"], ev["ingestion_ts"])
        return out

    def on_close_time(self, key, st):
        return self._emit(key, st)


CHUNK_SCHEMA = StructType([StructField("auction_id", _L), StructField("chunk", _L), StructField("bid_count", _L),
                           StructField("first_ts", _L), StructField("last_ts", _L),
                           StructField("last_ingestion_ts", _L), StructField("max_price", _D)])


class BidChunks(OrderedProcessor):
    """Chunks of ``size`` bids per auction in arrival order.  A partial
    chunk stays in state until it fills, or, with ``idle_flush_ms``, until
    the watermark passes the auction's last bid time plus that idle time;
    then it is reported and the next bid starts a new chunk.  (The batch
    form reports partial last chunks; with an idle time longer than any gap
    of an auction the stream gives the same chunks.)"""

    row_fields = [("ts", _L), ("ingestion_ts", _L), ("bid_id", _L), ("bid", _D)]
    state_fields = [("chunk", _L), ("n", _L), ("first_ts", _L), ("last_ts", _L), ("last_ing", _L), ("mx", _D)]

    def __init__(self, size: int = 32, idle_flush_ms: int | None = None):
        self.size = size
        self.idle_flush_ms = idle_flush_ms

    def initial_state(self):
        return {"chunk": 0, "n": 0, "first_ts": None, "last_ts": None, "last_ing": None, "mx": None}

    def close_time(self, st):
        if self.idle_flush_ms is None or st["n"] == 0:
            return None
        return st["last_ts"] + self.idle_flush_ms

    def _emit(self, key, st):
        row = Row(auction_id=key[0], chunk=st["chunk"], bid_count=st["n"], first_ts=st["first_ts"],
                  last_ts=st["last_ts"], last_ingestion_ts=st["last_ing"], max_price=st["mx"])
        st.update(chunk=st["chunk"] + 1, n=0, first_ts=None, last_ts=None, last_ing=None, mx=None)
        return [row]

    def on_event(self, key, st, ev):
        if st["n"] == 0:
            st["first_ts"] = ev["ts"]
        st["n"] += 1
        st["last_ts"] = ev["ts"] if st["last_ts"] is None else max(st["last_ts"], ev["ts"])
        st["last_ing"] = ev["ingestion_ts"] if st["last_ing"] is None else max(st["last_ing"], ev["ingestion_ts"])
        st["mx"] = ev["bid"] if st["mx"] is None else max(st["mx"], ev["bid"])
        return self._emit(key, st) if st["n"] >= self.size else []

    def on_close_time(self, key, st):
        return self._emit(key, st) if st["n"] > 0 else []


class SampleEvery(OrderedProcessor):
    """P5 per subtask: keeps every n-th row ("nth") or rows 1, n+1, ...
    ("first").  Rows are ``(ts, tie..., payload...)``; output keeps the
    payload fields plus ``subtask`` and ``seq``."""

    state_fields = [("seen", _L)]

    def __init__(self, n: int, phase: str, fields: list[tuple[str, object]], out_schema: StructType):
        self.n, self.phase = n, phase
        self.row_fields = fields
        self.out_names = [f.name for f in out_schema.fields]

    def initial_state(self):
        return {"seen": 0}

    def on_event(self, key, st, ev):
        st["seen"] += 1
        s = st["seen"]
        keep = (s % self.n == 0) if self.phase == "nth" else ((s - 1) % self.n == 0)
        if not keep:
            return []
        vals = dict(ev, subtask=key[0], seq=s)
        return [Row(**{k: vals[k] for k in self.out_names})]


class RunningLatency(OrderedProcessor):
    """K1-K4 per subtask: running count / sum / min / max / sum of squares
    of each latency series over rows ordered by processed time; one line
    per accepted row.  ``series`` maps a row field to its CSV name
    (``{"bid": "bidLatency", "flight": "flightTime"}`` for K2-K4,
    person / auction / flight for K1)."""

    def __init__(self, columns: list[str], series: dict[str, str], with_std: bool = False):
        self.columns = columns
        self.series = series
        self.with_std = with_std
        self.row_fields = ([("etime", _L), ("processed_ts", _L), ("o1", _L), ("o2", _L), ("o3", _L)] +
                           [(f, _L) for f in series] + [("emit", _B)])
        # the sum of squares outgrows a BIGINT within 1,300 day-long latencies,
        # so it is kept as two halves of 62 bits, and only where a std is written
        squares = ("ssh", "ssl") if with_std else ()
        self.state_fields = [(f"{f}_{a}", _L) for f in series for a in ("n", "s", "lo", "hi", *squares)]

    def sort_key(self, r):
        return r[1:5]

    def initial_state(self):
        return {n: (None if n.endswith(("_lo", "_hi")) else 0) for n, _ in self.state_fields}

    def on_event(self, key, st, ev):
        for f in self.series:
            v = ev[f]
            if v is None:
                continue
            st[f"{f}_n"] += 1
            st[f"{f}_s"] += v
            if self.with_std:
                ss = (st[f"{f}_ssh"] << 62) + st[f"{f}_ssl"] + v * v
                st[f"{f}_ssh"], st[f"{f}_ssl"] = ss >> 62, ss & ((1 << 62) - 1)
            st[f"{f}_lo"] = v if st[f"{f}_lo"] is None else min(st[f"{f}_lo"], v)
            st[f"{f}_hi"] = v if st[f"{f}_hi"] is None else max(st[f"{f}_hi"], v)
        if not ev["emit"]:
            return []
        line = {"subtask": key[0], "ts": ev["processed_ts"]}
        for f, name in self.series.items():
            n = st[f"{f}_n"]
            line[f"{name}Count"] = n
            line[f"{name}Mean"] = st[f"{f}_s"] / n if n else None
            line[f"{name}Min"], line[f"{name}Max"] = st[f"{f}_lo"], st[f"{f}_hi"]
            if self.with_std:
                # same rounding steps as aggregates.exact_std
                ss = (st[f"{f}_ssh"] << 62) + st[f"{f}_ssl"]
                num = float(n * ss - st[f"{f}_s"] ** 2)
                line[f"{name}Std"] = (math.sqrt(num / float(n * (n - 1))) if n > 1 else (0.0 if n == 1 else None))
                line[f"{name}Sum"] = st[f"{f}_s"] if n else None
        return [Row(**{c: line[c] for c in self.columns})]


class ArrivalRounds(StatefulProcessor):
    """J3 with processing-time timers (T3), the reference's literal form:
    events are taken as they arrive (sorted within a micro-batch so a replay
    is repeatable); the first auction while no round is open registers a
    processing-time timer at its ``end`` (read as wall-clock ms); bids are
    accumulated whether or not a round is open; when the timer fires, the
    round's maxima are emitted if the max ts is > 0, and the round closes.
    Results depend on wall-clock progress, so the event-time
    :class:`LastBidsPerRound` is the default."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("round", StructType(
            [StructField(n, _L) for n in ("round_no", "close_ts", "n", "last_ts", "last_ing")]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s = self.state.get() if self.state.exists() else None
        st = dict(zip(("round_no", "close_ts", "n", "last_ts", "last_ing"), s)) if s else \
            {"round_no": 0, "close_ts": None, "n": 0, "last_ts": None, "last_ing": None}
        for r in sorted(rows, key=lambda r: (r["ts"], 0 if r["is_auction"] else 1, r["tie"])):
            if r["is_auction"]:
                if st["close_ts"] is None:
                    st["round_no"] += 1
                    st["close_ts"] = r["end"]
                    self.handle.registerTimer(r["end"])
            else:
                st["n"] += 1
                st["last_ts"] = r["ts"] if st["last_ts"] is None else max(st["last_ts"], r["ts"])
                st["last_ing"] = (r["ingestion_ts"] if st["last_ing"] is None
                                  else max(st["last_ing"], r["ingestion_ts"]))
        self.state.update(tuple(st[k] for k in ("round_no", "close_ts", "n", "last_ts", "last_ing")))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self.state.get()
        st = dict(zip(("round_no", "close_ts", "n", "last_ts", "last_ing"), s))
        out = []
        if st["n"] > 0 and st["last_ts"] is not None and st["last_ts"] > 0:
            out.append(Row(auction_id=key[0], round_no=st["round_no"], close_ts=st["close_ts"],
                           last_ts=st["last_ts"], last_ingestion_ts=st["last_ing"], bid_count=st["n"]))
        self.state.update((st["round_no"], None, 0, None, None))
        return iter(out)

    def close(self) -> None:
        pass
