"""Streaming entry points.

* :func:`with_event_time` adds the watermarked ``event_time`` (T1, T4).
* Windowed operators (bid statistics, sessions, highest per window, J1)
  are the same functions as in batch; they detect ``isStreaming``.
* Sequential operators run as ``transformWithState`` processors
  (:mod:`auctionflow.streaming.processors`) with event-time timers (T2, T5);
  their output carries ``event_time`` (the watermark at emission) as the
  declared event-time column, so they chain (rounds -> latency lines).
  J3 also has the processing-time, arrival-order form (T3).
* :func:`start` writes a stream with a checkpoint (T6) to a file, memory or
  ``noop`` sink, or through ``foreachBatch``; :func:`plans.jobs.start_job`
  starts whole jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from auctionflow.functions.time import event_time, ms_interval
from auctionflow.operators import latency as L
from auctionflow.operators.sampling import subtask_of
from auctionflow.operators.windows import EVENT_TIME, SESSION, WindowSpec, window_column
from auctionflow.streaming import processors as P

GENERATOR_DELAY_MS = 1_000   # bounded out-of-orderness of generated streams
KAFKA_DELAY_MS = 2_000       # ... and of Kafka page streams


def with_event_time(df: DataFrame, delay_ms: int, ts_col: str = "ts", allowed_lateness_ms: int = 0) -> DataFrame:
    """``event_time`` = ts as TIMESTAMP, watermark delayed by the
    out-of-orderness plus the allowed lateness (one final result per
    window).  On a batch DataFrame the watermark is a no-op."""
    return (df.withColumn(EVENT_TIME, event_time(ts_col))
              .withWatermark(EVENT_TIME, ms_interval(max(1, delay_ms + allowed_lateness_ms))
                             if delay_ms + allowed_lateness_ms > 0 else "0 seconds"))


def _tws(df: DataFrame, key: str, processor, schema: StructType) -> DataFrame:
    """Run a processor; its output gets the propagated ``event_time`` column."""
    out = StructType(list(schema.fields) + [StructField(EVENT_TIME, TimestampType())])
    return df.groupBy(key).transformWithState(processor, out, "Append", "EventTime",
                                               eventTimeColumnName=EVENT_TIME)


def last_bids_per_round(bids: DataFrame, auctions: DataFrame, strict: bool = False,
                        time_mode: str = "EventTime") -> DataFrame:
    """J3 on two watermarked streams (tagged union keyed by auction id).
    ``time_mode="ProcessingTime"`` runs the arrival-order form with
    wall-clock timers at each round's ``end`` (T3)."""
    a = auctions.select("auction_id", "ts", F.lit(True).alias("is_auction"), F.col("end"),
                        "ingestion_ts", F.col("item_id").alias("tie"), EVENT_TIME)
    b = bids.select("auction_id", "ts", F.lit(False).alias("is_auction"), F.lit(None).cast("long").alias("end"),
                    "ingestion_ts", F.col("bid_id").alias("tie"), EVENT_TIME)
    if time_mode == "ProcessingTime":
        u = a.unionByName(b).drop(EVENT_TIME)
        return u.groupBy("auction_id").transformWithState(P.ArrivalRounds(), P.LAST_BIDS_SCHEMA, "Append",
                                                           "ProcessingTime")
    return _tws(a.unionByName(b), "auction_id", P.LastBidsPerRound(strict), P.LAST_BIDS_SCHEMA)


def bid_rounds(bids: DataFrame, duration_ms: int) -> DataFrame:
    """A1 on a watermarked bid stream."""
    b = bids.select("auction_id", "ts", "ingestion_ts", "bid", F.col("bid_id").alias("tie"), EVENT_TIME)
    return _tws(b, "auction_id", P.BidRounds(duration_ms), P.BID_ROUNDS_SCHEMA)


def bid_chunks(bids: DataFrame, size: int = 32, idle_flush_ms: int | None = None) -> DataFrame:
    """J4 on a watermarked bid stream: full chunks, and partial chunks of
    auctions idle for ``idle_flush_ms`` (event time) when it is given."""
    b = bids.select("auction_id", "ts", "ingestion_ts", "bid_id", "bid", EVENT_TIME)
    return _tws(b, "auction_id", P.BidChunks(size, idle_flush_ms), P.CHUNK_SCHEMA)


def sample_every(df: DataFrame, n: int, order_cols: list[str], key_col: str, subtasks: int = 4,
                 phase: str = "nth") -> DataFrame:
    """P5 on a stream; ``order_cols[0]`` is the event time in ms."""
    payload = [c for c in df.columns if c not in order_cols and c != EVENT_TIME]
    fields = [StructField(c, df.schema[c].dataType) for c in order_cols + payload]
    out = StructType([StructField(c, df.schema[c].dataType) for c in df.columns if c != EVENT_TIME] +
                     [StructField("subtask", LongType()), StructField("seq", LongType())])
    tagged = df.withColumn("subtask", subtask_of(F.col(key_col), subtasks).cast("long"))
    proc = P.SampleEvery(n, phase, [(f.name, f.dataType) for f in fields], out)
    return _tws(tagged, "subtask", proc, out)


def running_latency(records: DataFrame, kind: str, key_col: str, order_cols: list[str],
                    subtasks: int = 4) -> DataFrame:
    """K1-K4 on a stream of ``q8_records`` / ``bid_records`` (same
    arguments as :func:`operators.latency.running_latency`; up to three
    order columns after ``processed_ts``).  Rows are buffered by their
    watermarked ``event_time`` and ordered by ``processed_ts``: exact when
    ``processed_ts`` never exceeds ``event_time`` and rows are emitted once
    the watermark passes ``processed_ts`` (round and session closes)."""
    if kind == "q8":
        layout, series = L.Q8_COLUMNS, {"person": "person", "auction": "auction", "flight": "flightTime"}
    else:
        layout = L.WINNING_COLUMNS if kind == "winning" else L.BID_COLUMNS
        series = {"bid": "bidLatency", "flight": "flightTime"}
    order = (list(order_cols) + [None] * 3)[:3]
    if len(order_cols) > 3:
        raise ValueError("at most three order columns")
    r = records.select(subtask_of(F.col(key_col), subtasks).cast("long").alias("subtask"),
                       F.unix_millis(EVENT_TIME).alias("etime"), "processed_ts",
                       *[(F.col(c) if c else F.lit(0)).cast("long").alias(f"o{i + 1}") for i, c in enumerate(order)],
                       *[F.col(f).cast("long").alias(f) for f in series], F.col("_emit").alias("emit"),
                       EVENT_TIME)
    schema = StructType([StructField(c, P._L if c in ("subtask", "ts") or c.endswith(("Count", "Min", "Max", "Sum"))
                                     else P._D) for c in layout])
    return _tws(r, "subtask", P.RunningLatency(layout, series, kind == "winning"), schema)


def connect_persons_auctions(persons: DataFrame, auctions: DataFrame, sample_n: int = 200_000,
                             subtasks: int = 4) -> DataFrame:
    """J2 on watermarked streams: every person row, plus every ``sample_n``-th
    auction per subtask (counter in state)."""
    from auctionflow.operators.joins import AUCTION_ORDER
    p = persons.select(F.lit(0).cast("long").alias("window_evicting_ts"), F.col("ts").alias("person_creation_ts"),
                       F.col("ingestion_ts").alias("person_ingestion_ts"),
                       F.lit(0).cast("long").alias("auction_creation_ts"),
                       F.lit(0).cast("long").alias("auction_ingestion_ts"), "person_id", EVENT_TIME)
    s = sample_every(auctions.select(*AUCTION_ORDER, EVENT_TIME), sample_n, AUCTION_ORDER, "person_id",
                     subtasks, "nth")
    a = s.select(F.lit(0).cast("long").alias("window_evicting_ts"), F.lit(0).cast("long").alias("person_creation_ts"),
                 F.lit(0).cast("long").alias("person_ingestion_ts"), F.col("ts").alias("auction_creation_ts"),
                 F.col("ingestion_ts").alias("auction_ingestion_ts"), (-F.col("person_id")).alias("person_id"),
                 EVENT_TIME)
    return p.unionByName(a)


def new_user_auctions(persons: DataFrame, auctions: DataFrame, spec: WindowSpec) -> DataFrame:
    """J1 on two watermarked streams (tumbling or sliding): raw person rows
    carrying their window joined with the windowed latest-auction aggregate."""
    from auctionflow.operators.joins import latest_auction
    if spec.kind == SESSION:
        return _new_user_sessions(persons, auctions, spec.size_ms, latest_auction)
    p = persons.select(window_column(spec, streaming=True).alias("window"), "person_id",
                       F.col("ts").alias("p_ts"), F.col("ingestion_ts").alias("p_ing"))
    a = (auctions.groupBy(window_column(spec, streaming=True).alias("window"), "person_id")
                 .agg(*latest_auction()))
    j = p.join(a, ["window", "person_id"])
    return j.select(F.unix_millis(F.col("window.end")).alias("window_evicting_ts"),
                    F.col("p_ts").alias("person_creation_ts"), F.col("p_ing").alias("person_ingestion_ts"),
                    F.col("_a_ts").alias("auction_creation_ts"), F.col("_a_ing").alias("auction_ingestion_ts"),
                    "person_id")


def _new_user_sessions(persons: DataFrame, auctions: DataFrame, gap_ms: int, latest_auction) -> DataFrame:
    """W6 on streams: sessions over the union of both inputs
    (``session_window`` on the watermarked ``event_time``), each with its
    latest auction; person rows join the session that contains them (a
    stream-stream join with a time-range condition)."""
    u = (persons.select("person_id", "ts", F.lit(None).cast("long").alias("a_ts"),
                        F.lit(None).cast("long").alias("a_ing"), EVENT_TIME)
         .unionByName(auctions.select("person_id", "ts", F.col("ts").alias("a_ts"),
                                      F.col("ingestion_ts").alias("a_ing"), EVENT_TIME)))
    sess = (u.groupBy("person_id", F.session_window(EVENT_TIME, ms_interval(gap_ms)).alias("window"))
             .agg(*latest_auction("a_ts", "a_ing"), F.count("a_ts").alias("_auctions"))
             .where(F.col("_auctions") > 0)
             .select(F.col("person_id").alias("s_person"), "window", "_a_ts", "_a_ing"))
    p = persons.select("person_id", F.col("ts").alias("p_ts"), F.col("ingestion_ts").alias("p_ing"),
                       F.col(EVENT_TIME).alias("p_time"))
    j = p.join(sess, (p["person_id"] == sess["s_person"]) & (p["p_time"] >= sess["window.start"]) &
               (p["p_time"] < sess["window.end"]))
    return j.select(F.unix_millis(F.col("window.end")).alias("window_evicting_ts"),
                    F.col("p_ts").alias("person_creation_ts"), F.col("p_ing").alias("person_ingestion_ts"),
                    F.col("_a_ts").alias("auction_creation_ts"), F.col("_a_ing").alias("auction_ingestion_ts"),
                    "person_id")


def start(df: DataFrame, checkpoint: str, sink: str = "memory", name: str | None = None,
          output_mode: str = "append", trigger: dict | None = None, path: str | None = None,
          fmt: str = "parquet", foreach_batch=None):
    """Start a streaming query (T6).  ``sink``: "memory" (needs ``name``),
    "noop", "file" (``path`` and ``fmt``), or "foreach" (``foreach_batch``)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    if sink == "memory":
        w = w.format("memory")
    elif sink == "noop":
        w = w.format("noop")
    elif sink == "file":
        w = w.format(fmt).option("path", path)
    elif sink == "foreach":
        w = w.foreachBatch(foreach_batch)
    else:
        raise ValueError(f"unknown sink {sink!r}")
    return w.start()
