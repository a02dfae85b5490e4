"""Two-stream operators J1, J2, J5.

J1 (new users joined with their latest auction per window) reduces the
auction side to one row per (window, person) with a partial aggregate
before the join, so the join is many-person-rows to one-auction-row on
(window, person_id); a hot person is split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.functions.ordering import order_key
from auctionflow.functions.time import from_event_time
from auctionflow.operators.sampling import sample_every
from auctionflow.operators.sessions import gap_bucket, session_ids
from auctionflow.operators.windows import (SESSION, WindowSpec, explode_pane, pane_start, panes_apply,
                                           window_column)
from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE

AUCTION_ORDER = ["ts", "ingestion_ts", "auction_id", "person_id", "item_id"]
PERSON_ORDER = ["ts", "ingestion_ts", "person_id"]


def latest_auction(ts: str = "ts", ing: str = "ingestion_ts") -> list[Column]:
    """``_a_ing`` / ``_a_ts`` of the auction with the greatest ingestion
    time; ties: smallest ts (the reference keeps the first arrived; equal
    ingestion and ts give equal outputs whichever auction wins).  Fixed-width
    aggregates, so partial and final aggregation are hash based, and the
    result can be merged again with ``latest_auction("_a_ts", "_a_ing")``."""
    return [F.max(ing).alias("_a_ing"), F.max_by(ts, order_key(ing, ts, b_desc=True)).alias("_a_ts")]


def _output(joined: DataFrame, evict: Column) -> DataFrame:
    return joined.select(evict.alias("window_evicting_ts"),
                         F.col("p_ts").alias("person_creation_ts"),
                         F.col("p_ing").alias("person_ingestion_ts"),
                         F.col("_a_ts").alias("auction_creation_ts"),
                         F.col("_a_ing").alias("auction_ingestion_ts"),
                         "person_id")


def new_user_auctions(persons: DataFrame, auctions: DataFrame, spec: WindowSpec,
                      rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """One row per person event that has at least one auction of the same
    person in the same window, carrying that window's latest auction.
    ``window_evicting_ts`` is the window end (event time, not wall clock)."""
    if spec.kind == SESSION:
        return _new_user_auctions_session(persons, auctions, spec.size_ms, rows_per_slice)
    if panes_apply(spec) and not persons.isStreaming:
        # the auction side is reduced per pane before it is expanded
        p = persons.select("person_id", F.col("ts").alias("p_ts"), F.col("ingestion_ts").alias("p_ing"),
                           pane_start("ts", spec).alias("_pane")) \
                   .select("person_id", "p_ts", "p_ing", explode_pane("_pane", spec).alias("ws"))
        a = (auctions.groupBy("person_id", pane_start("ts", spec).alias("_pane"))
                     .agg(*latest_auction()))
        a = (a.select("person_id", "_a_ts", "_a_ing", explode_pane("_pane", spec).alias("ws"))
              .groupBy("person_id", "ws")
              .agg(*latest_auction("_a_ts", "_a_ing")))
        return _output(p.join(a, ["ws", "person_id"]), F.col("ws") + F.lit(spec.size_ms))
    p = persons.select(window_column(spec).alias("window"), "person_id",
                       F.col("ts").alias("p_ts"), F.col("ingestion_ts").alias("p_ing"))
    a = (auctions.groupBy(window_column(spec).alias("window"), "person_id")
                 .agg(*latest_auction()))
    return _output(p.join(a, ["window", "person_id"]), from_event_time("window.end"))


def _new_user_auctions_session(persons: DataFrame, auctions: DataFrame, gap_ms: int,
                               rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """Sessions are formed over the events of *both* inputs of a person.

    One partial aggregate over the union of both inputs gives, per (person,
    gap bucket), the time range and the bucket's latest auction; sessions
    are numbered over those rows and reduced to (end, latest auction) per
    session; person rows find their session by an equi-join on (person,
    bucket)."""
    bucket = gap_bucket("ts", gap_ms).alias("_bucket")
    both = (persons.select("person_id", "ts", F.lit(None).cast("long").alias("ingestion_ts"),
                           F.lit(False).alias("_is_a"))
            .unionByName(auctions.select("person_id", "ts", "ingestion_ts", F.lit(True).alias("_is_a"))))
    both = both.withColumn("_k", order_key("ingestion_ts", "ts", b_desc=True))
    buckets = (both.groupBy("person_id", bucket)
                   .agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi"),
                        F.expr("max(ingestion_ts) FILTER (WHERE _is_a)").alias("_a_ing"),
                        F.expr("max_by(ts, _k) FILTER (WHERE _is_a)").alias("_a_ts")))
    sess = session_ids(buckets, ["person_id"], gap_ms, rows_per_slice=rows_per_slice, at_most=both)
    a_sess = (sess.withColumn("_k", order_key("_a_ing", "_a_ts", b_desc=True))
                  .groupBy("person_id", "_sid")
                  .agg((F.max("_hi") + F.lit(gap_ms)).alias("_end"), F.max("_a_ing").alias("_a_ing"),
                       F.expr("max_by(_a_ts, _k) FILTER (WHERE _a_ing IS NOT NULL)").alias("_a_ts"))
                  .where(F.col("_a_ing").isNotNull()))
    p_sess = (persons.select("person_id", F.col("ts").alias("p_ts"), F.col("ingestion_ts").alias("p_ing"), bucket)
                     .join(sess.select("person_id", "_bucket", "_sid"), ["person_id", "_bucket"]))
    return _output(p_sess.join(a_sess, ["person_id", "_sid"]), F.col("_end"))


def tagged_union(one: DataFrame, two: DataFrame, one_key: str, two_key: str) -> DataFrame:
    """``key, one, two`` where exactly one of the struct columns is set."""
    one_t = F.struct(*one.columns)
    two_t = F.struct(*two.columns)
    left = one.select(F.col(one_key).alias("key"), one_t.alias("one"))
    right = two.select(F.col(two_key).alias("key"), two_t.alias("two"))
    left = left.withColumn("two", F.lit(None).cast(right.schema["two"].dataType))
    right = right.withColumn("one", F.lit(None).cast(left.schema["one"].dataType))
    return left.unionByName(right)


def connect_persons_auctions(persons: DataFrame, auctions: DataFrame, sample_n: int = 200_000,
                             subtasks: int = 4, rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """J2 (live Q8 operator): every person event becomes
    ``(0, ts, ingestion, 0, 0, person_id)``; every ``sample_n``-th auction
    per subtask (subtask = pmod(person_id, subtasks)) becomes
    ``(0, 0, 0, ts, ingestion, -person_id)`` (P3/P4/P5)."""
    s = sample_every(auctions.select(*AUCTION_ORDER), sample_n, AUCTION_ORDER, "person_id",
                     subtasks, "nth", rows_per_slice)
    return connected(persons, s)


def connected(persons: DataFrame, sampled: DataFrame) -> DataFrame:
    """The rows of J2: all ``persons`` and the ``sampled`` auctions."""
    p = persons.select(F.lit(0).cast("long").alias("window_evicting_ts"),
                       F.col("ts").alias("person_creation_ts"),
                       F.col("ingestion_ts").alias("person_ingestion_ts"),
                       F.lit(0).cast("long").alias("auction_creation_ts"),
                       F.lit(0).cast("long").alias("auction_ingestion_ts"),
                       "person_id")
    a = sampled.select(F.lit(0).cast("long").alias("window_evicting_ts"),
                       F.lit(0).cast("long").alias("person_creation_ts"),
                       F.lit(0).cast("long").alias("person_ingestion_ts"),
                       F.col("ts").alias("auction_creation_ts"),
                       F.col("ingestion_ts").alias("auction_ingestion_ts"),
                       (-F.col("person_id")).alias("person_id"))
    return p.unionByName(a)


def person_auction_state(persons: DataFrame, auctions: DataFrame) -> DataFrame:
    """J2 state view: per person id, the last person event (by ts, then
    ingestion) and a summary of the auctions kept for that key; keys seen on
    one side only are kept.  One aggregate over the tagged union (a single
    shuffle with map-side combine); on streams it runs in update or
    complete output mode."""
    u = (persons.select("person_id", "ts", "ingestion_ts", F.lit(True).alias("_is_person"))
         .unionByName(auctions.select("person_id", "ts", "ingestion_ts", F.lit(False).alias("_is_person"))))
    u = u.withColumn("_k", order_key("ts", "ingestion_ts"))
    return (u.groupBy("person_id")
             .agg(F.expr("max(ts) FILTER (WHERE _is_person)").alias("person_ts"),
                  F.expr("max_by(ingestion_ts, _k) FILTER (WHERE _is_person)").alias("person_ingestion_ts"),
                  F.expr("count(1) FILTER (WHERE _is_person)").alias("person_events"),
                  F.expr("count(1) FILTER (WHERE NOT _is_person)").alias("auction_count"),
                  F.expr("min(ts) FILTER (WHERE NOT _is_person)").alias("first_auction_ts"),
                  F.expr("max(ts) FILTER (WHERE NOT _is_person)").alias("last_auction_ts"),
                  F.expr("max(ingestion_ts) FILTER (WHERE NOT _is_person)").alias("last_auction_ingestion_ts")))
