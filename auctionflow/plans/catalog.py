"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each runs one operator (or a short chain) over the full driver tables via
the bindings.  Output columns are named exactly as in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auctionflow.functions.time import utc_wall_clock
from auctionflow.operators import aggregates, chunks, joins, latency, rounds, sampling, sessions
from auctionflow.operators.windows import WindowSpec, session, sliding, tumbling
from auctionflow.plans import jobs
from auctionflow.sources import bindings as B
from auctionflow.sources import generate, pages

HOUR = 3_600_000
DAY = 86_400_000
BID_ORDER = ["ts", "ingestion_ts", "bid_id"]

Query = Callable[[SparkSession, str], DataFrame]


# --- windowed statistics and sessions ------------------------------------------


def bid_stats_tumbling(spark, sf):
    return aggregates.bid_stats(B.bids(spark, sf), tumbling(DAY))


def bid_stats_sliding(spark, sf):
    return aggregates.bid_stats(B.bids(spark, sf), sliding(DAY, HOUR))


def bid_stats_volume(spark, sf):
    bids = B.volume_bids(spark, sf)
    return aggregates.bid_stats_by(bids, ["auction_id", F.year(utc_wall_clock("ts")).cast("long").alias("year")])


def bidder_sessions(spark, sf):
    return sessions.bidder_sessions(B.bids(spark, sf), 6 * HOUR)


def highest_session_per_window(spark, sf):
    s = sessions.bidder_sessions(B.bids(spark, sf), 6 * HOUR)
    return aggregates.highest_per_window(s, DAY, order_col="last_ts", time_col="session_end", key="person_id")


# --- joins, union, sampling ----------------------------------------------------


def new_user_auctions_tumbling(spark, sf):
    return joins.new_user_auctions(B.persons(spark, sf), B.auctions(spark, sf), tumbling(6 * HOUR))


def new_user_auctions_sliding(spark, sf):
    return joins.new_user_auctions(B.persons(spark, sf), B.auctions(spark, sf), sliding(DAY, 6 * HOUR))


def new_user_auctions_session(spark, sf):
    return joins.new_user_auctions(B.persons(spark, sf), B.auctions(spark, sf), session(6 * HOUR))


def tagged_union(spark, sf):
    p = B.persons(spark, sf).select("person_id", "ts", "ingestion_ts")
    a = B.auctions(spark, sf).select("person_id", "auction_id", "ts", "ingestion_ts")
    u = joins.tagged_union(p, a, "person_id", "person_id")
    return u.select("key", F.col("one.ts").alias("one_ts"), F.col("one.ingestion_ts").alias("one_ingestion_ts"),
                    F.col("two.ts").alias("two_ts"), F.col("two.ingestion_ts").alias("two_ingestion_ts"),
                    F.col("two.auction_id").alias("two_auction_id"))


def connect_persons_auctions(spark, sf):
    return joins.connect_persons_auctions(B.persons(spark, sf), B.auctions(spark, sf), sample_n=100, subtasks=4)


def person_auction_state(spark, sf):
    return joins.person_auction_state(B.persons(spark, sf), B.auctions(spark, sf))


def sample_every_nth(spark, sf):
    return sampling.sample_every(B.bids(spark, sf), 7, BID_ORDER, "auction_id", subtasks=4, phase="nth")


def sample_every_first(spark, sf):
    return sampling.sample_every(B.bids(spark, sf), 7, BID_ORDER, "auction_id", subtasks=4, phase="first")


# --- rounds and chunks ---------------------------------------------------------


def auction_rounds(spark, sf):
    return rounds.auction_rounds(B.auctions(spark, sf))


def open_auctions(spark, sf):
    return rounds.open_auctions(B.auctions(spark, sf))


def last_bids_per_round(spark, sf):
    return rounds.last_bids_per_round(B.bids(spark, sf), B.auctions(spark, sf))


def last_bids_per_round_strict(spark, sf):
    return rounds.last_bids_per_round(B.bids(spark, sf), B.auctions(spark, sf), strict=True)


def round_bids_volume(spark, sf):
    return rounds.last_bids_per_round(B.volume_bids(spark, sf), B.volume_auctions(spark, sf), strict=True)


def bid_rounds(spark, sf):
    return rounds.bid_rounds(B.bids(spark, sf), DAY)


def bid_round_snapshots(spark, sf):
    return rounds.bid_round_snapshots(B.bids(spark, sf), DAY, n=5, subtasks=4)


def bid_chunks(spark, sf):
    return chunks.bid_chunks(B.bids(spark, sf), 32)


# --- latency -------------------------------------------------------------------


def _window_latencies(spark, sf):
    st = aggregates.bid_stats(B.bids(spark, sf), tumbling(DAY))
    return st.select((F.col("window_end") - F.col("last_ts")).alias("bid"),
                     (F.col("window_end") - F.col("last_ingestion_ts")).alias("flight"))


def latency_q8(spark, sf):
    conn = joins.connect_persons_auctions(B.persons(spark, sf), B.auctions(spark, sf), sample_n=5, subtasks=4)
    rec = latency.q8_records(conn, F.greatest("person_ingestion_ts", "auction_ingestion_ts"))
    return latency.running_latency(rec, "q8", "person_id", ["person_creation_ts", "auction_creation_ts", "person_id"],
                                   at_most=B.table(spark, sf, "events"))


def latency_q5(spark, sf):
    r = rounds.bid_rounds(B.bids(spark, sf), HOUR)
    rec = latency.bid_records(r, F.col("round_end"))
    return latency.running_latency(rec, "q5", "auction_id", ["last_ts", "last_ingestion_ts", "auction_id", "round_no"],
                                   at_most=B.bids(spark, sf))


def latency_session(spark, sf):
    s = sessions.bidder_sessions(B.bids(spark, sf), 5 * 60_000)
    rec = latency.bid_records(s, F.col("session_end"))
    return latency.running_latency(rec, "session", "person_id",
                                   ["last_ts", "last_ingestion_ts", "person_id", "session_start"], at_most=B.bids(spark, sf))


def latency_winning(spark, sf):
    r = rounds.last_bids_per_round(B.bids(spark, sf), B.auctions(spark, sf))
    rec = latency.bid_records(r, F.col("close_ts"))
    return latency.running_latency(rec, "winning", "auction_id",
                                   ["last_ts", "last_ingestion_ts", "auction_id", "round_no"], at_most=B.auctions(spark, sf))


def latency_summary(spark, sf):
    return aggregates.latency_summary(_window_latencies(spark, sf), ["bid", "flight"])


def latency_quantiles(spark, sf):
    return aggregates.exact_quantiles(_window_latencies(spark, sf), ["bid", "flight"], [0.5, 0.9, 0.99])


# --- pages ---------------------------------------------------------------------


def _bid_pages(spark, sf):
    return pages.write_pages(B.bids(spark, sf), "bid", ["ts", "bid_id"], partitions=2, partition_key="auction_id")


def pages_bids_roundtrip(spark, sf):
    return pages.decode_pages(_bid_pages(spark, sf), "bid")


def pages_auctions_roundtrip(spark, sf):
    p = pages.write_pages(B.auctions(spark, sf), "auction", ["ts", "item_id"], partitions=2,
                          partition_key="auction_id")
    return pages.decode_pages(p, "auction", strip_padding=True)


def pages_persons_roundtrip(spark, sf):
    p = pages.write_pages(B.person_wire_fields(spark, sf), "person", ["ts", "card0"], partitions=2,
                          partition_key="person_id")
    return pages.decode_pages(p, "person", strip_padding=True)


def page_progress(spark, sf):
    return pages.page_progress(_bid_pages(spark, sf))


# --- generators ----------------------------------------------------------------


def _event_counters(spark, sf):
    """Generator counters taken from the events table (4 subtasks)."""
    ev = B.table(spark, sf, "events")
    return ev.select(F.pmod("event_id", F.lit(4)).cast("int").alias("subtask"),
                     F.expr("event_id div 4").alias("e"))


def gen_persons(spark, sf):
    return generate.generate_persons(_event_counters(spark, sf))


def gen_auctions(spark, sf):
    return generate.generate_auctions(_event_counters(spark, sf))


def gen_bids(spark, sf):
    return generate.generate_bids(_event_counters(spark, sf))


# --- jobs over the tables --------------------------------------------------------


def _inputs(spark, sf):
    return jobs.Inputs(tables={"person": B.persons(spark, sf), "auction": B.auctions(spark, sf), "bid": B.bids(spark, sf)})


def job_new_users(spark, sf):
    return jobs.run("q8", spark, _inputs(spark, sf), sample_n=5)


def job_bid_stats(spark, sf):
    return jobs.run("q5", spark, _inputs(spark, sf), duration_ms=HOUR)


def job_combo_probe(spark, sf):
    return jobs.run("qx_probe", spark, _inputs(spark, sf), sample_n=5)


def new_user_auctions_by_type(spark, sf):
    """E2 with each window type of the numeric selector: 0 tumbling, 1 sliding (by half), 2 session."""
    out = None
    for kind in (0, 1, 2):
        spec = WindowSpec.from_type(kind, 6 * HOUR)
        rows = jobs.run("q8", spark, _inputs(spark, sf), window=spec).withColumn("window_type", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """New users and their latest auction per 6 h window (J1), with the bid
    statistics (A2) of that window for the auctions of the same person.  The
    statistics start from the few (person, window) pairs of the join."""
    persons, auctions, bids = B.persons(spark, sf), B.auctions(spark, sf), B.bids(spark, sf)
    nu = joins.new_user_auctions(persons, auctions, tumbling(6 * HOUR))
    wanted = nu.select("person_id", "window_evicting_ts").distinct()
    own = auctions.select("person_id", "auction_id").distinct()
    stats = (aggregates.bid_stats(bids, tumbling(6 * HOUR))
             .select("auction_id", F.col("window_end").alias("window_evicting_ts"), "bid_count", "max_price"))
    per_person = (wanted.join(own, "person_id").join(stats, ["auction_id", "window_evicting_ts"])
                        .groupBy("person_id", "window_evicting_ts")
                        .agg(F.sum("bid_count").alias("bids_on_own_auctions"),
                             F.max("max_price").alias("max_price_on_own_auctions")))
    return nu.join(per_person, ["person_id", "window_evicting_ts"], "left")


QUERIES: dict[str, Query] = {
    "bid_stats_tumbling": bid_stats_tumbling,
    "bid_stats_sliding": bid_stats_sliding,
    "bid_stats_volume": bid_stats_volume,
    "bidder_sessions": bidder_sessions,
    "highest_session_per_window": highest_session_per_window,
    "new_user_auctions_tumbling": new_user_auctions_tumbling,
    "new_user_auctions_sliding": new_user_auctions_sliding,
    "new_user_auctions_session": new_user_auctions_session,
    "tagged_union": tagged_union,
    "connect_persons_auctions": connect_persons_auctions,
    "person_auction_state": person_auction_state,
    "sample_every_nth": sample_every_nth,
    "sample_every_first": sample_every_first,
    "auction_rounds": auction_rounds,
    "open_auctions": open_auctions,
    "last_bids_per_round": last_bids_per_round,
    "last_bids_per_round_strict": last_bids_per_round_strict,
    "round_bids_volume": round_bids_volume,
    "bid_rounds": bid_rounds,
    "bid_chunks": bid_chunks,
    "latency_q8": latency_q8,
    "latency_q5": latency_q5,
    "latency_session": latency_session,
    "latency_winning": latency_winning,
    "latency_summary": latency_summary,
    "latency_quantiles": latency_quantiles,
    "pages_bids_roundtrip": pages_bids_roundtrip,
    "pages_auctions_roundtrip": pages_auctions_roundtrip,
    "pages_persons_roundtrip": pages_persons_roundtrip,
    "page_progress": page_progress,
    "gen_persons": gen_persons,
    "gen_auctions": gen_auctions,
    "gen_bids": gen_bids,
    "bid_round_snapshots": bid_round_snapshots,
    "job_new_users": job_new_users,
    "job_bid_stats": job_bid_stats,
    "job_combo_probe": job_combo_probe,
    "new_user_auctions_by_type": new_user_auctions_by_type,
    "flagship": flagship,
}
