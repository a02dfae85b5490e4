"""Batch equals stream: events of sf0.01 replayed as time-ordered files."""

import datetime
import os
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from auctionflow.operators import aggregates, chunks, rounds, sampling, sessions
from auctionflow.operators import joins
from auctionflow.operators.windows import tumbling
from auctionflow.sources import bindings as B
from auctionflow.streaming import queries as S
from conftest import SF01, rows

HOUR, DAY = 3_600_000, 86_400_000
FLUSH_KEY = 999_999


@pytest.fixture(scope="module")
def replay(spark):
    """Events split into 6 files by time plus a far-future flush file (one
    event per type, unused keys) that moves the watermark past everything."""
    root = tempfile.mkdtemp(prefix="auctionflow-stream-")
    src = os.path.join(root, "events")
    os.makedirs(src)
    t = pq.read_table(f"{SF01}/events.parquet")
    t = t.take(pc.sort_indices(t, sort_keys=[("ts", "ascending")]))
    n = t.num_rows
    for i in range(6):
        pq.write_table(t.slice(i * n // 6, (i + 1) * n // 6 - i * n // 6), os.path.join(src, f"part-{i}.parquet"))
    far = datetime.datetime(2030, 1, 1)
    cols = {"event_id": [10**9 + i for i in range(3)], "ts": [far] * 3, "user_id": [FLUSH_KEY] * 3,
            "event_type": ["signup", "view", "click"], "value": [1.0] * 3,
            "props": ['{"k": %d}' % FLUSH_KEY] * 3}
    flush = pa.table({f.name: pa.array(cols[f.name], f.type) for f in t.schema})
    pq.write_table(flush, os.path.join(src, "part-9.parquet"))
    # the file source orders files by modification time: make it strictly
    # increasing so the replay order is the time order in every run
    for i, name in enumerate(sorted(os.listdir(src))):
        os.utime(os.path.join(src, name), (1_700_000_000 + i, 1_700_000_000 + i))
    schema = spark.read.parquet(f"{SF01}/events.parquet").schema
    return root, src, schema


def run_stream(spark, root, df, name):
    ck = os.path.join(root, "ck-" + name)
    q = S.start(df, ck, sink="memory", name=name, trigger={"availableNow": True})
    q.awaitTermination()
    return spark.table(name)


def stream_events(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_stream_bid_stats_equals_batch(spark, replay):
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    out = run_stream(spark, root, aggregates.bid_stats(bids, tumbling(DAY)), "s_bid_stats")
    want = aggregates.bid_stats(B.bids(spark, SF01), tumbling(DAY))
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_sessions_equal_batch(spark, replay):
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    out = run_stream(spark, root, sessions.bidder_sessions(bids, 6 * HOUR), "s_sessions")
    want = sessions.bidder_sessions(B.bids(spark, SF01), 6 * HOUR)
    cols = want.columns
    assert rows(out.where(F.col("person_id") != FLUSH_KEY + 1), cols) == rows(want, cols)


def test_stream_rounds_equal_batch(spark, replay):
    root, src, schema = replay
    ev = stream_events(spark, src, schema)
    bids = S.with_event_time(B.bids(ev), 0)
    auct = S.with_event_time(B.auctions(ev), 0)
    out = run_stream(spark, root, S.last_bids_per_round(bids, auct), "s_rounds")
    want = rounds.last_bids_per_round(B.bids(spark, SF01), B.auctions(spark, SF01))
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_bid_rounds_equal_batch(spark, replay):
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    out = run_stream(spark, root, S.bid_rounds(bids, DAY), "s_bid_rounds")
    want = rounds.bid_rounds(B.bids(spark, SF01), DAY)
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_full_chunks_equal_batch(spark, replay):
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    out = run_stream(spark, root, S.bid_chunks(bids, 32), "s_chunks")
    want = chunks.bid_chunks(B.bids(spark, SF01), 32).where("bid_count = 32")
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_sampling_equals_batch(spark, replay):
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    order = ["ts", "ingestion_ts", "bid_id"]
    out = run_stream(spark, root, S.sample_every(bids, 7, order, "auction_id", 4, "nth"), "s_sample")
    want = sampling.sample_every(B.bids(spark, SF01), 7, order, "auction_id", 4, "nth")
    cols = ["bid_id", "subtask", "seq"]
    assert rows(out, cols) == rows(want, cols)


def test_stream_new_user_join_equals_batch(spark, replay):
    root, src, schema = replay
    ev = stream_events(spark, src, schema)
    p = S.with_event_time(B.persons(ev), 0)
    a = S.with_event_time(B.auctions(ev), 0)
    out = run_stream(spark, root, S.new_user_auctions(p, a, tumbling(6 * HOUR)), "s_new_users")
    want = joins.new_user_auctions(B.persons(spark, SF01), B.auctions(spark, SF01), tumbling(6 * HOUR))
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_running_latency_equals_batch(spark, replay):
    from auctionflow.operators import latency as L
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    rec = L.bid_records(S.bid_rounds(bids, HOUR), F.col("round_end"))
    out = run_stream(spark, root, S.running_latency(rec, "winning", "auction_id",
                                                    ["last_ts", "last_ingestion_ts", "round_no"]), "s_latency")
    brec = L.bid_records(rounds.bid_rounds(B.bids(spark, SF01), HOUR), F.col("round_end"))
    want = L.running_latency(brec, "winning", "auction_id", ["last_ts", "last_ingestion_ts", "round_no"])
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_connect_equals_batch(spark, replay):
    root, src, schema = replay
    ev = stream_events(spark, src, schema)
    p = S.with_event_time(B.persons(ev), 0)
    a = S.with_event_time(B.auctions(ev), 0)
    out = run_stream(spark, root, S.connect_persons_auctions(p, a, 100, 4), "s_connect")
    want = joins.connect_persons_auctions(B.persons(spark, SF01), B.auctions(spark, SF01), 100, 4)
    cols = want.columns
    got = out.where(F.abs("person_id") != FLUSH_KEY + 1)
    assert rows(got, cols) == rows(want, cols)


def test_stream_page_decode(spark, tmp_path):
    from auctionflow.sources import pages
    written = pages.write_pages(B.bids(spark, SF01), "bid", ["ts", "bid_id"], partitions=2,
                                partition_key="auction_id")
    path = str(tmp_path / "pages")
    written.write.parquet(path)
    stream = pages.decode_pages(pages.read_pages(spark, path, "bid", stream=True), "bid")
    out = run_stream(spark, str(tmp_path), stream, "s_pages")
    want = pages.decode_pages(pages.read_pages(spark, path, "bid"), "bid")
    assert rows(out) == rows(want)
    assert out.count() == B.bids(spark, SF01).count()


def test_observe_gauge(spark):
    from pyspark.sql import Observation
    from auctionflow.operators import latency as L
    obs = Observation("lat")
    df = spark.range(10).select(F.col("id").alias("v"))
    df.observe(obs, F.avg("v").alias("mean"), F.count("v").alias("count")).collect()
    assert obs.get == {"mean": 4.5, "count": 10}
    assert L.observe_latency(df, "lat2", "v").count() == 10


def test_stream_session_cogroup_equals_batch(spark, replay):
    from auctionflow.operators.windows import session
    root, src, schema = replay
    ev = stream_events(spark, src, schema)
    p = S.with_event_time(B.persons(ev), 0)
    a = S.with_event_time(B.auctions(ev), 0)
    out = run_stream(spark, root, S.new_user_auctions(p, a, session(6 * HOUR)), "s_new_user_sessions")
    want = joins.new_user_auctions(B.persons(spark, SF01), B.auctions(spark, SF01), session(6 * HOUR))
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_stream_highest_session_per_window_equals_batch(spark, replay):
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    s = sessions.bidder_sessions(bids, 6 * HOUR)
    out = run_stream(spark, root, aggregates.highest_per_window(s, DAY), "s_highest")
    want = aggregates.highest_per_window(sessions.bidder_sessions(B.bids(spark, SF01), 6 * HOUR), DAY)
    cols = [c for c in want.columns]
    assert rows(out, cols) == rows(want, cols)


def test_stream_person_auction_state_complete_mode(spark, replay):
    root, src, schema = replay
    ev = stream_events(spark, src, schema)
    state = joins.person_auction_state(B.persons(ev), B.auctions(ev))
    q = S.start(state, os.path.join(root, "ck-state"), sink="memory", name="s_state", output_mode="complete",
                trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.table("s_state").where(F.col("person_id") != FLUSH_KEY + 1)
    want = joins.person_auction_state(B.persons(spark, SF01), B.auctions(spark, SF01))
    cols = want.columns
    assert rows(out, cols) == rows(want, cols)


def test_processing_time_rounds(spark, tmp_path):
    """Wall-clock timers at each round's end.  Ends in the past fire on
    the next batch: every auction id with bids before its first close
    reports once."""
    a = spark.createDataFrame([(100, 1, 9, 1, 100, 200), (150, 1, 9, 2, 150, 400), (300, 2, 9, 3, 300, 400)],
                              "ts long, auction_id long, person_id long, item_id long, ingestion_ts long, end long")
    b = spark.createDataFrame([(5, 5, 1, 1, 1, 1.0), (199, 199, 1, 1, 2, 1.0), (350, 350, 2, 1, 3, 2.0)],
                              "ingestion_ts long, ts long, auction_id long, person_id long, bid_id long, bid double")
    src = str(tmp_path / "src")
    a.withColumn("kind", F.lit("a")).write.parquet(src + "/a")
    b.withColumn("kind", F.lit("b")).write.parquet(src + "/b")
    sa = S.with_event_time(spark.readStream.schema(a.schema).parquet(src + "/a"), 0)
    sb = S.with_event_time(spark.readStream.schema(b.schema).parquet(src + "/b"), 0)
    q = S.start(S.last_bids_per_round(sb, sa, time_mode="ProcessingTime"), str(tmp_path / "ck"), name="s_ptime",
                trigger={"processingTime": "1 second"})
    import time
    deadline = time.time() + 60
    while time.time() < deadline and spark.table("s_ptime").count() < 2:
        time.sleep(1)
    q.stop()
    got = sorted((r.auction_id, r.round_no, r.last_ts, r.bid_count) for r in spark.table("s_ptime").collect())
    assert got == [(1, 1, 199, 2), (2, 1, 350, 1)]


def test_restart_from_checkpoint_equals_batch(spark, tmp_path):
    """The stateful J3 stream is stopped half way and restarted from its
    checkpoint with more input: the file sink holds exactly the batch
    result (state, timers and sink log survive the restart)."""
    src = tmp_path / "events"
    src.mkdir()
    t = pq.read_table(f"{SF01}/events.parquet")
    t = t.take(pc.sort_indices(t, sort_keys=[("ts", "ascending")]))
    n = t.num_rows
    parts = [t.slice(i * n // 6, (i + 1) * n // 6 - i * n // 6) for i in range(6)]
    far = datetime.datetime(2030, 1, 1)
    cols = {"event_id": [10**9 + i for i in range(3)], "ts": [far] * 3, "user_id": [FLUSH_KEY] * 3,
            "event_type": ["signup", "view", "click"], "value": [1.0] * 3,
            "props": ['{"k": %d}' % FLUSH_KEY] * 3}
    parts.append(pa.table({f.name: pa.array(cols[f.name], f.type) for f in t.schema}))
    schema = spark.read.parquet(f"{SF01}/events.parquet").schema
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def write(i):
        path = str(src / f"part-{i}.parquet")
        pq.write_table(parts[i], path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))

    def run():
        ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        q = S.start(S.last_bids_per_round(S.with_event_time(B.bids(ev), 0), S.with_event_time(B.auctions(ev), 0))
                    .drop("event_time"), ck, sink="file", path=out, trigger={"availableNow": True})
        q.awaitTermination()

    for i in range(3):
        write(i)
    run()
    for i in range(3, 7):
        write(i)
    run()
    got = spark.read.parquet(out)
    want = rounds.last_bids_per_round(B.bids(spark, SF01), B.auctions(spark, SF01))
    cols = want.columns
    assert rows(got, cols) == rows(want, cols)


def test_stream_chunks_with_idle_flush_equal_batch(spark, replay):
    """With an idle time longer than any gap between bids of an auction,
    partial chunks are reported too and the stream equals batch."""
    root, src, schema = replay
    bids = S.with_event_time(B.bids(stream_events(spark, src, schema)), 0)
    out = run_stream(spark, root, S.bid_chunks(bids, 32, idle_flush_ms=20 * DAY), "s_chunks_idle")
    want = chunks.bid_chunks(B.bids(spark, SF01), 32)
    cols = want.columns
    assert rows(out.where(F.col("auction_id") != FLUSH_KEY), cols) == rows(want, cols)
