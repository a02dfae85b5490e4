"""The hot-key slicing paths give the same answers as one task per key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auctionflow.operators import chunks, latency, rounds, sampling
from auctionflow.plans.ordered import next_marker, running_aggregates, sequence_numbers
from auctionflow.sources import bindings as B
from conftest import SF01, rows


def test_sequence_numbers_sliced_equals_window(spark):
    bids = B.bids(spark, SF01)
    a = sequence_numbers(bids, ["auction_id"], ["ts", "ingestion_ts", "bid_id"], "seq", rows_per_slice=7)
    w = Window.partitionBy("auction_id").orderBy("ts", "ingestion_ts", "bid_id")
    b = bids.withColumn("seq", F.row_number().over(w).cast("long"))
    assert rows(a, ["bid_id", "seq"]) == rows(b, ["bid_id", "seq"])


def test_running_aggregates_sliced_equals_unsliced(spark):
    bids = B.bids(spark, SF01).withColumn("v", F.when(F.col("bid_id") % 3 == 0, None).otherwise(F.col("ts") % 1000))
    cols = ["bid_id", "v_rcount", "v_rsum", "v_rmin", "v_rmax", "v_rss"]
    a = running_aggregates(bids, ["auction_id"], ["ts", "bid_id"], ["v"], rows_per_slice=5)
    b = running_aggregates(bids, ["auction_id"], ["ts", "bid_id"], ["v"], rows_per_slice=10**9)
    assert rows(a, cols) == rows(b, cols)


def test_next_marker_sliced_equals_unsliced(spark):
    bids = B.bids(spark, SF01).select("auction_id", "ts", "bid_id")
    r = rounds.auction_rounds(B.auctions(spark, SF01))
    cols = ["bid_id", "round_no", "close_ts"]
    a = next_marker(bids, r, ["auction_id"], "ts", "close_ts", ["round_no", "close_ts"], rows_per_slice=4)
    b = next_marker(bids, r, ["auction_id"], "ts", "close_ts", ["round_no", "close_ts"], rows_per_slice=10**9)
    assert rows(a, cols) == rows(b, cols)


def test_chunks_and_sampling_sliced(spark):
    bids = B.bids(spark, SF01)
    assert rows(chunks.bid_chunks(bids, 32, rows_per_slice=9)) == rows(chunks.bid_chunks(bids, 32))
    order = ["ts", "ingestion_ts", "bid_id"]
    a = sampling.sample_every(bids, 7, order, "auction_id", 4, "nth", rows_per_slice=50)
    b = sampling.sample_every(bids, 7, order, "auction_id", 4, "nth")
    assert rows(a) == rows(b)


def test_running_latency_sliced(spark):
    s = rounds.bid_rounds(B.bids(spark, SF01), 3_600_000)
    rec = latency.bid_records(s, F.col("round_end"))
    order = ["last_ts", "last_ingestion_ts", "auction_id", "round_no"]
    a = latency.running_latency(rec, "winning", "auction_id", order, rows_per_slice=11)
    b = latency.running_latency(rec, "winning", "auction_id", order)
    assert rows(a) == rows(b)


def plain_chain(rows):
    """Round number, opener's time and close of each (t, close) of one key, ascending."""
    out, no, open_t, close, bound = [], 0, None, None, None
    for t, c in rows:
        if bound is None or t >= bound:
            no, open_t, close, bound = no + 1, t, c, max(c, t + 1)
        out.append((t, no, open_t, close, t == open_t))
    return out


def test_sliced_rounds_against_a_plain_chain(spark):
    """Regular phases that never meet, rounds longer than slices, closes before their opener, one round over everything."""
    import random
    rng = random.Random(5)
    keys = {1: [(3 * i, 3 * i + 100) for i in range(400)],
            2: [(t, t + rng.randrange(1, 50)) for t in sorted(rng.sample(range(5_000), 500))],
            3: [(t, t + rng.choice([-10, 0, 1, 5, 700])) for t in sorted(rng.sample(range(3_000), 300))],
            4: [(i, 10_000) for i in range(120)], 5: [(i, i + 1) for i in range(60)],
            6: [(t, t + 333) for t in sorted(rng.sample(range(9_000), 45))], 7: [(5, 6), (9, 20)]}
    df = spark.createDataFrame([(k, t, c, f"{k}-{t}") for k, own in keys.items() for t, c in own], "k long, t long, c long, extra string").repartition(5)
    want = sorted((k, *r, f"{k}-{r[0]}") for k, own in keys.items() for r in plain_chain(own))
    for size in (7, 40):
        got = rounds.fold_rounds(df, "k", "t", "c", rows_per_slice=size, chain_rows=size)
        assert rows(got, ["key", "t", "round_no", "open_t", "round_close", "opener", "extra"]) == want
    assert rows(rounds.fold_rounds(df, "k", "t", "c"), ["key", "t", "round_no", "open_t", "round_close", "opener", "extra"]) == want


def test_cuts_follow_each_keys_own_size(spark):
    """A key of 21 rows beside one of 2,000 gets two slices at 20 rows a slice; none is much larger than that."""
    from auctionflow.plans.ordered import add_slices, hot_keys, slice_cuts
    df = spark.range(2021).selectExpr("IF(id < 2000, 1, 2) AS k", "IF(id < 2000, id * id, id) AS t", "id")
    hot, n = hot_keys(df, ["k"], 20)
    cuts = {r.k: len(r._cuts) for r in slice_cuts(df, hot, ["k"], "t", 20).collect()}
    assert n == 2 and cuts[2] == 1 and 99 <= cuts[1] <= 127
    sliced, _ = add_slices(df, ["k"], ["t", "id"], 20)
    sizes = sliced.groupBy("k", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 24 and len([r for r in sizes if r.k == 2]) == 2


def test_search_tree_of_cuts(spark, monkeypatch):
    """The tree gives every row the same slice as literal cuts, with one, two and three levels, and joins few cuts a row."""
    from auctionflow.plans import ordered
    df = spark.range(3000).selectExpr("id % 3 AS k", "CAST(id * 7919 % 3001 AS LONG) AS t", "id")
    plain, _ = ordered.add_slices(df, ["k"], ["t", "id"], 20)
    want = rows(plain, ["id", "_slice"])
    monkeypatch.setattr(ordered, "MAX_LITERAL_CUTS", 0)
    for fan, broadcast in ((128, 500_000), (16, 500_000), (4, 0)):
        monkeypatch.setattr(ordered, "FAN", fan)
        monkeypatch.setattr(ordered, "MAX_BROADCAST_CUTS", broadcast)
        found, _ = ordered.add_slices(df, ["k"], ["t", "id"], 20)
        assert rows(found, ["id", "_slice"]) == want


def test_rounds_in_slices_equal_fold(spark):
    """Forcing every key onto the sliced route gives the fold's rounds."""
    bids, auctions = B.bids(spark, SF01), B.auctions(spark, SF01)
    a = rounds.auction_rounds(auctions, rows_per_slice=3, chain_rows=3)
    b = rounds.auction_rounds(auctions)
    assert rows(a) == rows(b)
    c = rounds.bid_rounds(bids, 86_400_000, rows_per_slice=5, chain_rows=5)
    d = rounds.bid_rounds(bids, 86_400_000)
    assert rows(c) == rows(d)
    e = rounds.last_bids_per_round(bids, auctions, rows_per_slice=4, chain_rows=4)
    f = rounds.last_bids_per_round(bids, auctions)
    assert rows(e) == rows(f)


def test_sliced_sessions_equal_unsliced(spark):
    from auctionflow.operators import joins, sessions
    from auctionflow.operators.windows import session
    bids = B.bids(spark, SF01)
    a = sessions.bidder_sessions(bids, 3_600_000, rows_per_slice=3)
    b = sessions.bidder_sessions(bids, 3_600_000)
    assert rows(a) == rows(b)
    p, au = B.persons(spark, SF01), B.auctions(spark, SF01)
    c = joins.new_user_auctions(p, au, session(6 * 3_600_000), rows_per_slice=2)
    d = joins.new_user_auctions(p, au, session(6 * 3_600_000))
    assert rows(c) == rows(d)
