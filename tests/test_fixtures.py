"""Hand-made micro fixtures (FIXTURES.md section 5)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auctionflow.operators import aggregates, chunks, joins, latency, rounds, sampling, sessions
from auctionflow.operators.windows import WindowSpec, session, sliding, tumbling
from auctionflow.sources import pages
from conftest import rows

P = "ts long, person_id long, ingestion_ts long"
A = "ts long, auction_id long, person_id long, item_id long, ingestion_ts long, end long"
BID = "ingestion_ts long, ts long, auction_id long, person_id long, bid_id long, bid double"


def persons(spark, data):
    return spark.createDataFrame(data, P)


def auctions(spark, data):
    return spark.createDataFrame([(t, a, p, i, ing, t + 100 if e is None else e) for t, a, p, i, ing, e in data], A)


def bids(spark, data):
    return spark.createDataFrame(data, BID)


def test_new_user_tie_on_ingestion_prefers_smallest_ts(spark):
    p = persons(spark, [(10, 1, 10)])
    a = auctions(spark, [(50, 7, 1, 1, 90, None), (20, 8, 1, 2, 90, None), (30, 9, 1, 3, 80, None)])
    out = joins.new_user_auctions(p, a, tumbling(1000)).collect()
    assert [(r.auction_creation_ts, r.auction_ingestion_ts, r.window_evicting_ts) for r in out] == [(20, 90, 1000)]


def test_new_user_one_row_per_person_event_and_no_match(spark):
    p = persons(spark, [(10, 1, 10), (20, 1, 20), (30, 2, 30)])
    a = auctions(spark, [(40, 7, 1, 1, 40, None), (50, 8, 3, 2, 50, None)])
    out = joins.new_user_auctions(p, a, tumbling(1000))
    assert rows(out, ["person_id", "person_creation_ts"]) == [(1, 10), (1, 20)]


def test_window_bounds_half_open(spark):
    b = bids(spark, [(0, 0, 1, 1, 1, 1.0), (999, 999, 1, 1, 2, 2.0), (1000, 1000, 1, 1, 3, 3.0)])
    out = aggregates.bid_stats(b, tumbling(1000))
    assert rows(out, ["window_start", "bid_count", "max_price"]) == [(0, 2, 2.0), (1000, 1, 3.0)]
    sl = aggregates.bid_stats(b, sliding(1000, 500))
    assert rows(sl, ["window_start", "bid_count"]) == [(-500, 1), (0, 2), (500, 2), (1000, 1)]


def test_equal_last_ts_takes_smallest_ingestion_and_exact_max(spark):
    b = bids(spark, [(70, 50, 1, 1, 1, -5.0), (60, 50, 1, 1, 2, 0.0), (10, 40, 1, 1, 3, -1.0)])
    r = aggregates.bid_stats(b, tumbling(1000)).collect()[0]
    assert (r.last_ts, r.last_ingestion_ts, r.max_price, r.bid_count) == (50, 60, 0.0, 3)


def test_sessions_touching_merge_and_gap_plus_one_splits(spark):
    b = bids(spark, [(0, 0, 1, 1, 1, 1.0), (100, 100, 1, 1, 2, 1.0), (201, 201, 1, 1, 3, 1.0)])
    out = sessions.bidder_sessions(b, 100)
    assert rows(out, ["session_start", "session_end", "bid_count"]) == [(0, 200, 2), (201, 301, 1)]
    native = b.groupBy("person_id", F.session_window(F.timestamp_millis("ts"), "100 milliseconds")).count()
    assert native.count() == 2


def test_session_cogroup_bridged_by_other_side(spark):
    # person at 0, person at 150: 150 apart > gap 100, but an auction at 80 bridges them
    p = persons(spark, [(0, 1, 0), (150, 1, 150)])
    a = auctions(spark, [(80, 7, 1, 1, 80, None)])
    out = joins.new_user_auctions(p, a, session(100))
    assert rows(out, ["person_creation_ts", "window_evicting_ts"]) == [(0, 250), (150, 250)]


def test_round_ownership_and_reopening(spark):
    # auction 1 opens [100, 200); repeat at 150 is ignored; at 200 reopens [200, 300)
    a = auctions(spark, [(100, 1, 9, 1, 100, 200), (150, 1, 9, 2, 150, 400), (200, 1, 9, 3, 200, 300),
                         (500, 2, 9, 4, 500, 600)])
    r = rounds.auction_rounds(a)
    assert rows(r, ["auction_id", "round_no", "open_ts", "close_ts", "auctions_in_round"]) == [
        (1, 1, 100, 200, 2), (1, 2, 200, 300, 1), (2, 1, 500, 600, 1)]
    b = bids(spark, [(5, 5, 1, 1, 1, 1.0), (199, 199, 1, 1, 2, 1.0), (200, 200, 1, 1, 3, 1.0),
                     (300, 300, 1, 1, 4, 1.0)])
    out = rounds.last_bids_per_round(b, a)
    assert rows(out, ["auction_id", "round_no", "last_ts", "bid_count"]) == [(1, 1, 199, 2), (1, 2, 200, 1)]
    strict = rounds.last_bids_per_round(b, a, strict=True)
    assert rows(strict, ["round_no", "bid_count"]) == [(1, 1), (2, 1)]


def test_bid_rounds_anchor_at_first_bid(spark):
    b = bids(spark, [(1, 10, 1, 1, 1, 5.0), (2, 59, 1, 1, 2, 7.0), (3, 60, 1, 1, 3, 1.0), (4, 130, 1, 1, 4, 2.0)])
    out = rounds.bid_rounds(b, 50)
    assert rows(out, ["round_no", "round_start", "bid_count", "max_price", "last_ts"]) == [
        (1, 10, 2, 7.0, 59), (2, 60, 1, 1.0, 60), (3, 130, 1, 2.0, 130)]


@pytest.mark.parametrize("n,expected", [(31, [31]), (32, [32]), (33, [32, 1]), (64, [32, 32])])
def test_chunk_boundaries(spark, n, expected):
    b = bids(spark, [(i, i, 1, 1, i, 1.0) for i in range(n)])
    out = chunks.bid_chunks(b, 32)
    assert [r.bid_count for r in out.orderBy("chunk").collect()] == expected


@pytest.mark.parametrize("m", [6, 7, 8, 14])
def test_sampling_phases(spark, m):
    b = bids(spark, [(i, i, 4, 1, i, 1.0) for i in range(m)])
    nth = sampling.sample_every(b, 7, ["ts", "bid_id"], "auction_id", 1, "nth")
    first = sampling.sample_every(b, 7, ["ts", "bid_id"], "auction_id", 1, "first")
    assert sorted(r.seq for r in nth.collect()) == [s for s in range(1, m + 1) if s % 7 == 0]
    assert sorted(r.seq for r in first.collect()) == [s for s in range(1, m + 1) if (s - 1) % 7 == 0]


def test_latency_thresholds_and_routing(spark):
    rec = spark.createDataFrame(
        [(0, 0, 0, 0, 0, 1), (0, 1, 0, 0, 0, 2), (0, 2, 0, 0, 0, 3),      # persons: 600000, 599999, 599998 ms
         (0, 0, 0, 0, 0, -1), (0, 0, 0, 1, 0, -2), (0, 0, 0, -1, 0, 0)],   # auctions incl. id 0
        "window_evicting_ts long, person_creation_ts long, person_ingestion_ts long, "
        "auction_creation_ts long, auction_ingestion_ts long, person_id long")
    r = latency.q8_records(rec, F.lit(600_000).cast("long"))
    got = {(x.person_id): (x.person, x.auction, x._emit) for x in r.collect()}
    assert got[1] == (None, None, False)           # 600000 is not < threshold
    assert got[2] == (599_999, None, False)
    assert got[-1] == (None, 600_000, True)         # auctions: <= threshold
    assert got[0] == (None, None, False)            # id 0 -> auction arm, 600001 > threshold


def test_one_sample_std_is_zero(spark):
    df = spark.createDataFrame([(5,)], "x long")
    r = aggregates.latency_summary(df, ["x"]).collect()[0]
    assert (r.x_count, r.x_std, r.x_mean) == (1, 0.0, 5.0)


def _page(magic, n, backlog, body=b"", length=8192):
    head = np.array([(magic, n, backlog)], dtype=[("m", ">i4"), ("n", ">i4"), ("b", ">i8")]).tobytes()
    return (head + body).ljust(length, b"\0")[:length]


def test_page_validation(spark):
    bid_magic = pages.BID_MAGIC - 2**32
    data = [(_page(bid_magic, 1, 1), 0), (_page(bid_magic, 1, 1, length=100), 1), (_page(7, 1, 1), 2),
            (_page(bid_magic, 256, 1), 3), (_page(bid_magic, 0, 0), 4), (_page(bid_magic, 255, 255), 5)]
    df = spark.createDataFrame(data, "value binary, offset long")
    good, bad = pages.validate_pages(df, "bid", "quarantine")
    assert sorted(r.offset for r in good.collect()) == [0, 4, 5]
    assert sorted((r.offset, r.problem) for r in bad.collect()) == [(1, "length"), (2, "magic"), (3, "count")]
    with pytest.raises(Exception):
        pages.validate_pages(df, "bid", "fail").count()


def test_person_page_wraps_and_keeps_padding(spark):
    rec = np.zeros(1, dtype=pages.PERSON_DTYPE)
    rec["id"] = -5
    rec["first"], rec["last"] = np.void(b"Ann".ljust(32, b"\0")), np.void(b"B" * 32)
    rec["domain"] = np.void(b"x.org".ljust(32, b"\0"))
    rec["card0"], rec["card1"] = 2**63 - 1, 1
    rec["a"], rec["c"], rec["b"] = -2**31, 1, 7
    rec["ts"] = 42
    page = _page(pages.PERSON_MAGIC, 1, 1, rec.tobytes())
    df = spark.createDataFrame([(page, 0)], "value binary, offset long").withColumn(
        "timestamp", F.timestamp_millis(F.lit(1000)))
    raw = pages.decode_pages(df, "person").collect()[0]
    assert raw.creditcard == str(-2**63) and raw.province == str(2**31 - 1) and raw.zipcode == "6"
    assert raw.name.startswith("Ann\0") and len(raw.name) == 32 + 1 + 32 and raw.ingestion_ts == 1000
    clean = pages.decode_pages(df, "person", strip_padding=True).collect()[0]
    assert clean.email == "Ann." + "B" * 32 + "@x.org" and clean.person_id == -5


def test_window_type_selector():
    assert WindowSpec.from_type(1, 1000).slide_ms == 500
    with pytest.raises(ValueError):
        WindowSpec.from_type(1, 1)   # slide 0 is invalid
    with pytest.raises(ValueError):
        WindowSpec.from_type(3, 1000)


def test_fold_carries_state_across_batches(spark):
    """Many keys, several Arrow batches per partition: runs that end a batch
    (single- or multi-round) continue correctly in the next batch."""
    from auctionflow.operators.rounds import _fold_batches
    import pyarrow as pa
    keys = [1] * 3 + [2] * 5 + [3] * 1 + [4] * 4
    ts = [0, 5, 9, 0, 10, 20, 30, 40, 7, 0, 1, 2, 100]
    close = [t + 15 for t in ts]
    full = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ts, pa.int64()),
                                       pa.array(close, pa.int64())], names=["key", "t", "close_t"])

    def fold(batches):
        out = list(_fold_batches(batches))
        return [tuple(r.values()) for b in out for r in b.to_pylist()]
    whole = fold([full])
    for cut in range(1, full.num_rows):
        assert fold([full.slice(0, cut), full.slice(cut)]) == whole
    got = {(r[0], r[1]): r[3] for r in whole}
    assert got[(2, 0)] == 1 and got[(2, 10)] == 1 and got[(2, 20)] == 2 and got[(2, 40)] == 3
    assert got[(4, 100)] == 2


def test_auction_page_with_invalid_utf8_text(spark):
    rec = np.zeros(2, dtype=pages.AUCTION_DTYPE)
    rec["id"], rec["ts"] = [1, 2], [10, 20]
    rec["name"] = [np.void(b"ok".ljust(20, b"\0")), np.void(b"bad\xff\xfe".ljust(20, b"\0"))]
    page = _page(pages.AUCTION_MAGIC, 2, 2, rec.tobytes())
    df = spark.createDataFrame([(page, 0)], "value binary, offset long").withColumn(
        "timestamp", F.timestamp_millis(F.lit(5)))
    out = sorted((r.auction_id, r.name) for r in pages.decode_pages(df, "auction", strip_padding=True).collect())
    assert out[0] == (1, "ok") and out[1][1].startswith("bad") and "�" in out[1][1]


def test_latency_close_lines_equal_last_running_line(spark):
    b = bids(spark, [(i * 7 % 50, 1000 + i, 1 + i % 3, 1, i, 1.0) for i in range(40)])
    rec = latency.bid_records(b.withColumnRenamed("ts", "last_ts").withColumnRenamed("ingestion_ts",
                                                                                     "last_ingestion_ts"),
                              F.col("last_ts") + 5)
    order = ["last_ts", "last_ingestion_ts", "bid_id"]
    lines = latency.running_latency(rec, "winning", "auction_id", order, subtasks=2, close_lines=True)
    plain = latency.running_latency(rec, "winning", "auction_id", order, subtasks=2)
    assert lines.count() == plain.count() + 2
    for sub in (0, 1):
        last = plain.where(F.col("subtask") == sub).orderBy(F.col("ts").desc(), F.col("bidLatencyCount").desc()).first()
        got = [r for r in lines.where(F.col("subtask") == sub).collect()
               if r.bidLatencyCount == last.bidLatencyCount and r.ts == last.ts]
        assert len(got) == 2 and got[0] == got[1]


def test_assign_window_and_session_table(spark):
    from auctionflow.operators.windows import assign_window
    b = bids(spark, [(0, 0, 1, 1, 1, 1.0), (100, 100, 1, 1, 2, 1.0), (1500, 1500, 1, 1, 3, 1.0)])
    t = assign_window(b, tumbling(1000))
    assert rows(t, ["ts", "window_start", "window_end"]) == [(0, 0, 1000), (100, 0, 1000), (1500, 1000, 2000)]
    s = assign_window(b, sliding(1000, 500))
    assert s.where("ts = 1500").count() == 2
    with pytest.raises(ValueError):
        assign_window(b, session(100))
    st = sessions.session_table(b, ["person_id"], 200)
    assert rows(st, ["_bucket", "session_start", "session_end"]) == [(0, 0, 300), (7, 1500, 1700)]
