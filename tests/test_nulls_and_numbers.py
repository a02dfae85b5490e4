"""NULL keys and times: one rule (dropped) below and above every threshold; exact deviations and quantiles."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from auctionflow.operators import aggregates, chunks, rounds, sampling, sessions
from auctionflow.plans.ordered import next_marker, running_aggregates, sequence_numbers
from conftest import rows

BIDS = "auction_id long, person_id long, bid_id long, ts long, ingestion_ts long, bid double"
ORDER = ["ts", "ingestion_ts", "bid_id"]
BIG = 10**9


@pytest.fixture(scope="module")
def bids(spark):
    out = [(7 if i % 5 else 8, i % 3, i, 1000 + 37 * i, 5000 + i, float(i)) for i in range(50)]
    out += [(None, None, 100 + i, 2000 + 500 * i, 1, 1.0) for i in range(5)] + [(7, 1, 200, None, 1, 1.0)]
    out += [(2**53, 1, 300, 1000, 1, 1.0), (2**53 + 1, 1, 301, 1000, 1, 1.0)]
    return spark.createDataFrame(out, BIDS)


def both(make):
    few, one = make(5), make(BIG)
    assert rows(few) == rows(one)
    return few


def test_sequence_numbers(bids):
    assert both(lambda n: sequence_numbers(bids, ["auction_id"], ORDER, "seq", rows_per_slice=n)).count() == 52


def test_running_aggregates(bids):
    assert both(lambda n: running_aggregates(bids.drop("bid"), ["auction_id"], ORDER, ["ingestion_ts"], rows_per_slice=n)).count() == 52


def test_sampling_with_one_subtask(bids):
    assert both(lambda n: sampling.sample_every(bids, 3, ORDER, "auction_id", 1, "nth", rows_per_slice=n)).count() == 52 // 3


def test_chunks_and_sessions(bids):
    assert sum(r.bid_count for r in both(lambda n: chunks.bid_chunks(bids, 4, rows_per_slice=n)).collect()) == 52
    assert sum(r.bid_count for r in both(lambda n: sessions.bidder_sessions(bids, 40, rows_per_slice=n)).collect()) == 52


def test_rounds(bids):
    make = lambda n: rounds.bid_rounds(bids, 300, rows_per_slice=n, chain_rows=n)
    out = both(make).collect()
    assert sum(r.bid_count for r in out) == 52 and None not in {r.auction_id for r in out}
    assert {r.round_no for r in out if r.auction_id >= 2**53} == {1}


def test_markers(spark, bids):
    marks = spark.createDataFrame([(7, 1500, 1), (7, 2500, 2), (None, 2500, 3), (7, None, 4), (8, 9000, 5)], "auction_id long, at long, no long")
    make = lambda n: next_marker(bids.select("auction_id", "ts", "bid_id"), marks, ["auction_id"], "ts", "at", ["no"], rows_per_slice=n)
    out = both(make)
    assert out.count() == 52 and {r.no for r in out.collect()} <= {None, 1, 2, 5}


def test_sliced_lookup_plans_hash_aggregates(spark, bids):
    marks = spark.createDataFrame([(7, 1500, 1)], "auction_id long, at long, no long")
    out = next_marker(bids.select("auction_id", "ts", "bid_id"), marks, ["auction_id"], "ts", "at", ["no"], rows_per_slice=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("n", [2, 3_100_000_000, 10**11, 10**12])
def test_exact_std_of_many_rows(spark, n):
    """Half of n values are -86,399,999 and half 5; exact from literal sums."""
    a, b = -86_399_999, 5
    s, ss = n // 2 * (a + b), n // 2 * (a * a + b * b)
    df = spark.sql(f"SELECT CAST({n} AS BIGINT) n, CAST({s} AS DECIMAL(38,0)) s, CAST({ss} AS DECIMAL(38,0)) ss")
    got = df.select(aggregates.exact_std(F.col("n"), F.col("s"), F.col("ss")).alias("x")).first().x
    want = math.sqrt(Fraction(n * ss - s * s, n * (n - 1)))
    assert got == pytest.approx(want, rel=1e-12)


def test_std_of_equal_values(spark):
    df = spark.range(1000).select(F.lit(86_399_999).cast("long").alias("v"))
    assert aggregates.latency_summary(df, ["v"]).first().v_std == 0.0


def test_exact_quantiles(spark):
    rng = random.Random(5)
    values = [rng.randint(-20_000, 20_000) for _ in range(501)]
    df = spark.createDataFrame([(v, None if v % 2 else v) for v in values], "a long, b long")
    got = aggregates.exact_quantiles(df, ["a", "b"], [0.0, 0.5, 0.9, 1.0]).first()
    for name, own in (("a", sorted(values)), ("b", sorted(v for v in values if v % 2 == 0))):
        for q in (0.0, 0.5, 0.9, 1.0):
            assert got[f"{name}_p{round(100 * q)}"] == own[max(math.ceil(q * len(own)) - 1, 0)]
    assert got.a_p50 == statistics.median_low(values)


def slice_sizes(df, keys, order, n):
    from auctionflow.plans.ordered import add_slices
    sliced, hot = add_slices(df, keys, order, n)
    assert hot
    return [r["count"] for r in sliced.groupBy(*keys, "_slice").count().collect()]


def test_slices_are_even_beside_an_outlier_a_burst_and_equal_times(spark):
    even = spark.range(10_000).select(F.lit(1).cast("long").alias("k"), (F.col("id") * 50 + 10**12).alias("ts"), F.col("id").alias("tie"))
    outlier = even.unionByName(spark.sql("SELECT 1L k, 0L ts, -1L tie"))
    burst = even.withColumn("ts", F.when(F.col("tie") % 10 < 8, F.col("tie") % 7 + 10**12).otherwise(F.col("ts")))
    same = even.withColumn("ts", F.lit(10**12))
    for df in (even, outlier, burst, same):
        sizes = slice_sizes(df, ["k"], ["ts", "tie"], 100)
        assert max(sizes) <= 200 and sum(sizes) == df.count()
        few, one = (sequence_numbers(df, ["k"], ["ts", "tie"], "seq", rows_per_slice=n) for n in (500, BIG))
        assert rows(few) == rows(one)


def test_many_hot_keys_join_their_cuts(spark, monkeypatch):
    from auctionflow.plans import ordered
    monkeypatch.setattr(ordered, "MAX_LITERAL_KEYS", 2)
    df = spark.range(4_000).select((F.col("id") % 5).alias("k"), (F.col("id") % 97).alias("ts"), F.col("id").alias("tie"))
    few, one = (sequence_numbers(df, ["k"], ["ts", "tie"], "seq", rows_per_slice=n) for n in (50, BIG))
    assert rows(few) == rows(one)


@pytest.mark.parametrize("series,std", [({"person": "person", "auction": "auction", "flight": "flightTime"}, False),
                                        ({"bid": "bidLatency", "flight": "flightTime"}, False),
                                        ({"bid": "bidLatency", "flight": "flightTime"}, True)])
def test_stream_state_holds_day_long_latencies(series, std):
    """K1-K4: 5,000 rows of 24 h keep every state field in 64 bits, and the last line is exact."""
    from auctionflow.operators import latency
    from auctionflow.streaming.processors import RunningLatency
    names = latency.Q8_COLUMNS if "person" in series else latency.WINNING_COLUMNS if std else latency.BID_COLUMNS
    p = RunningLatency(names, series, std)
    state, line = p.initial_state(), None
    values = [-86_399_999 + i % 7 for i in range(5_000)]
    for v in values:
        line = p.on_event((3,), state, {"processed_ts": 1, "emit": True, **dict.fromkeys(series, v)})[0]
        assert set(state) == {n for n, _ in p.state_fields} and all(x is None or abs(x) < 2**63 for x in state.values())
    assert line.flightTimeCount == 5_000 and line.flightTimeMean == sum(values) / 5_000 and line.flightTimeMax == max(values)
    if std:
        assert line.flightTimeStd == pytest.approx(statistics.stdev(values), rel=1e-12) and line.flightTimeSum == sum(values)
