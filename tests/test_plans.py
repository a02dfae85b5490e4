"""Plan properties the registered queries must keep (guards the scale design)."""

import re

import pytest

from auctionflow.plans.catalog import QUERIES
from conftest import SF001

FORBIDDEN = ["SortAggregate", "CartesianProduct", "BroadcastNestedLoopJoin"]
# queries that need only some columns of their tables (page writers and
# generators legitimately read everything they encode)
SLICED = ["sample_every_nth", "bid_chunks", "bidder_sessions", "last_bids_per_round", "latency_q5"]
PRUNED = ["bid_stats_tumbling", "bid_stats_volume", "bidder_sessions", "new_user_auctions_tumbling",
          "person_auction_state", "auction_rounds", "bid_chunks", "latency_summary", "round_bids_volume"]
WIDTH = {"events": 6, "orders": 6, "lineitem": 11}


def _plan(spark, name):
    return QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name", PRUNED)
def test_scans_are_pruned(spark, name):
    plan = _plan(spark, name)
    scans = re.findall(r"FileScan parquet \[[^\]]*\][^\n]*?Location: [^\n]*?\[[^\]]*/(\w+)\.parquet\][^\n]*?"
                       r"ReadSchema: struct<([^>]*)>", plan)
    assert scans, name
    for table, schema in scans:
        assert len(schema.split(",")) < WIDTH[table], f"{name}: scan of {table} reads every column"


def test_event_scans_push_the_type_filter(spark):
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type", _plan(spark, "bid_stats_tumbling"))


@pytest.mark.parametrize("name", SLICED)
def test_sliced_plans_keep_hash_aggregates(spark, monkeypatch, name):
    """The same properties with every key forced into slices."""
    from auctionflow.operators import chunks, latency, rounds, sampling, sessions
    from auctionflow.plans import ordered
    for module in (ordered, rounds, sessions, chunks, sampling, latency):
        for f in list(vars(module).values()):
            if getattr(f, "__module__", "").startswith("auctionflow.") and getattr(f, "__defaults__", None):
                monkeypatch.setattr(f, "__defaults__", tuple(20 if d == ordered.DEFAULT_ROWS_PER_SLICE else d for d in f.__defaults__))
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
