"""Rounds and their last bids against a plain walk over auctions and bids: ids with one round or many, a hot id, rows without key or time."""

import random

import pytest

from auctionflow.operators import rounds


def walk(auctions, bids, strict):
    """Rounds in order, then every bid in the first round that closes after it."""
    found, last = [], {}
    for key in {a[0] for a in auctions if a[0] is not None}:
        close, own = None, []
        for _, ts, _, _, end in sorted(a for a in auctions if a[0] == key):
            if own and ts in own[-1][3]:
                own[-1][2] += 1
                continue
            if close is None or ts >= close:
                close = end
                own.append([ts, end, 0, set()])
            own[-1][2] += 1
            own[-1][3].add(ts)
        found += [(key, i + 1, o, c, n) for i, (o, c, n, _) in enumerate(own)]
        for b_key, ts, ing in bids:
            if b_key != key or ts is None:
                continue
            i = next((i for i, (_, c, _, _) in enumerate(own) if ts < c), None)
            if i is not None and (not strict or ts >= own[i][0]):
                c, t, g, n = last.get((key, i + 1), (own[i][1], ts, ing, 0))
                last[key, i + 1] = (c, max(t, ts), max(g, ing), n + 1)
    return sorted(found), sorted((*k, *v) for k, v in last.items() if v[1] > 0)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    auctions = []
    for key in range(60):
        for i in range(1 if key % 3 else 6):  # two of three ids have one round
            ts = draw.randrange(0, 200)
            auctions.append((key, ts, ts + draw.randrange(3), len(auctions), ts + draw.randrange(1, 60)))
    auctions += [(7, auctions[7][1], 900, 999, 5000), (None, 3, 3, 1000, 9)]
    bids = [(draw.randrange(0, 64), draw.randrange(-5, 300), draw.randrange(0, 400)) for _ in range(3000)]
    bids += [(1, draw.randrange(0, 300), 7) for _ in range(1500)] + [(None, 5, 5), (2, None, 5)]  # a hot id with one round
    return auctions, bids


@pytest.mark.parametrize(("strict", "slices"), [(False, None), (True, None), (True, 400)])
def test_against_a_walk(spark, rows, strict, slices):
    auctions = spark.createDataFrame(rows[0], "auction_id long, ts long, ingestion_ts long, item_id long, end long")
    bids = spark.createDataFrame(rows[1], "auction_id long, ts long, ingestion_ts long")
    want_rounds, want_last = walk(*rows, strict)
    own = {} if slices is None else {"rows_per_slice": slices, "chain_rows": slices}
    columns = ["auction_id", "round_no", "open_ts", "close_ts", "auctions_in_round"]
    assert sorted(map(tuple, rounds.auction_rounds(auctions, **own).select(columns).collect())) == want_rounds
    columns = ["auction_id", "round_no", "close_ts", "last_ts", "last_ingestion_ts", "bid_count"]
    assert sorted(map(tuple, rounds.last_bids_per_round(bids, auctions, strict, **own).select(columns).collect())) == want_last


def test_auctions_that_end_before_they_begin(spark):
    """Their round holds only their own time; the next auction opens the next round."""
    auctions = spark.createDataFrame([(1, 10, 10, 1, 5), (1, 20, 20, 2, 30), (2, 10, 10, 3, 10)],
                                     "auction_id long, ts long, ingestion_ts long, item_id long, end long")
    found = sorted(tuple(r) for r in rounds.auction_rounds(auctions).select("auction_id", "round_no", "open_ts", "close_ts").collect())
    assert found == [(1, 1, 10, 5), (1, 2, 20, 30), (2, 1, 10, 10)]
    none = auctions.limit(0)
    assert rounds.auction_rounds(none).collect() == []
    assert rounds.last_bids_per_round(none.select("auction_id", "ts", "ingestion_ts"), none).collect() == []
