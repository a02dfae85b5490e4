"""Bucketed tables: the same rows without a shuffle of the input."""

import pytest

from auctionflow.operators import aggregates, chunks, joins
from auctionflow.operators.windows import tumbling
from auctionflow.sources import bindings as B
from auctionflow.sources import layout
from conftest import SF01, rows

DAY = 86_400_000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bucketed")
    made = {}
    for name, df, key in (("bids", B.bids(spark, SF01), "auction_id"), ("persons", B.persons(spark, SF01), "person_id"),
                          ("auctions", B.auctions(spark, SF01), "person_id")):
        made[name] = layout.write_bucketed(df, f"bucketed_{name}", key, 4, str(root / name))
    yield made
    for name in made:
        spark.sql(f"DROP TABLE bucketed_{name}")


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_and_files(spark, tables):
    assert rows(tables["bids"]) == rows(B.bids(spark, SF01))
    assert len(tables["bids"].inputFiles()) <= 4


def test_aggregates_and_chunks_without_input_shuffle(spark, tables):
    plain, stored = B.bids(spark, SF01), tables["bids"]
    for make in (lambda b: aggregates.bid_stats(b, tumbling(DAY)), lambda b: aggregates.bid_stats_by(b, ["auction_id"]),
                 lambda b: chunks.bid_chunks(b, 32)):
        assert rows(make(stored)) == rows(make(plain))
        assert exchanges(make(plain)) > 0 and exchanges(make(stored)) == 0


def test_new_user_join_without_input_shuffle(spark, tables):
    """J1 joins on (window, person): a table bucketed by person alone serves where Spark may join on part of the keys."""
    want = joins.new_user_auctions(B.persons(spark, SF01), B.auctions(spark, SF01), tumbling(DAY))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = joins.new_user_auctions(tables["persons"], tables["auctions"], tumbling(DAY))
        assert rows(got) == rows(want) and exchanges(got) == 0
        assert exchanges(joins.new_user_auctions(B.persons(spark, SF01), B.auctions(spark, SF01), tumbling(DAY))) > 0
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_bucket_numbers(spark):
    assert [layout.bucket_number(n, 100) for n in (0, 100, 101, 399, 401)] == [1, 1, 2, 4, 8]
    assert layout.hottest_share(spark.range(9).selectExpr("IF(id < 6, 0, id) AS k"), "k") == pytest.approx(2 / 3)
    with pytest.raises(ValueError):
        layout.write_bucketed(spark.range(1), "nothing", "id", 0)
