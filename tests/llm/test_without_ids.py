"""Rows without id: nine of ten rows, which must spread over tasks like all others."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from auctionflow.llm import mixing, sharding, spotsigs

N, WITH_ID = 2_000, 200


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i < WITH_ID else None, f"the word{i} of a thing{i % 50} and more " * 3, "a" if i % 3 else "b") for i in range(N)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


def test_spotsigs_deals_them_into_ranges(spark, docs):
    order = docs.select("doc_id", "text", F.coalesce("doc_id", F.xxhash64("text")).alias("key")).collect()
    order.sort(key=lambda r: (r.doc_id is None, r.key, r.text))
    want = Counter()
    for i, r in enumerate(order):
        half, after = len(r.text) // 2, order[(i + 1) % N].text
        want[r.doc_id, r.text[:len(r.text) - half] + after[:half]] += 1
    found = spotsigs.beside_next(docs, parts=16)
    assert Counter((r.doc_id, r.edited) for r in found.collect()) == want
    named, others = docs.selectExpr("doc_id AS key").where("key is not null"), docs.where("doc_id is null").selectExpr("xxhash64(text) AS key")
    firsts, with_id = spotsigs._ranges(named, others, 16)
    assert len(firsts) == 16 and with_id == 2


def test_spotsigs_with_one_kind_of_rows(docs):
    for some in (docs.where("doc_id is null"), docs.where("doc_id is not null")):
        for parts in (1, 7):
            assert spotsigs.beside_next(some, parts=parts).count() == some.count()


def test_spotsigs_with_ids_beyond_doubles(spark):
    """Ids that differ only in bits that a double does not keep."""
    ids = [2 ** 62 + i for i in range(300)] + [-2 ** 62 + 3 * i for i in range(300)]
    docs = spark.createDataFrame([(d, f"the word{d} of it") for d in ids], "doc_id long, text string")
    order = sorted(ids)
    after = {d: f"the word{order[(i + 1) % len(order)]} of it" for i, d in enumerate(order)}
    rows = spotsigs.beside_next(docs, parts=8).collect()
    assert sorted(r.doc_id for r in rows) == order
    for r in rows:
        text = f"the word{r.doc_id} of it"
        half = len(text) // 2
        assert r.edited == text[:len(text) - half] + after[r.doc_id][:half]


def test_mixing_orders_them_by_text(docs):
    rows = mixing.measured(docs)
    assert rows.where("doc_id is null").select("h").distinct().count() == N - WITH_ID
    targets = mixing.targets_of(mixing.staged(rows, "measured"), 1.5, 2.0)
    assigned = mixing.assign(rows, targets, rows_per_bucket=100)
    for r in assigned.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 1


def test_slots_of_them_come_from_many_buckets(docs):
    rows = sharding.shard_documents(docs).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == N and all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1  # the law: doc_id and the number of shards decide
    named = F.coalesce(F.col("doc_id").cast("string"), F.col("text"))
    keyed = sharding.slots(docs.withColumn("shard", F.lit(0)), named, rows_per_bucket=100)
    assert sorted(r.slot for r in keyed.collect()) == list(range(N))
