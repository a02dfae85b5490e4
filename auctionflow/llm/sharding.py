"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

The tree has three levels: regions, racks and shards.  Each row descends by weighted hash draws: at every node each
child draws an exponential clock from hash(key, child) with the child's weight as its rate, and the earliest wins.  A
child's clock depends on that child alone, so changing a weight moves rows only into or out of its subtree.

Shards that join later (``Shard.added`` > 0) draw against the whole tree as it was: their clock, at the rate of their
weight, competes with the winning region's clock.  A later shard therefore takes its share from all others and no row
moves between old shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.shared import bucket_count, with_offsets


@dataclass(frozen=True)
class Shard:
    shard: int
    region: str
    rack: str
    weight: float = 1.0
    #: 0 for the shards that the tree began with, then 1, 2, ... in order of joining.
    added: int = 0


def uniform_tree(shards: int, base: int = 40, racks: int = 8, regions: int = 4) -> list[Shard]:
    """``shards`` equal shards; those from ``base`` on joined one by one.  ``base`` is a fixed property of the layout."""
    return [Shard(i, f"region{i * regions // base % regions}", f"rack{i * racks // base % racks}", 1.0, max(0, i - base + 1))
            for i in range(shards)]


def _draw(key: Column, children: Column) -> Column:
    """struct(clock, name, id) of the child of ``children`` (array<struct<name, weight, id>>) whose clock is earliest.

    A clock is -ln(u) / weight with u in (0, 1) from the hash of key and the child's name; the name breaks ties.
    """
    u = lambda name: (F.shiftrightunsigned(F.xxhash64(key, name), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
    return F.array_min(F.transform(children, lambda c: F.struct(
        (-F.log(u(c["name"])) / c["weight"]).alias("clock"), c["name"].alias("name"), c["id"].alias("id"))))


def _nodes(rows: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("id")) for n, w, i in rows])


def tree_shard(df: DataFrame, key: Column, tree: list[Shard], out: str = "shard") -> DataFrame:
    """Add ``out``, the shard of each row by ``key``.  Null keys draw as one more key.  Weight 0 takes no rows.

    The tree is a parameter of a few thousand nodes at most; its nodes are literals in the plan.
    """
    base = [s for s in tree if s.weight > 0 and not s.added]
    if len({s.shard for s in tree}) != len(tree) or not base:
        raise ValueError("shards must be distinct, and the first tree must have weight")
    key = F.coalesce(key.cast("string"), F.lit("\0null"))
    regions = sorted({s.region for s in base})
    racks = sorted({(s.region, s.rack) for s in base})
    weight = lambda own: sum(s.weight for s in own)
    top = _nodes([(r, weight([s for s in base if s.region == r]), i) for i, r in enumerate(regions)])
    middle = F.array(*[_nodes([(f"{r}/{k}", weight([s for s in base if (s.region, s.rack) == (r, k)]), i)
                               for i, (r, k) in enumerate(racks) if r == region]) for region in regions])
    leaves = F.array(*[_nodes([(f"{r}/{k}/{s.shard}", s.weight, s.shard) for s in base if (s.region, s.rack) == (r, k)])
                       for r, k in racks])
    region = _draw(key, top)
    rack = _draw(key, F.get(middle, region["id"]))
    leaf = _draw(key, F.get(leaves, rack["id"]))["id"]
    joined = [(f"joined/{s.shard}", s.weight, s.shard) for s in tree if s.weight > 0 and s.added]
    if joined:
        # the winning region's clock has the rate of the whole first tree, so a joiner wins its share of all rows
        late = _draw(key, _nodes(joined))
        leaf = F.when(late["clock"] < region["clock"], late["id"]).otherwise(leaf)
    return df.withColumn(out, leaf)


def slots(df: DataFrame, key: Column, rows_per_bucket: int = 50_000, shard: str = "shard") -> DataFrame:
    """Add slot: 0, 1, ... within each shard, in hash order of ``key``.  ``df`` is read three times; its plan is cheap."""
    buckets = bucket_count(df.count(), rows_per_bucket)
    keyed = df.withColumn("_h", F.xxhash64(key.cast("string"), F.lit("slot")))
    keyed = keyed.withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
    return with_offsets(keyed, [shard], "_bucket", ["_h"], F.lit(1), "slot").drop("_h", "_bucket")


def shard_documents(docs: DataFrame, shards: int = 40, base: int = 40, racks: int = 8, regions: int = 4) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard, slot and grown_shard (with one shard more).

    The law is ``key``: doc_id and the number of shards decide.  Null texts have no bytes; null ids draw as one key,
    so their rows share a shard, where their slots follow the hash of checksum and size instead; repeated rows share a shard and
    get slots of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    grown = max(base, 1)
    rows = tree_shard(rows, F.col("doc_id"), uniform_tree(shards, grown, racks, regions), "shard")
    rows = tree_shard(rows, F.col("doc_id"), uniform_tree(shards + 1, grown, racks, regions), "grown_shard")
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(" ", F.lit("text"), "text_crc32", "size"))
    return slots(rows, named).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
