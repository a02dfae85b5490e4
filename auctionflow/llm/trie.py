"""Conversation prefix trie with subtree totals by parallel tree contraction.

Every distinct sequence of first turns is a node.  A prefix is named by its depth and a 128-bit hash, the XOR of one value
for each (position, turn), so prefixes are prefix sums: a very long conversation is hashed in blocks, by many tasks.

Subtree totals come from rounds of joins.  Each round rakes all leaves (their totals are final and go to their parents) and
compresses unary chains: of neighbouring nodes with one child those of least (largest power of two that divides the depth,
depth) are taken out, so a fresh chain loses every other node, whatever its length.  A node that is taken out remembers its
child and what it adds to the child's total.  When nothing is left the rounds are gone through backwards, and every node
taken out gets its total from its child's.  A tree of n nodes takes O(log n) rounds, and the live nodes fall geometrically.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.llm.shared import staged, tidy

#: Positions of a conversation that are hashed together.
BLOCK = 1024
#: Ids of one piece of a list of members.
PIECE = 50_000

# --- turns -----------------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), hi and lo (128 bits of role and text) and bytes (UTF-8 length of the text) of every turn.

    Turns are ordered by turn (null first), then role and text.  Null roles and texts are empty; rows without conv_id
    belong to no conversation and are left out.  Turns are dealt out by ranges of the whole order, so neither a very long
    conversation nor equal rows make a large task; places are counted by range.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                                text("text").alias("text"), F.monotonically_increasing_id().alias("row")).where("conv_id is not null")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(rows.select("conv_id", F.monotonically_increasing_id().alias("at"), half(1).alias("hi"), half(17).alias("lo"),
                              F.octet_length("text").cast("long").alias("bytes")), "turns")
    rows = rows.withColumn("range", F.shiftright("at", 33))
    runs = rows.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "range", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0)) - 1).alias("zero"))
    return rows.join(runs, ["conv_id", "range"]).select("conv_id", (F.col("at") - F.col("zero")).alias("pos"), "hi", "lo", "bytes")


def with_shared_heads(turns: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with shared beginnings: (turns as before with ``size``, conversations: conv_id, size).

    Conversation c starts with the first h turns of conversation c - c % ``group`` (all if it has fewer, none if there is
    no such conversation) and goes on with its own turns after its first h; h = crc32(decimal c) % ``most``.
    """
    heads = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    known = heads.groupBy("base").agg(F.count("*").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(known, "base", "left").withColumn("taken", taken)
    convs = staged(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "conversations")
    own = turns.join(convs, "conv_id").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    first = heads.join(convs, "base").where("pos <= h")
    columns = ["conv_id", "pos", "hi", "lo", "bytes", "size"]
    return first.select(columns).unionByName(own.select(columns)), convs.select("conv_id", "size")


# --- nodes -----------------------------------------------------------------------


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, size, depth, hi, lo (the prefix), parent_hi, parent_lo and bytes (of the last text) of every prefix but the
    empty one, which has hi = lo = 0."""
    one = turns.select("conv_id", "size", F.col("pos").alias("depth"), F.floor(F.col("pos") / BLOCK).alias("block"),
                       F.xxhash64("hi", "pos").alias("x"), F.xxhash64("lo", "pos").alias("y"), "bytes")
    blocks = one.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")).alias(c) for c in ("bx", "by")])
    own = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    up_to = lambda c: F.bit_xor(c).over(own).bitwiseXOR(F.col(f"b{c}"))
    rows = one.join(blocks, ["conv_id", "block"]).withColumn("hi", up_to("x")).withColumn("lo", up_to("y"))
    return rows.select("conv_id", "size", "depth", "hi", "lo", F.col("hi").bitwiseXOR(F.col("x")).alias("parent_hi"),
                       F.col("lo").bitwiseXOR(F.col("y")).alias("parent_lo"), "bytes")


def nodes_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie: depth, hi, lo, conv_id (smallest member), n_convs, bytes and parent_conv_id (null at the root).

    A node's (conv_id, depth) is a name of its own, as its smallest member starts with no other prefix of that depth.
    """
    key = ["depth", "hi", "lo"]
    nodes = paths.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
                                    F.max("parent_hi").alias("parent_hi"), F.max("parent_lo").alias("parent_lo"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in key], "conv_id", "n_convs", zero.alias("bytes"), zero.alias("parent_hi"), zero.alias("parent_lo"))
    nodes = staged(nodes.unionByName(root), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(above, ["depth", "parent_hi", "parent_lo"], "left")
    return staged(nodes.select(*key, "conv_id", "n_convs", "bytes", "parent_conv_id"), "nodes")


def ends_digests(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """depth, hi, lo and ends_sha256 of the nodes at which conversations end: SHA-256 of their decimal ids, ascending,
    comma-joined.

    One digest is sequential by definition, but its ids are joined to long pieces before, by ranges of the order, so the
    copies of a common conversation reach the last task as a few strings, which it streams one at a time.
    """
    zero = F.lit(0).cast("long")
    ends = paths.where("depth = size").select("depth", "hi", "lo", "conv_id")
    ends = ends.unionByName(convs.where("size = 0").select(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), "conv_id"))
    order = ["depth", "hi", "lo", "conv_id"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *key, ids = [batch.column(i).to_numpy() for i in range(4)]
            new = np.flatnonzero(reduce(np.logical_or, [c[1:] != c[:-1] for c in key])) + 1 if len(ids) else np.empty(0, np.int64)
            cuts = np.union1d(np.concatenate([new, np.arange(0, len(ids), PIECE)]).astype(np.int64), [len(ids)])
            starts = cuts[:-1]
            joined = [",".join(map(str, ids[s:e].tolist())) for s, e in zip(starts.tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c[starts], pa.int64()) for c in (*key, ids)] + [pa.array(joined, pa.string())], names=[*order, "ids"])

    parts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidy(pieces), "depth long, hi long, lo long, conv_id long, ids string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["depth", "hi", "lo", "ends_sha256"]
        now, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), (x.as_py() for x in batch.column(3))):
                if key != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _rows(done, names)
        yield _rows([] if state is None else [(*now, state.hexdigest())], names)

    parts = parts.repartition("depth", "hi", "lo").sortWithinPartitions(*order).select("depth", "hi", "lo", "ids")
    return parts.mapInArrow(tidy(digest), "depth long, hi long, lo long, ends_sha256 string")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


# --- tree contraction ------------------------------------------------------------


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """c, d and, for each of ``values``, its sum over the node's subtree.

    ``tree``: c, d (long, together the node's name; d its depth), pc, pd (the parent's name, null at a root) and the value
    columns (long, not null).  Forests work as well.  Every round is staged: a lost executor costs one round's tasks.
    """
    both = lambda f: [f(v) for v in values]
    # a_: what a node has gathered; e_: what its edge adds on the way to the parent
    live = tree.select("c", "d", "pc", "pd", *both(lambda v: F.col(v).alias(f"a_{v}")), *both(lambda v: F.lit(0).cast("long").alias(f"e_{v}")))
    rank = F.col("d").bitwiseAND(-F.col("d"))
    raked, spliced = [], []
    while not live.isEmpty():
        kids = live.where("pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d"))
        kids = kids.agg(F.count("*").alias("k"), F.max("pc").alias("_"), F.max("c").alias("wc"), F.max("d").alias("wd")).drop("_")
        marked = live.join(kids, ["c", "d"], "left").withColumn("k", F.coalesce("k", F.lit(0))).withColumn("rank", rank)
        marked = staged(marked, "marked")
        raked.append(marked.where("k = 0").select("c", "d", *both(lambda v: F.col(f"a_{v}").alias(v))))

        unary = marked.where("k = 1 and pc is not null")
        child = marked.where("k > 0").select(F.col("c").alias("wc"), F.col("d").alias("wd"), F.col("k").alias("wk"), F.col("rank").alias("wrank"),
                                             *both(lambda v: F.col(f"e_{v}").alias(f"we_{v}")))
        parent = unary.select(F.col("wc").alias("c"), F.col("wd").alias("d"), F.col("rank").alias("prank"))
        out = unary.join(child, ["wc", "wd"]).where("wk > 1 or wrank >= rank").join(parent, ["c", "d"], "left").where("prank is null or prank > rank")
        out = staged(out.select("c", "d", "pc", "pd", "wc", "wd", *both(lambda v: (F.col(f"a_{v}") + F.col(f"we_{v}")).alias(f"r_{v}")),
                                *both(lambda v: (F.col(f"a_{v}") + F.col(f"e_{v}")).alias(f"s_{v}"))), "spliced")
        spliced.append(out)

        given = marked.where("k = 0 and pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d"))
        given = given.agg(*both(lambda v: F.sum(F.col(f"a_{v}") + F.col(f"e_{v}")).alias(f"x_{v}")))
        moved = out.select(F.col("wc").alias("c"), F.col("wd").alias("d"), F.col("pc").alias("npc"), F.col("pd").alias("npd"), *both(lambda v: F.col(f"s_{v}")))
        rest = marked.where("k > 0").join(out.select("c", "d"), ["c", "d"], "left_anti").join(given, ["c", "d"], "left").join(moved, ["c", "d"], "left")
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        live = staged(rest.select("c", "d", F.coalesce("npc", "pc").alias("pc"), F.coalesce("npd", "pd").alias("pd"),
                                  *both(lambda v: (F.col(f"a_{v}") + zero(f"x_{v}")).alias(f"a_{v}")),
                                  *both(lambda v: (F.col(f"e_{v}") + zero(f"s_{v}")).alias(f"e_{v}"))), "live")

    totals = []  # of the later rounds: what a node taken out looks up is live after its round
    for leaves, out in zip(reversed(raked), reversed(spliced)):
        if totals and not out.isEmpty():
            later = reduce(DataFrame.unionByName, totals).select(F.col("c").alias("wc"), F.col("d").alias("wd"), *values)
            out = out.join(later, ["wc", "wd"]).select("c", "d", *both(lambda v: (F.col(f"r_{v}") + F.col(v)).alias(v)))
            totals.append(staged(out, "expanded"))
        totals.append(leaves)
    if not totals:
        return tree.select("c", "d", *values)
    return reduce(DataFrame.unionByName, totals)


# --- the operator ----------------------------------------------------------------


def conversation_trie(conversations: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """A row for each node of the prefix trie of the rebuilt ``conversations`` (``with_shared_heads``), the root included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, (n_convs - 1) x UTF-8 bytes of the last text) and ends_sha256.

    Turns that tie are ordered by role and text and all stay, repeated rows too.  Null turns come first; null roles and
    texts are empty; rows without conv_id are left out; an empty table has no node.  Extra columns are ignored.
    """
    turns, convs = with_shared_heads(numbered(conversations), group, most)
    paths = staged(prefixes(turns), "prefixes")
    nodes = nodes_of(paths, convs)
    kids = nodes.where("parent_conv_id is not null").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    nodes = staged(nodes.join(kids.agg(F.count("*").alias("n_children")), ["conv_id", "depth"], "left").fillna(0, ["n_children"]), "nodes")
    tree = nodes.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"),
                        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("pd"),
                        (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"]).select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), "n_leaves", "saved_tokens")
    out = nodes.join(totals, ["conv_id", "depth"]).join(ends_digests(paths, convs), ["depth", "hi", "lo"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
