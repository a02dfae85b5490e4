"""Connected components of a link table by randomised contraction; no link or component reaches the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.functions.ordering import order_key
from auctionflow.llm.shared import staged


def _priority(node: Column, turn: int) -> Column:
    """A total order of nodes, by id in even turns and by a new hash in odd ones; the node is its low half."""
    return order_key(F.shiftright(F.xxhash64(node, F.lit(turn)), 4) if turn % 2 else F.lit(0).cast("long"), node)


def _node(priority: Column) -> Column:
    two = lambda n: F.expr(f"CAST({2 ** n} AS DECIMAL(38,0))")
    return (priority % two(64) - two(63)).cast("long")


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in ``links`` (a, b: long, not null); direction doesn't count.

    Each turn every node joins the neighbour (or itself) that comes first in that turn's order, and the links are
    contracted.  Stars around their smallest node take one turn.  In random order the expected number of nodes falls by a
    constant factor, so chains take O(log n) turns too.
    Every turn is staged: a lost executor costs one turn's tasks at most.
    """
    ends = lambda df, a, b: df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    rest = staged(ends(links, F.col("a"), F.col("b")), "links")
    labels, turn = None, 0
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_priority(F.col("b"), turn)).alias("p"))
        step = staged(best.select(F.col("a").alias("node"), _node(F.least("p", _priority(F.col("a"), turn))).alias("to")), "step")
        if labels is None:
            labels = step.withColumnRenamed("to", "label")
        else:
            moved = step.select(F.col("node").alias("label"), "to")
            labels = staged(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        left = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        rest = staged(ends(rest.join(left, "a").join(right, "b"), F.col("ta"), F.col("tb")), "links")
        turn += 1
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return staged(labels.join(smallest, "label").select("node", "component"), "components")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, component; None at first) after ``links`` (a, b) join components: only links between components
    that were different are worked on."""
    if labels is None:
        return components(links)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    step = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    to = step.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = labels.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return staged(old.unionByName(step.join(labels.select("node"), "node", "left_anti")), "components")
