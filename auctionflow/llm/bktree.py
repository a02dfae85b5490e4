"""SimHash near-duplicates by BK-trees.

Documents with equal fingerprints are one class.  Classes link where their fingerprints differ in ``radius`` bits at most.
Fingerprints are cut into radius + k blocks; two that link agree in at least k of them, so they share a shard: a choice of k
blocks and the bits there.  k is the least for which an evenly filled shard stays small, so shards stay small however many
fingerprints there are; it only decides who meets.

Each shard has a BK-tree: a child hangs on the edge numbered by its Hamming distance to its parent, and a search follows
only edges within the radius of the distance it has found.  Shards above ``SHARD`` fingerprints (many alike) are cut into
tiles by hash, and each tile's tree goes to the members of every other tile, so one shard is many tasks.  What leaves a
task are links of each fingerprint to one of its component there, never all pairs.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.components import components
from auctionflow.llm.shared import staged, texts, tidy

#: Fingerprints of a tile, the mean size of an evenly filled shard above which k grows, and search states held at once.
SHARD, MEAN, STATES = 2048, 256, 300_000
#: Bytes of a text that are split into words at a time.
PART = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")

# --- fingerprints ----------------------------------------------------------------


def _word_parts(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data``, cut at white space into parts of about PART bytes."""
    at = 0
    while len(data) - at > PART:
        gap = _SPACE.search(data, at + PART)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end
    yield data[at:].split()


def shingle_hashes(text: str, width: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words (A-Z lower-cased, joined by one space), part by part; with fewer words, of the
    whole sequence; without words nothing."""
    tail: list[bytes] = []
    whole = True
    for words in _word_parts(text.encode().lower()):
        words = tail + words
        n = len(words) - width + 1
        if n > 0:
            whole = False
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[:n - 1]]).tolist()
            yield np.fromiter((xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, (ends[width - 1:] - 1).tolist())), np.uint64, n)
            words = words[n:]
        tail = words
    if whole and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), seed)], dtype=np.uint64)


def simhash(text: str, width: int) -> int:
    """64 bits, each 1 if it is set in over half of the text's shingle hashes; 0 without words."""
    counts, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, width):
        for s in range(0, len(hashes), 50_000):
            part = hashes[s:s + 50_000]
            counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint, as a signed long) of every row; null and empty texts have fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t, width) for t in texts(batch.column(1))], dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "doc_id long, fp long")


# --- shards ----------------------------------------------------------------------


def block_masks(radius: int, agree: int) -> list[int]:
    """A mask of bits for each choice of ``agree`` of radius + ``agree`` blocks."""
    n = radius + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(blocks, agree)]


def masks_for(count: int, radius: int) -> list[int]:
    """The masks for ``count`` fingerprints: the fewest blocks for which an even shard holds MEAN at most."""
    agree = 1
    while count * 2.0 ** -min(m.bit_count() for m in block_masks(radius, agree)) > MEAN and agree + radius < 64:
        agree += 1
    return block_masks(radius, agree)


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def shard_members(classes: DataFrame, masks: list[int]) -> DataFrame:
    """fp, its shard (mask, bits), tile, and the pair of tiles (i, j) it is compared in, of all that share a shard."""
    rows = classes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(_signed(m)).alias("bits"))
                                                    for i, m in enumerate(masks)])).alias("s")).select("fp", "s.*")
    sizes = rows.groupBy("mask", "bits").agg(F.count("*").alias("size")).where("size > 1")
    rows = rows.join(sizes.select("mask", "bits", F.ceil(F.col("size") / SHARD).cast("int").alias("tiles")), ["mask", "bits"])
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select("mask", "bits", "fp", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))


# --- trees -----------------------------------------------------------------------


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int64)


class Forest:
    """BK-trees of groups of fingerprints, built and searched level by level for all groups at once.

    values: uint64; groups: ascending group numbers, one tree each.  A tree's root is its first value; a child is the first
    value that came down its edge.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        self.values = values
        roots = np.flatnonzero(np.diff(groups, prepend=-1))
        self.root_of = dict(zip(groups[roots].tolist(), roots.tolist()))
        at = np.repeat(roots, np.diff(np.append(roots, len(values))))
        rest = np.flatnonzero(at != np.arange(len(values)))
        edges, children = [], []
        while len(rest):
            edge = at[rest] * 65 + distance(values[rest], values[at[rest]])  # distances are 0 to 64
            named, first, place = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(named)
            children.append(rest[first])
            at[rest] = rest[first][place]
            rest = rest[at[rest] != rest]
        self.edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.children = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(self.edges)
        self.edges, self.children = self.edges[order], self.children[order]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of queries, places of values within ``radius`` of them), each query searching the tree at its root."""
        stack = [(np.arange(len(queries)), roots)]
        while stack:
            who, node = stack.pop()
            if len(who) > STATES:
                half = len(who) // 2
                stack += [(who[half:], node[half:]), (who[:half], node[:half])]
                continue
            d = distance(queries[who], self.values[node])
            close = d <= radius
            yield who[close], node[close]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), side="right")
            n = high - low
            if n.any():
                who = np.repeat(who, n)
                node = self.children[np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
                stack.append((who, node))


def hooked(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (each place's smallest known place of its component) after the links a - b."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, then := label[label]):
            label = then


def links_of(values: np.ndarray, groups: np.ndarray, tiles: np.ndarray, apart: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, value) that join what is within ``radius`` in the same group, fewer than values.

    ``apart``: by row, whether the group pairs two tiles: the first tile's tree is searched by the other's members only.
    """
    lower = np.minimum.reduceat(tiles, np.flatnonzero(np.diff(groups, prepend=-1)))[np.unique(groups, return_inverse=True)[1]]
    inside = ~apart | (tiles == lower)
    places = np.flatnonzero(inside)
    forest = Forest(values[places], groups[places])
    asking = np.flatnonzero(~apart | (tiles != lower))
    roots = np.array([forest.root_of.get(g, -1) for g in groups[asking].tolist()], dtype=np.int64)
    asking, roots = asking[roots >= 0], roots[roots >= 0]
    label = np.arange(len(values))
    for who, node in forest.search(values[asking], roots, radius):
        label = hooked(label, asking[who], places[node])
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def radius_links(classes: DataFrame, radius: int) -> DataFrame:
    """Links (a, b: fingerprints) that give ``classes`` (fp, distinct) the components of "at most ``radius`` bits differ"."""
    rows = shard_members(classes, masks_for(classes.count(), radius))
    group = ["mask", "bits", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, group):
            keys = [table[c].to_numpy() for c in group]
            new = np.zeros(table.num_rows, dtype=np.int64)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            a, b = links_of(table["fp"].to_numpy().astype(np.uint64), np.cumsum(new), table["tile"].to_numpy(), keys[2] != keys[3], radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], names=["a", "b"])

    return rows.repartition(*group).sortWithinPartitions(*group, "fp").mapInArrow(tidy(run), "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of whole groups, about ``rows`` rows each, of batches sorted by ``key``; groups are bounded by the tiles."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        last = [table[c][-1].as_py() for c in key]
        same = np.logical_and.reduce([table[c].to_numpy() == v for c, v in zip(key, last)])
        cut = int(np.argmax(same))
        if cut:
            yield table.slice(0, cut)
        held = [table.slice(cut)]
    if held and any(t.num_rows for t in held):
        yield pa.concat_tables(held).combine_chunks()


# --- the operator ----------------------------------------------------------------


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable, itself included) of every row.

    Documents link where their fingerprints differ in ``radius`` bits at most; texts without words have fingerprint zero and
    link like any other.  Rows that share a doc_id are rows of their own with their own texts; a row without doc_id is in
    the component of its fingerprint, whose id is null only if no row of it has one.  Empty tables give no rows, extra
    columns are ignored.
    """
    rows = staged(fingerprints(docs, width), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    labels = components(staged(radius_links(classes.select("fp"), radius), "near")).withColumnRenamed("node", "fp")
    classes = classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "component").select("fp", "component_id")
    return rows.join(classes, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
