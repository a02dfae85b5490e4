"""Near-duplicate documents by fast similarity sketching, banding and verification on the full shingle sets.

A sketch has t coordinates.  In round i < t every shingle of the set is hashed anew to one coordinate and a value, and
coordinates still empty take the least value they get; in round t + i every shingle goes to coordinate i, so after 2t
rounds none is empty whatever the size of the set.  Large sets fill in a round or two.  Coordinates agree with
probability equal to the Jaccard similarity, with the concentration of independent samples.

Bands of coordinates give candidates.  Documents with equal sets are one class first, so exact copies never meet in a
bucket.  In each bucket all members are compared with one leader (as many pairs as rows) and verified links are joined
into components.  Documents of one bucket that are still in different components then meet by an exact prefix filter
on their shingles, which makes pairs only where a link is possible and between components only.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.functions.ordering import order_key
from auctionflow.llm.bitmap import id_bitmap, in_bitmap
from auctionflow.llm.components import merged
from auctionflow.llm.shared import mixed, rolling, staged, texts, tidy, word_hashes

EMPTY = np.uint64(2 ** 64 - 1)

# --- sets and sketches -----------------------------------------------------------


def shingle_set(text: str, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words, as sorted 64-bit hashes; with fewer words, the whole sequence as one.

    A-Z is lower-cased; words are split at ASCII white space.
    """
    words = text.encode().lower().split()
    hashes = word_hashes(words, len(words))
    if not words:
        return hashes
    return np.unique(rolling(hashes, width) if len(words) >= width else mixed(rolling(hashes, len(words)), len(words)))


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` coordinates for each set; rows of empty sets stay EMPTY."""
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    out = np.full((len(sets), size), EMPTY)
    for turn in range(2 * size):
        if not len(values):
            break
        drawn = mixed(values, turn + 1)
        rows, local = np.unique(owners, return_inverse=True)
        at = ((drawn >> np.uint64(33)) % np.uint64(size)).astype(np.int64) if turn < size else np.full(len(drawn), turn - size)
        found = np.full(len(rows) * size, EMPTY)
        # the turn is part of the value: rounds differ even where they place the same shingle
        np.minimum.at(found, local * size + at, np.minimum(mixed(drawn), EMPTY - np.uint64(1)))
        now = out[rows]
        now = np.where(now == EMPTY, found.reshape(len(rows), size), now)
        out[rows] = now
        missing = (now == EMPTY).any(axis=1)
        keep = missing[local]
        owners, values = owners[keep], values[keep]
    return out


def band_keys(rows: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit key a band of ``width`` coordinates, different from band to band."""
    keys = []
    for j in range(rows.shape[1] // width):
        key = np.full(len(rows), j + 1, dtype=np.uint64)
        for c in range(j * width, (j + 1) * width):
            key = mixed(key ^ rows[:, c], 7)
        keys.append(key)
    return np.stack(keys, axis=1)


def sketched(docs: DataFrame, width: int, bands: int, band_rows: int) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit key (hi, lo) and the band keys of every row; null text: no shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()),
                            ("bands", pa.list_(pa.int64()))])
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sets = [shingle_set(t, width) for t in texts(part.column(1))]
                keys = band_keys(sketches(sets, bands * band_rows), band_rows).astype(np.int64)
                with np.errstate(over="ignore"):
                    hi = np.array([mixed(s, 101).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).astype(np.int64)
                    lo = np.array([mixed(s, 202).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).astype(np.int64)
                offsets = np.arange(len(sets) + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hi), pa.array(lo),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        tidy(sketch), "doc_id long, n_shingles long, hi long, lo long, bands array<long>")


# --- links -----------------------------------------------------------------------


def verified(pairs: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Those (a, b) of ``pairs`` with 100 * |intersection| >= ``percent`` * |union| on the full sets."""
    b = documents.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    a = documents.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[str, np.ndarray] = OrderedDict()  # leaders come again and again

        def of(text: str) -> np.ndarray:
            if text not in recent:
                recent[text] = shingle_set(text, width)
                if len(recent) > 64:
                    recent.popitem(last=False)
            recent.move_to_end(text)
            return recent[text]

        for batch in batches:
            keep = []
            for left, right in zip(texts(batch.column(2)), texts(batch.column(3))):
                x, y = of(left), shingle_set(right, width)
                small, large = sorted((len(x), len(y)))
                common = 0
                if 100 * small >= percent * large:
                    common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(small > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(tidy(check), "a long, b long")


def _labelled(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("component", F.col("doc"))
    named = labels.select(F.col("node").alias("doc"), "component")
    return buckets.join(named, "doc", "left").select("bucket", "doc", F.coalesce("component", "doc").alias("component"))


def leader_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b): every member of a bucket with the bucket's smallest document; no more pairs than rows."""
    lead = buckets.groupBy("bucket").agg(F.min("doc").alias("a"))
    return buckets.join(lead, "bucket").where("a < doc").select("a", F.col("doc").alias("b")).distinct()


def prefix_pairs(members: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """All pairs (a, b) of documents in different components of ``members`` (doc, component) that can be similar.

    Exact prefix filtering: in a common order of shingles, rarest first, two similar sets share one of the first
    n - ceil(percent * n / 100) + 1 shingles of either.  Shingles that no other member has take the first places, so a
    document with many edits of its own is settled without a partner.  A pair is made at its first common shingle only,
    and only if what is left of both sets there can still be similar enough.  For each shingle only the documents outside
    its most frequent component look for partners: a large group that is linked already makes no pairs within itself.
    """

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                sets = [shingle_set(t, width) for t in texts(part.column(2))]
                sizes = [len(s) for s in sets]
                rows = pa.array(np.repeat(np.arange(len(sets)), sizes))
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(np.repeat(sizes, sizes).astype(np.int64)),
                                                  pa.array(np.concatenate(sets).astype(np.int64))], names=["doc", "component", "n", "s"])

    own = members.join(documents.select(F.col("doc_id").alias("doc"), "text"), "doc").select("doc", "component", "text")
    each = staged(own.mapInArrow(tidy(shingle), "doc long, component long, n long, s long"), "shingles")
    shared = each.groupBy("s").agg(F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("df > 1")
    each = each.join(shared.select("s", "df", (F.col("lo") < F.col("hi")).alias("across")), "s")
    # one row a document: its shared shingles in the common order; those that are in one component only make no pair
    rows = each.groupBy("doc", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s", "across"))).alias("l"))
    rows = rows.withColumn("alone", F.col("n") - F.size("l"))
    length = (F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 - F.col("alone")).cast("int")
    rows = rows.withColumn("l", F.slice("l", F.lit(1), F.greatest(length, F.lit(0))))
    rows = rows.withColumn("l", F.filter(F.transform("l", lambda x, i: F.struct(x["s"].alias("s"), i.alias("i"), x["across"].alias("across"))), lambda x: x["across"]))
    rows = rows.withColumn("p", F.transform("l", lambda x: x["s"])).select("doc", "component", "n", "alone", "p", F.posexplode("l").alias("k", "x"))
    each = staged(rows.select("doc", "component", F.col("x.s").alias("s"), (F.col("n") - F.col("alone") - F.col("x.i")).alias("rest"), "n",
                              F.slice("p", F.lit(1), F.col("k")).alias("before")), "prefixes")
    sizes = each.groupBy("s", "component").agg(F.count("*").alias("c"))
    main = sizes.groupBy("s").agg(F.max_by("component", order_key("c", "component")).alias("main"), F.count("*").alias("k")).where("k > 1")
    outside = each.join(main, "s").where("component != main").drop("main", "k")
    side = lambda df, t: df.select("s", *[F.col(c).alias(c + t) for c in ("doc", "component", "n", "rest", "before")])
    # at their first common shingle a pair can share no more than what is left of either
    most = F.least("rest_x", "rest_y")
    alike = (F.col("component_x") != F.col("component_y")) & (100 * most >= percent * (F.col("n_x") + F.col("n_y") - most))
    alike = alike & ~F.arrays_overlap("before_x", "before_y")
    pairs = side(outside, "_x").join(side(each, "_y"), "s").where(alike)
    return pairs.select(F.least("doc_x", "doc_y").alias("a"), F.greatest("doc_x", "doc_y").alias("b")).distinct()


def link_classes(buckets: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame | None:
    """node, component of all similar documents that share a bucket (``buckets``: bucket, doc; staged); None if none do."""
    pairs = staged(leader_pairs(buckets), "pairs")
    labels = merged(None, staged(verified(pairs, documents, width, percent), "found"))
    # documents of one bucket in different components: not all of them met
    members = staged(_labelled(buckets, labels), "members")
    mixed_ = members.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    left = staged(members.join(mixed_.select("bucket"), "bucket").select("doc", "component").distinct(), "open")
    if left.isEmpty():
        return labels
    more = staged(prefix_pairs(left, documents, width, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    return merged(labels, staged(verified(more, documents, width, percent), "found"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 30, band_rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) of every row.

    Documents link at 100 * |intersection| >= ``percent`` * |union| of their shingle sets.  Null and empty texts link
    with nothing.  Rows that share a doc_id are one document; a row without doc_id takes the component of the documents
    with its set (null if there is none) and is kept only in the latter case.  With the defaults a pair at 0.8 misses all
    bands once in 7 million.
    """
    rows = staged(sketched(docs, width, bands, band_rows), "sketches")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    classes = staged(full.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id")), "classes")
    heads = full.join(classes, ["hi", "lo", "doc_id"], "left_semi")
    buckets = heads.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"))
    shared = buckets.groupBy("bucket").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("bucket")
    buckets = staged(buckets.join(shared, "bucket"), "buckets")
    texts_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    candidates = staged(texts_of.join(buckets.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidates")
    labels = link_classes(buckets, candidates, width, percent)
    classes = classes.withColumnRenamed("doc_id", "head")
    if labels is not None:
        classes = classes.join(labels.withColumnRenamed("node", "head"), "head", "left")
        classes = classes.select("hi", "lo", F.coalesce("component", "head").alias("component"))
    else:
        classes = classes.withColumnRenamed("head", "component")
    own = F.when(F.col("n_shingles") > 0, F.col("component"))
    out = rows.select("doc_id", "n_shingles", "hi", "lo").join(classes, ["hi", "lo"], "left")
    component = F.coalesce(own, F.col("doc_id")).alias("component_id")
    out = out.select("doc_id", "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, columns as they are, that stay when one document of each near-duplicate group is kept.

    Rows that share a doc_id are one document and leave one row (the least by hash of its text).  Rows without doc_id
    count as documents by their text and come after all others.  Only rows that a bitmap of the dropped and the repeated
    ids lets through are joined; all others pass in place, without a shuffle of their texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    surrogate = F.xxhash64(text).bitwiseAND(F.lit(2 ** 61 - 1)) + F.lit(2 ** 62)
    key = F.coalesce(F.col("doc_id").cast("long"), surrogate)
    found = staged(near_duplicates(docs.select(key.alias("doc_id"), text.alias("text")), width, percent), "groups")
    dropped = found.where("not kept").select(F.col("doc_id").alias("_key"), F.lit(True).alias("_drop"))
    again = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_key"), F.lit(False).alias("_drop"))
    marks = staged(dropped.unionByName(again).groupBy("_key").agg(F.max("_drop").alias("_drop")), "marks")
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"), F.xxhash64(key).alias("_h"))
    rows = in_bitmap(rows, "_h", id_bitmap(marks.select(F.xxhash64("_key").alias("h"))), ["_row", "_key"])
    marked = rows.where("found").join(marks, "_key", "left").where("not coalesce(_drop, false)")
    first = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(F.col("_row.text").cast("string"))))
    marked = marked.withColumn("_n", first).where("_n = 1")
    return rows.where("not found").select("_row.*").unionByName(marked.select("_row.*"))
