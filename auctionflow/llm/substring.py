"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is factored against the index of all reference blocks by a lookup of window hashes: every window of
``window`` words is looked up among those of the documents with smaller ids, also the windows that straddle the end of a
factor, so no duplicate hides at a boundary, and the union of the windows found is exact.  A factor is a run of such
windows with one source.  No place in a reference is kept, so factors are not extended along a reference as in a full
relative Lempel-Ziv parse: one long copy can become several factors, and their cuts and sources depend on partitioning.

The index is never whole in one place.  Window starts are grouped into content-defined blocks: consecutive windows with
the same anchor (the least hash among their runs of ``window`` - 7 words).  Equal windows have equal anchors wherever
they stand, so blocks are routed by anchor and meet there; a block carries its document and place once and one 64-bit
hash a window.  Before anything is sent, each flush of a task keeps, for every window, the smallest document it saw and
settles the others on the spot: a passage in a third of all documents leaves a task once.  Anchors that hold a large
share of all windows (edges of very common passages) are counted first, and their windows are routed one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.bitmap import id_bitmap, tester
from auctionflow.llm.shared import mixed, rolling, staged, texts, tidy, word_hashes

SPREAD = 8
#: Rows without doc_id come after all others.
NO_ID = np.int64(2 ** 63 - 1)
#: Texts are hashed in flushes of about so many characters, which bounds a task's memory.
FLUSH_CHARS = 2_000_000
#: An anchor with this share of all windows is split; at most so many anchors can be.
HOT_SHARE = 8192
#: Windows of a block at most; its size is sent as 16 bits.
BLOCK = 60_000

SPANS = "doc_id long, tag long, tag2 long, start long, length long, source long"


def text_tag(text: bytes) -> tuple[int, int]:
    """128 bits that tell apart the texts of rows that share a doc_id, or have none."""
    whole = xxhash.xxh3_128_intdigest(text)
    return tuple(x - 2 ** 64 if x >> 63 else x for x in divmod(whole, 2 ** 64))


class Flush:
    """Windows of some documents: hash, anchor, document and start of each, by ascending document."""

    def __init__(self, docs: list[int], rows: list[bytes], window: int):
        order = np.argsort(np.array(docs, dtype=np.int64), kind="stable")
        words = [rows[i].split() for i in order]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        hashes = np.concatenate([word_hashes(w, len(w)) for w in words]) if len(words) else np.empty(0, np.uint64)
        starts = np.cumsum(sizes) - sizes
        self.docs = np.array(docs, dtype=np.int64)[order]
        self.tags = np.array([text_tag(rows[i]) for i in order], dtype=np.int64).reshape(-1, 2)
        counts = np.maximum(sizes - window + 1, 0)
        self.row = np.repeat(np.arange(len(words)), counts)
        first = np.cumsum(counts) - counts
        self.start = np.arange(len(self.row)) - np.repeat(first, counts)
        at = self.start + starts[self.row]
        if not len(at):
            self.hash = self.anchor = np.empty(0, np.uint64)
            return
        self.hash = rolling(hashes, window)[at]
        least = rolling(hashes, max(1, window - SPREAD + 1))
        reach = 1
        while reach < min(SPREAD, window):
            step = min(reach, min(SPREAD, window) - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        self.anchor = least[at]

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window the smallest document of this flush that has it, and whether that is another one."""
        order = np.argsort(self.hash, kind="stable")  # stable: a window's documents ascend
        run = np.ones(len(order), dtype=bool)
        ordered = self.hash[order]
        run[1:] = ordered[1:] != ordered[:-1]
        heads = self.docs[self.row[order[run]]]
        smallest = np.empty(len(order), dtype=np.int64)
        smallest[order] = heads[np.cumsum(run) - 1]
        return smallest, smallest < self.docs[self.row]


def flushes(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[Flush]:
    docs, rows, chars = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            docs.append(NO_ID if doc is None else doc)
            rows.append(text.encode())
            chars += len(text)
            if chars >= FLUSH_CHARS:
                yield Flush(docs, rows, window)
                docs, rows, chars = [], [], 0
    if docs:
        yield Flush(docs, rows, window)


def runs(row: np.ndarray, start: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Where a new run begins: another row, a gap in the starts, or another value."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1) | (value[1:] != value[:-1])
    return new


def pieces(new: np.ndarray, total: int, most: int) -> np.ndarray:
    """The run starts ``new`` (of ``total`` places) and a start after every ``most`` places within a longer run."""
    parts = -(-np.diff(np.append(new, total)) // most)
    return np.repeat(new, parts) + most * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))


def hot_anchors(rows: DataFrame, window: int) -> np.ndarray:
    """Anchors with at least half of 1 / HOT_SHARE of all windows that are sent; at most twice HOT_SHARE of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flush in flushes(batches, window):
            sent = flush.anchor[~flush.settle()[1]]
            anchors, n = np.unique(sent, return_counts=True)
            many = n * 2 * HOT_SHARE >= len(sent)
            found, n = np.append(anchors[many].astype(np.int64), 0), np.append(n[many], 0)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n), pa.array([0] * (len(n) - 1) + [len(sent)], pa.int64())],
                                             names=["anchor", "n", "windows"])

    counted = staged(rows.mapInArrow(tidy(count), "anchor long, n long, windows long"), "anchors")
    windows = counted.agg(F.sum("windows")).first()[0] or 0
    hot = counted.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") * 2 * HOT_SHARE >= max(windows, 1))
    return np.sort(np.array([r["anchor"] for r in hot.select("anchor").collect()], dtype=np.int64).astype(np.uint64))


_META = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("tag2", "<i8"), ("start", "<u4"), ("n", "<u2")])


def _pack(docs, tags, start, n, hashes) -> bytes:
    """Blocks as bytes: their number, the compressed columns of documents (as steps), tags, starts and sizes, the hashes."""
    columns = b"".join(np.ascontiguousarray(c.astype(_META[k])).tobytes() for k, c in
                       (("doc", np.diff(docs, prepend=np.int64(0))), ("tag", tags[:, 0]), ("tag2", tags[:, 1]), ("start", start), ("n", n)))
    small = pa.compress(columns, codec="zstd", asbytes=True)
    return np.array([len(docs), len(small)], dtype="<u4").tobytes() + small + hashes.tobytes()


def _unpack(blob: bytes):
    count, size = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    columns, at, out = pa.decompress(blob[8:8 + size], decompressed_size=count * _META.itemsize, codec="zstd", asbytes=True), 0, []
    for k in _META.names:
        out.append(np.frombuffer(columns, _META[k], count, at).astype(np.int64))
        at += count * _META[k].itemsize
    return np.cumsum(out[0]), np.stack(out[1:3], axis=1), out[3], out[4], np.frombuffer(blob, "<u8", offset=8 + size)


def duplicate_spans(docs: DataFrame, window: int = 13, buckets: int | None = None) -> DataFrame:
    """Runs of windows of every document that also start in a document with a smaller doc_id.

    Returns doc_id, tag and tag2 (128 bits of the row's text), start (word), length (words covered) and source (the smallest such document
    of the flush where a task settled the run, else of the windows that were sent).  The words covered do not depend on
    partitioning, the cuts between runs and the sources do.  The runs of a document may touch or overlap.  Rows without doc_id count as the last documents and,
    like rows that share a doc_id, are no duplicates of each other; the hash of the whole text tells such rows apart.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 8 * parts
    hot = hot_anchors(rows, window)

    def spans_of(docs_, tags, start, source) -> pa.RecordBatch:
        new = np.flatnonzero(runs(docs_, start, source) | np.append(True, (tags[1:] != tags[:-1]).any(axis=1))) if len(docs_) else np.empty(0, np.int64)
        length = np.diff(np.append(new, len(docs_))) + window - 1
        doc = docs_[new]
        return pa.RecordBatch.from_arrays([pa.array(doc, mask=doc == NO_ID), *(pa.array(x.astype(np.int64)) for x in
                                          (tags[new, 0], tags[new, 1], start[new], length, source[new]))], names=["doc_id", "tag", "tag2", "start", "length", "source"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flush in flushes(batches, window):
            if not len(flush.hash):
                continue
            smallest, known = flush.settle()
            settled = np.flatnonzero(known)
            sink = pa.BufferOutputStream()
            local = spans_of(flush.docs[flush.row[settled]], flush.tags[flush.row[settled]], flush.start[settled], smallest[settled])
            with pa.ipc.new_stream(sink, local.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(local)
            keys, blobs, kinds = [int(flush.tags[0, 0]) % buckets], [sink.getvalue().to_pybytes()], [True]
            at = np.flatnonzero(~known)
            row, start, anchor, hashes = flush.row[at], flush.start[at], flush.anchor[at], flush.hash[at]
            if len(hot):
                anchor = np.where(np.isin(anchor, hot), hashes, anchor)
            new = pieces(np.flatnonzero(runs(row, start, anchor)), len(at), BLOCK)
            sizes = np.diff(np.append(new, len(at)))
            bucket = (mixed(anchor[new], 5) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            new, sizes, bucket = new[order], sizes[order], bucket[order]
            ends = np.cumsum(sizes)
            hashes = hashes[np.repeat(new - (ends - sizes), sizes) + np.arange(len(hashes))]
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own = new[lo:hi]
                keys.append(int(bucket[lo]))
                blobs.append(_pack(flush.docs[row[own]], flush.tags[row[own]], start[own], sizes[lo:hi], hashes[ends[lo] - sizes[lo]:ends[hi - 1]]))
                kinds.append(False)
            for k in range(0, len(keys), 256):
                yield pa.RecordBatch.from_arrays([pa.array(keys[k:k + 256], pa.int64()), pa.array(kinds[k:k + 256]), pa.array(blobs[k:k + 256], pa.binary())],
                                                 names=["bucket", "settled", "blob"])

    def meet(blobs: list[bytes]) -> pa.RecordBatch:
        parts_ = [_unpack(b) for b in blobs]
        doc, tag, start, n, hashes = (np.concatenate(x) for x in zip(*parts_))
        block = np.repeat(np.arange(len(doc)), n)
        place = start[block] + np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
        docs_ = doc[block]
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        least = np.minimum.reduceat(docs_[order], new)
        source = np.empty(len(order), dtype=np.int64)
        source[order] = np.repeat(least, np.diff(np.append(new, len(order))))
        hit = np.flatnonzero(source < docs_)
        return spans_of(docs_[hit], tag[block[hit]], place[hit], source[hit])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if kind:
                    yield from pa.ipc.open_stream(blob.as_py())
                    continue
                if bucket != now and held:
                    yield meet(held)
                    held = []
                now = bucket
                held.append(blob.as_py())
        if held:
            yield meet(held)

    sent = rows.mapInArrow(tidy(send), "bucket long, settled boolean, blob binary")
    return sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(look_up), SPANS)


def factors(spans: list[tuple[int, int, int]], n_words: int) -> list[tuple[int, int, int]]:
    """The greedy parse of one document: disjoint (start, length, source), ascending, from its runs of windows.

    A factor starts at the first covered word not yet in one and extends as far as any run that covers it.
    """
    out: list[tuple[int, int, int]] = []
    at = 0
    spans = sorted((s, -n, src) for s, n, src in spans)
    i, reach, source = 0, 0, 0
    while i < len(spans) or reach > at:
        while i < len(spans) and spans[i][0] <= at:
            if spans[i][0] - spans[i][1] > reach:
                reach, source = spans[i][0] - spans[i][1], spans[i][2]
            i += 1
        if reach > at:
            out.append((at, min(reach, n_words) - at, source))
            at = reach
        elif i < len(spans):
            at = spans[i][0]
    return out


def without_duplicates(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, text (the kept words joined by single spaces) and factors of every row of ``docs``.

    ``spans`` (as of ``duplicate_spans``, staged) meets only the rows that a bitmap of the documents with spans lets
    through; its size is fixed.  Null and empty texts have no words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = lambda c: F.xxhash64(F.coalesce(c, F.lit(int(NO_ID))))
    marked = tester(id_bitmap(spans.select(key(F.col("doc_id")).alias("h"))))
    rows = rows.withColumn("h", key(F.col("doc_id")))
    schema = "doc_id long, n_words long, n_removed long, text string, factors array<struct<start:long,length:long,source:long>>"
    kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string()),
                       ("factors", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("source", pa.int64())])))])

    def cut(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        out: list[list] = [[] for _ in kinds]
        for doc, text, own in zip(batch.column(0).to_pylist(), texts(batch.column(1)), found):
            words = text.encode().split()
            parse = factors([(s["start"], s["length"], s["source"]) for s in own or []], len(words))
            kept, at = [], 0
            for start, length, _ in parse:
                kept += words[at:start]
                at = start + length
            kept += words[at:]
            for column, value in zip(out, (doc, len(words), len(words) - len(kept), b" ".join(kept).decode(),
                                           [{"start": s, "length": n, "source": src} for s, n, src in parse])):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, kinds)], schema=kinds)

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 1000):
            yield batch.slice(start, 1000)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that cannot have spans."""
        test = marked()
        for part in (p for batch in batches for p in slices(batch)):
            part = part.filter(pa.array(~test(part.column(2).to_numpy())))
            yield cut(part, [None] * part.num_rows)

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that may have spans, with their tags."""
        test = marked()
        for part in (p for batch in batches for p in slices(batch)):
            part = part.filter(pa.array(test(part.column(2).to_numpy())))
            tags = np.array([text_tag(t.encode()) for t in texts(part.column(1))], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tags[:, 0].copy()), pa.array(tags[:, 1].copy())],
                                             names=["doc_id", "text", "tag", "tag2"])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch)):
            yield cut(part, part.column(2).to_pylist())

    own = spans.groupBy("doc_id", "tag", "tag2").agg(F.collect_list(F.struct("start", "length", "source")).alias("spans"))
    dirty = rows.mapInArrow(tagged, "doc_id long, text string, tag long, tag2 long")
    on = (F.coalesce(dirty["doc_id"], F.lit(int(NO_ID))) == F.coalesce(own["doc_id"], F.lit(int(NO_ID)))) & (dirty["tag"] == own["tag"]) & (dirty["tag2"] == own["tag2"])
    dirty = dirty.join(own, on, "left").select(dirty["doc_id"], "text", "spans").mapInArrow(parsed, schema)
    return rows.mapInArrow(whole, schema).unionByName(dirty)


def deduplicated(docs: DataFrame, window: int = 13) -> DataFrame:
    """``without_duplicates`` with the staged ``duplicate_spans`` of ``docs`` itself."""
    return without_duplicates(docs, staged(duplicate_spans(docs, window), "spans"))
