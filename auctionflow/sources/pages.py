"""Binary event pages.

A page is one Kafka message of exactly 8192 bytes, big-endian:
``magic int32, item_count int32, backlog int64`` and then fixed-size records.

* :func:`read_pages`     Kafka (batch or stream) or Parquet files with Kafka's columns.
* :func:`validate_pages` length / magic / capacity checks as SQL expressions
  (fail, drop or quarantine).
* :func:`decode_pages`   one page row -> N record rows with ``mapInArrow``
  (``numpy.frombuffer`` on a big-endian record dtype, vectorised per batch).
  Arithmetic on wire integers wraps like Java's (numpy), and fixed-width
  strings keep their padding unless ``strip_padding``.
* :func:`page_progress`  per topic/partition progress and end-of-input (S9).
* :func:`write_pages`    the page writer used for fixtures and round trips.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auctionflow import schemas
from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, sequence_numbers

PAGE_BYTES = 8192
HEADER_BYTES = 16

# Default topics; a deployment may name its own (no page check reads them).
PERSONS_TOPIC = "persons"
AUCTIONS_TOPIC = "auctions"
BIDS_TOPIC = "bids"
# Fixed values of the wire format (must equal the producer's).
PERSON_MAGIC = 0x30011991
AUCTION_MAGIC = 0x30061992
BID_MAGIC = 0xDEEDBEAF  # read as signed int32: -554844497

BID_DTYPE = np.dtype([("bidder", ">i8"), ("auction", ">i8"), ("price", ">f8"), ("ts", ">i8")])
AUCTION_DTYPE = np.dtype([("id", ">i8"), ("seller", ">i8"), ("category", "i1"), ("item", ">i4"),
                          ("start", ">i8"), ("end", ">i8"), ("price", ">i4"), ("name", "V20"),
                          ("descr", "V200"), ("ts", ">i8")])
PERSON_DTYPE = np.dtype([("id", ">i8"), ("first", "V32"), ("last", "V32"), ("domain", "V32"),
                         ("city", "V32"), ("country", "V32"), ("card0", ">i8"), ("card1", ">i8"),
                         ("a", ">i4"), ("b", ">i4"), ("c", ">i4"), ("sex", ">i2"), ("ts", ">i8")])


@dataclass(frozen=True)
class PageKind:
    name: str
    topic: str
    magic: int
    dtype: np.dtype

    @property
    def record_bytes(self) -> int:
        return self.dtype.itemsize

    @property
    def capacity(self) -> int:
        return (PAGE_BYTES - HEADER_BYTES) // self.dtype.itemsize

    @property
    def magic_hex(self) -> str:
        return f"{self.magic & 0xFFFFFFFF:08X}"


KINDS = {
    "bid": PageKind("bid", BIDS_TOPIC, BID_MAGIC, BID_DTYPE),
    "auction": PageKind("auction", AUCTIONS_TOPIC, AUCTION_MAGIC, AUCTION_DTYPE),
    "person": PageKind("person", PERSONS_TOPIC, PERSON_MAGIC, PERSON_DTYPE),
}

# Writer input columns per kind (raw wire fields).
WRITER_COLUMNS = {
    "bid": ["person_id", "auction_id", "bid", "ts"],
    "auction": ["auction_id", "person_id", "category_id", "item_id", "start", "end", "initial_price",
                "name", "descr", "ts"],
    "person": ["person_id", "first", "last", "domain", "city", "country", "card0", "card1", "a", "b", "c",
               "sex", "ts"],
}


def kind_of(kind: str) -> PageKind:
    try:
        return KINDS[kind]
    except KeyError:
        raise ValueError(f"page kind must be one of {sorted(KINDS)}") from None


# --------------------------------------------------------------------------- read

def read_pages(spark: SparkSession, source: str | dict, kind: str, stream: bool = False) -> DataFrame:
    """S1-S3, S11.  ``source`` is a path of Parquet page files (Kafka's column
    names), a dict of options of a page log in files (``{"format":
    "pagelog", "path": ...}``, :mod:`sources.pagelog`), or a dict of Kafka
    options (``kafka.bootstrap.servers`` ...); the topic defaults to the
    kind's topic and reading starts at the earliest offset.  The Kafka
    connector jar must be on the classpath for Kafka."""
    k = kind_of(kind)
    if isinstance(source, dict) and source.get("format") == "pagelog":
        from auctionflow.sources import pagelog
        pagelog.register(spark)
        reader = spark.readStream if stream else spark.read
        return reader.format("pagelog").options(**{"topic": k.topic, **{o: v for o, v in source.items() if o != "format"}}).load()
    if isinstance(source, dict):
        opts = {"subscribe": k.topic, "startingOffsets": "earliest"}
        opts.update(source)
        reader = spark.readStream if stream else spark.read
        return reader.format("kafka").options(**opts).load()
    reader = spark.readStream.schema(schemas.PAGE) if stream else spark.read.schema(schemas.PAGE)
    return reader.parquet(source)


# ----------------------------------------------------------------------- validate

def _u32(value: Column, pos: int) -> Column:
    return F.conv(F.hex(F.substring(value, pos, 4)), 16, 10).cast("long")


def header_columns(value: Column | None = None) -> list[Column]:
    """``page_magic`` (hex), ``item_count`` (signed), ``backlog`` (signed)."""
    value = F.col("value") if value is None else value
    cnt = _u32(value, 5)
    return [F.hex(F.substring(value, 1, 4)).alias("page_magic"),
            F.when(cnt >= 2**31, cnt - 2**32).otherwise(cnt).alias("item_count"),
            F.conv(F.hex(F.substring(value, 9, 8)), 16, -10).cast("long").alias("backlog")]


def page_problem(kind: str, value: Column | None = None) -> Column:
    """NULL for a valid page, else the first violated rule."""
    value = F.col("value") if value is None else value
    k = kind_of(kind)
    cnt = _u32(value, 5)
    return (F.when(F.length(value) != PAGE_BYTES, F.lit("length"))
             .when(F.hex(F.substring(value, 1, 4)) != F.lit(k.magic_hex), F.lit("magic"))
             .when(cnt > F.lit(k.capacity), F.lit("count")))


def validate_pages(pages: DataFrame, kind: str, on_error: str = "fail"):
    """S4.  ``fail``: the job fails at the first bad page; ``drop``: bad pages
    are filtered out; ``quarantine``: returns ``(good, bad)`` with a
    ``problem`` column on ``bad``."""
    problem = page_problem(kind)
    if on_error == "fail":
        check = F.when(problem.isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"invalid {kind} page ("), problem, F.lit(") at offset "),
                                   F.coalesce(F.col("offset").cast("string"), F.lit("?")))))
        return pages.where(check)
    if on_error == "drop":
        return pages.where(problem.isNull())
    if on_error == "quarantine":
        tagged = pages.withColumn("problem", problem)
        return tagged.where(F.col("problem").isNull()).drop("problem"), tagged.where(F.col("problem").isNotNull())
    raise ValueError("on_error is 'fail', 'drop' or 'quarantine'")


# ------------------------------------------------------------------------- decode

def _fixed(records: np.ndarray, field: str, width: int, strip: bool) -> pa.Array:
    raw = np.ascontiguousarray(records[field]).view(np.uint8).tobytes()
    arr = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(records), [None, pa.py_buffer(raw)])
    try:
        s = pc.cast(pc.cast(arr, pa.binary()), pa.string())
    except pa.ArrowInvalid:
        # invalid UTF-8 in a text field: decode with replacement characters
        # (as a JVM String constructor would) instead of failing the job
        s = pa.array([v.decode("utf-8", "replace") for v in arr.to_pylist()], pa.string())
    return pc.utf8_rtrim(s, characters="\x00") if strip else s


def _page_matrix(values: pa.Array) -> np.ndarray:
    """(n, 8192) uint8 view of a binary column whose values all have the page
    length (guaranteed by validation); falls back to a copy otherwise."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    width = 8 if pa.types.is_large_binary(values.type) else 4
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64 if width == 8 else np.int32,
                            count=len(values) + 1, offset=values.offset * width)
    if np.all(np.diff(offsets) == PAGE_BYTES):
        data = np.frombuffer(values.buffers()[2], dtype=np.uint8)
        return data[offsets[0]:offsets[0] + len(values) * PAGE_BYTES].reshape(len(values), PAGE_BYTES)
    rows = [v if len(v) == PAGE_BYTES else v[:PAGE_BYTES].ljust(PAGE_BYTES, b"\0") for v in values.to_pylist()]
    return np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), PAGE_BYTES)


def _decode_batches(kind: str, strip: bool):
    """Vectorised per Arrow batch: page headers are read as one big-endian
    int32 column, the record area of every page is viewed as
    (pages, capacity, record_bytes) and the used slots are taken with a
    mask; no Python work per page or per record."""
    k = kind_of(kind)
    cap, size = k.capacity, k.record_bytes

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pages_ = _page_matrix(batch.column("value"))
            counts = pages_[:, 4:8].copy().view(">i4").reshape(-1).astype(np.int64)
            counts = np.clip(counts, 0, cap)
            ingest = batch.column("_ing").to_numpy(zero_copy_only=False).astype(np.int64)
            body = pages_[:, HEADER_BYTES:HEADER_BYTES + cap * size].reshape(len(pages_), cap, size)
            used = np.arange(cap)[None, :] < counts[:, None]
            if not used.any():
                continue
            rec = np.ascontiguousarray(body[used]).view(k.dtype).reshape(-1)
            yield _records_to_arrow(kind, rec, np.repeat(ingest, counts), strip)
    return run


def _records_to_arrow(kind: str, rec: np.ndarray, ing_ts: np.ndarray, strip: bool) -> pa.RecordBatch:
    def i64(x):
        return pa.array(np.asarray(x, dtype=np.int64))

    if kind == "bid":
        n = len(rec)
        return pa.RecordBatch.from_arrays(
            [i64(ing_ts), i64(rec["ts"]), i64(rec["auction"]), i64(rec["bidder"]),
             i64(np.full(n, -1)), pa.array(rec["price"].astype(np.float64))],
            names=schemas.names(schemas.BID))
    if kind == "auction":
        return pa.RecordBatch.from_arrays(
            [i64(rec["ts"]), i64(rec["id"]), i64(rec["seller"]), i64(rec["item"]),
             pa.array(rec["price"].astype(np.float64)), i64(rec["start"]), i64(rec["end"]),
             i64(rec["category"]), i64(ing_ts), _fixed(rec, "name", 20, strip), _fixed(rec, "descr", 200, strip)],
            names=schemas.names(schemas.AUCTION))
    first, last = _fixed(rec, "first", 32, strip), _fixed(rec, "last", 32, strip)
    domain = _fixed(rec, "domain", 32, strip)
    email = pc.binary_join_element_wise(pc.binary_join_element_wise(first, last, "."), domain, "@")
    name = pc.binary_join_element_wise(first, last, " ")
    with np.errstate(over="ignore"):
        province = (rec["a"].astype(np.int32) - rec["c"].astype(np.int32)).astype(np.int32)
        zipcode = (rec["b"].astype(np.int32) - rec["c"].astype(np.int32)).astype(np.int32)
        card = (rec["card0"].astype(np.int64) + rec["card1"].astype(np.int64)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [i64(rec["ts"]), i64(rec["id"]), name, email, _fixed(rec, "city", 32, strip),
         _fixed(rec, "country", 32, strip), pc.cast(pa.array(province), pa.string()),
         pc.cast(pa.array(zipcode), pa.string()), email, pc.cast(pa.array(card), pa.string()), i64(ing_ts)],
        names=schemas.names(schemas.PERSON))


def decode_pages(pages: DataFrame, kind: str, ingestion_col: Column | None = None,
                 strip_padding: bool = False, validate: str | None = "fail") -> DataFrame:
    """Page rows -> record rows of the kind's schema.
    ``ingestion_col`` (epoch ms) defaults to the Kafka ``timestamp``; pass
    ``F.unix_millis(F.current_timestamp())`` for wall-clock stamping.
    ``validate`` is "fail" (default), "drop" or None.  Only ``value`` and the
    ingestion time enter the Python worker."""
    if validate == "quarantine":
        raise ValueError("split pages with validate_pages(..., 'quarantine') and decode the good ones")
    if validate:
        pages = validate_pages(pages, kind, validate)
    ing = ingestion_col if ingestion_col is not None else F.unix_millis(F.col("timestamp"))
    narrow = pages.select("value", ing.cast("long").alias("_ing"))
    schema = {"bid": schemas.BID, "auction": schemas.AUCTION, "person": schemas.PERSON}[kind]
    return narrow.mapInArrow(_decode_batches(kind, strip_padding), schema)


# ----------------------------------------------------------------------- progress

def page_progress(pages: DataFrame) -> DataFrame:
    """Per topic and partition: pages, items, the smallest backlog and
    whether the input is complete (some page has backlog <= its item count,
    the reference's end-of-stream test).  A partial aggregate."""
    h = pages.select("topic", "partition", *header_columns())
    return (h.groupBy("topic", "partition")
             .agg(F.count(F.lit(1)).alias("pages"), F.sum("item_count").alias("items"),
                  F.min("backlog").alias("min_backlog"),
                  F.max(F.col("backlog") <= F.col("item_count")).alias("is_complete")))


# ------------------------------------------------------------------------ writer

def _fixed_ascii(arr, width: int) -> np.ndarray:
    """Strings cut to ``width`` characters and US-ASCII encoded (others
    become '?'), NUL padded, as an (n, width) uint8 matrix."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    s = pc.fill_null(arr.cast(pa.string()), "")
    s = pc.replace_substring_regex(s, r"[^\x00-\x7f]", "?")
    b = pc.cast(pc.utf8_slice_codeunits(s, 0, width), pa.binary())
    n = len(b)
    offsets = np.frombuffer(b.buffers()[1], dtype=np.int32, count=n + 1, offset=b.offset * 4)
    data = np.frombuffer(b.buffers()[2], dtype=np.uint8) if b.buffers()[2] is not None else np.zeros(0, np.uint8)
    out = np.zeros((n, width), dtype=np.uint8)
    out[np.arange(width)[None, :] < np.diff(offsets)[:, None]] = data[offsets[0]:offsets[-1]]
    return out


def _encode_records(kind: str, t: pa.Table) -> np.ndarray:
    """Records of ``t`` as an (n, record_bytes) uint8 matrix (big-endian)."""
    k = kind_of(kind)
    rec = np.zeros(t.num_rows, dtype=k.dtype)

    def col(name, dtype=np.int64):
        return t.column(name).to_numpy(zero_copy_only=False).astype(dtype)

    def text(name, width):
        return _fixed_ascii(t.column(name), width).view(f"V{width}").reshape(-1)

    if kind == "bid":
        rec["bidder"], rec["auction"] = col("person_id"), col("auction_id")
        rec["price"], rec["ts"] = col("bid", np.float64), col("ts")
    elif kind == "auction":
        rec["id"], rec["seller"] = col("auction_id"), col("person_id")
        rec["category"] = col("category_id").astype(np.int8)
        rec["item"] = col("item_id").astype(np.int32)
        rec["start"], rec["end"] = col("start"), col("end")
        rec["price"] = col("initial_price", np.float64).astype(np.int64).astype(np.int32)
        rec["name"], rec["descr"] = text("name", 20), text("descr", 200)
        rec["ts"] = col("ts")
    else:
        rec["id"] = col("person_id")
        for f in ("first", "last", "domain", "city", "country"):
            rec[f] = text(f, 32)
        for f in ("card0", "card1", "a", "b", "c", "sex", "ts"):
            rec[f] = col(f)
    return rec.view(np.uint8).reshape(t.num_rows, k.record_bytes)


def _encode_pages(kind: str):
    """Rows sorted by (partition, page, seq) -> one row per page, vectorised
    per Arrow batch: records are written into a (pages, capacity,
    record_bytes) view of a zeroed page matrix.  A page may straddle two
    batches, so the unfinished last page is carried."""
    k = kind_of(kind)
    cap, size = k.capacity, k.record_bytes
    magic = k.magic if k.magic < 2**31 else k.magic - 2**32
    out_schema = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.binary()),
                            ("_ts", pa.int64())])

    def flush(t: pa.Table) -> pa.RecordBatch:
        part = t.column("_part").to_numpy(zero_copy_only=False).astype(np.int64)
        page = t.column("_page").to_numpy(zero_copy_only=False).astype(np.int64)
        seq = t.column("_seq").to_numpy(zero_copy_only=False).astype(np.int64)
        ts = t.column("ts").to_numpy(zero_copy_only=False).astype(np.int64)
        backlog = t.column("_backlog").to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (page[1:] != page[:-1])])
        idx = np.cumsum(np.r_[True, (part[1:] != part[:-1]) | (page[1:] != page[:-1])]) - 1
        n_pages = len(starts)
        mat = np.zeros((n_pages, PAGE_BYTES), dtype=np.uint8)
        header = np.zeros(n_pages, dtype=[("m", ">i4"), ("n", ">i4"), ("b", ">i8")])
        header["m"], header["n"], header["b"] = magic, np.bincount(idx, minlength=n_pages), backlog[starts]
        mat[:, :HEADER_BYTES] = header.view(np.uint8).reshape(n_pages, HEADER_BYTES)
        body = mat[:, HEADER_BYTES:HEADER_BYTES + cap * size].reshape(n_pages, cap, size)
        body[idx, (seq - 1) % cap] = _encode_records(kind, t)
        offsets = np.arange(n_pages + 1, dtype=np.int32) * PAGE_BYTES
        value = pa.Array.from_buffers(pa.binary(), n_pages, [None, pa.py_buffer(offsets), pa.py_buffer(mat)])
        return pa.RecordBatch.from_arrays(
            [pa.array(part[starts].astype(np.int32)), pa.array(page[starts]), value,
             pa.array(np.maximum.reduceat(ts, starts))], schema=out_schema)

    def run(batches):
        carry = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if carry is not None:
                t = pa.concat_tables([carry, t])
            if t.num_rows == 0:
                continue
            part = t.column("_part").to_numpy(zero_copy_only=False)
            page = t.column("_page").to_numpy(zero_copy_only=False)
            tail = (part == part[-1]) & (page == page[-1])
            first_tail = int(np.argmax(tail))
            carry = t.slice(first_tail)
            if first_tail > 0:
                yield flush(t.slice(0, first_tail).combine_chunks())
        if carry is not None and carry.num_rows:
            yield flush(carry.combine_chunks())
    return run


def write_pages(records: DataFrame, kind: str, order_cols: list[str], partitions: int = 1,
                partition_key: str | None = None, topic: str | None = None,
                rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """Pack records into pages (Kafka-shaped rows).  Records are routed to
    ``pmod(partition_key, partitions)``, numbered per partition in
    ``order_cols`` order (parallel within a partition) and cut into pages of
    the kind's capacity; the offset is the page number, the backlog the
    records left in the partition from this page on, and the Kafka
    timestamp the page's greatest record ts.  Each page is built from at
    most ``capacity`` rows (255 / 30 / 39): the per-page carry is bounded."""
    k = kind_of(kind)
    cols = WRITER_COLUMNS[kind]
    part = F.pmod(F.col(partition_key), F.lit(partitions)) if partition_key else F.lit(0)
    r = records.select(*dict.fromkeys(cols + order_cols)).withColumn("_part", part.cast("int"))
    r = sequence_numbers(r, ["_part"], order_cols, out="_seq", rows_per_slice=rows_per_slice)
    totals = r.groupBy("_part").agg(F.count(F.lit(1)).alias("_total"))
    r = (r.join(totals, "_part")
          .withColumn("_page", F.expr(f"(_seq - 1) div {k.capacity}"))
          .withColumn("_backlog", F.col("_total") - F.col("_page") * F.lit(k.capacity)))
    out_schema = "partition int, offset long, value binary, _ts long"
    # pages are contiguous runs of (partition, page): cluster and sort, then
    # stream them through one vectorised Arrow pass
    pages = (r.repartition("_part", "_page").sortWithinPartitions("_part", "_page", "_seq")
              .mapInArrow(_encode_pages(kind), out_schema))
    return pages.select(F.lit(None).cast("binary").alias("key"), "value",
                        F.lit(topic or k.topic).alias("topic"), "partition", "offset",
                        F.timestamp_millis("_ts").alias("timestamp"))
