"""A page log in files: Kafka's model of topics, partitions and offsets.

A log is a folder ``{path}/{topic}/{partition}`` of segments.  A segment is a
file named by its first offset (20 digits, ``.seg``) that holds entries of a
fixed size: the page's timestamp (big-endian int64, epoch ms) and the page.
So offsets follow from names and sizes alone: planning reads no data, a scan
of any range of offsets seeks, and a partition is split into tasks of
``pagesPerTask`` pages.

``spark.read.format("pagelog")`` reads a log as it is,
``spark.readStream.format("pagelog")`` follows it.  A stream starts at the
earliest offset of every partition (or ``startingOffsets=latest``) and its
offsets live in the query's checkpoint, so a restart reads no page twice.
A partition ends with the first page whose backlog is at most its item count
(the producer's end-of-input mark); nothing after it is read, and
:func:`run_to_end` stops a query once it has read all partitions to their
ends.

Paths are read by the driver and the executors with ``pyarrow.fs`` (local and
shared file systems, HDFS, object stores by URI).
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from auctionflow import schemas
from auctionflow.sources.pages import HEADER_BYTES, PAGE_BYTES

ENTRY_BYTES = 8 + PAGE_BYTES
SEGMENT_PAGES = 65_536  # some 540 MB
PAGES_PER_TASK = 8_192  # some 67 MB
#: Pages of one Arrow batch.
BATCH_PAGES = 512

_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                    ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC"))])


@dataclass(frozen=True)
class Segment:
    path: str
    partition: int
    first: int
    pages: int

    @property
    def end(self) -> int:
        return self.first + self.pages


class PageLog:
    """The segments of one topic, by name and size."""

    def __init__(self, path: str, topic: str):
        self.topic = topic
        self.fs, root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        self.root = f"{root.rstrip('/')}/{topic}"

    def segments(self) -> dict[int, list[Segment]]:
        """By partition, ascending; an entry that is still being written does not count."""
        out: dict[int, list[Segment]] = {}
        for f in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            if f.is_file and f.extension == "seg":
                partition = int(f.path.rsplit("/", 2)[1])
                out.setdefault(partition, []).append(Segment(f.path, partition, int(f.base_name.split(".")[0]), f.size // ENTRY_BYTES))
        for partition, own in out.items():
            own.sort(key=lambda s: s.first)
            for a, b in zip(own, own[1:]):
                if a.end != b.first:
                    raise ValueError(f"{self.topic}-{partition}: offsets {a.end} to {b.first} are missing or twice")
        return out

    def read(self, segment: Segment, start: int, end: int) -> Iterator[pa.RecordBatch]:
        """The pages of offsets [start, end) of one segment, with Kafka's columns."""
        with self.fs.open_input_file(segment.path) as f:
            f.seek((start - segment.first) * ENTRY_BYTES)
            for first in range(start, end, BATCH_PAGES):
                n = min(BATCH_PAGES, end - first)
                raw = np.frombuffer(f.read(n * ENTRY_BYTES), dtype=np.uint8).reshape(n, ENTRY_BYTES)
                stamps = raw[:, :8].copy().view(">i8").reshape(-1).astype(np.int64)
                values = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * PAGE_BYTES),
                                                                pa.py_buffer(np.ascontiguousarray(raw[:, 8:]))])
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.binary()), values, pa.array([self.topic] * n), pa.array(np.full(n, segment.partition, np.int32)),
                     pa.array(np.arange(first, first + n)), pa.array(stamps * 1000).cast(pa.timestamp("us", "UTC"))], schema=_ARROW)

    def _ends_input(self, segment: Segment, offset: int) -> bool:
        """Whether the page at ``offset`` is the last by its own header: backlog <= item count."""
        with self.fs.open_input_file(segment.path) as f:
            f.seek((offset - segment.first) * ENTRY_BYTES + 8)
            _, count, backlog = np.frombuffer(f.read(HEADER_BYTES), dtype=[("m", ">i4"), ("n", ">i4"), ("b", ">i8")])[0]
        return bool(backlog <= count)

    def end_of(self, own: list[Segment], start: int | None = None) -> tuple[int, bool]:
        """The offset after a partition's last page to read, and whether its input ends there.

        The backlog falls from page to page, so the end mark is found by bisection from ``start`` on."""
        low, high = max(own[0].first, start or 0), own[-1].end
        if low >= high:
            return high, bool(high > own[0].first and self._ends_input(self._holding(own, high - 1), high - 1))
        if not self._ends_input(self._holding(own, high - 1), high - 1):
            return high, False
        high -= 1  # an end mark; the first one counts
        while low < high:
            mid = (low + high) // 2
            if self._ends_input(self._holding(own, mid), mid):
                high = mid
            else:
                low = mid + 1
        return high + 1, True

    @staticmethod
    def _holding(own: list[Segment], offset: int) -> Segment:
        return own[int(np.searchsorted([s.first for s in own], offset, side="right")) - 1]

    def earliest(self) -> dict[str, int]:
        return {str(p): own[0].first for p, own in self.segments().items()}

    def ends(self) -> dict[str, tuple[int, bool]]:
        """By partition: the offset after its last page, and whether its input is complete."""
        return {str(p): self.end_of(own) for p, own in self.segments().items()}

    def tasks(self, start: dict[str, int], end: dict[str, int], size: int) -> list[InputPartition]:
        """The ranges of offsets [start, end) of every partition, cut into tasks within segments."""
        out = []
        for partition, own in sorted(self.segments().items()):
            low, high = start.get(str(partition), own[0].first), end.get(str(partition), 0)
            if low < own[0].first:
                raise ValueError(f"{self.topic}-{partition}: offsets {low} to {own[0].first} are gone")
            for s in own:
                for a in range(max(low, s.first), min(high, s.end), size):
                    out.append(InputPartition((s, a, min(a + size, high, s.end))))
        return out


class _Options:
    def __init__(self, options):
        if "path" not in options or "topic" not in options:
            raise ValueError("pagelog needs the options path and topic")
        self.path, self.topic = options["path"], options["topic"]
        self.size = int(options.get("pagesPerTask", PAGES_PER_TASK))
        self.most = int(options["maxPagesPerTrigger"]) if "maxPagesPerTrigger" in options else None
        self.starting = options.get("startingOffsets", "earliest")
        if self.starting not in ("earliest", "latest"):
            raise ValueError("startingOffsets is 'earliest' or 'latest'")

    @property
    def log(self) -> PageLog:
        return PageLog(self.path, self.topic)


class _Reader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        log = self.options.log
        return log.tasks({}, {p: end for p, (end, _) in log.ends().items()}, self.options.size) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from self.options.log.read(*partition.value)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: _Options):
        self.options = options
        self._at: dict[str, int] | None = None  # the last offsets given out

    def initialOffset(self) -> dict:
        log = self.options.log
        if self.options.starting == "latest":
            return {p: end for p, (end, _) in log.ends().items()}
        return log.earliest()

    def latestOffset(self) -> dict:
        log = self.options.log
        own = log.segments()
        at = self._at if self._at is not None else {}
        out = {}
        for p, segments in own.items():
            low = at.get(str(p), segments[0].first)
            end, _ = log.end_of(segments)
            if self.options.most is not None and self._at is not None:
                end = min(end, low + max(1, self.options.most // len(own)))
            out[str(p)] = max(low, end)
        if self.options.most is not None and self._at is None:
            # the engine asks for the latest offsets before it names those it starts from
            return out
        self._at = out
        return out

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self._at = {**end}
        return self.options.log.tasks(start, end, self.options.size) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from self.options.log.read(*partition.value)

    def commit(self, end: dict) -> None:
        pass  # offsets live in the query's checkpoint

    def stop(self) -> None:
        pass


class PageLogSource(DataSource):
    """``format("pagelog")``; options ``path``, ``topic``, ``pagesPerTask``,
    ``startingOffsets`` (earliest, latest) and ``maxPagesPerTrigger`` (not for
    the first batch after a start)."""

    @classmethod
    def name(cls) -> str:
        return "pagelog"

    def schema(self) -> StructType:
        return schemas.PAGE

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_Options(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_Options(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageLogSource)


def append(pages: DataFrame, path: str, segment_pages: int = SEGMENT_PAGES) -> int:
    """Write Kafka-shaped page rows as segments and return the number of pages.

    The rows of one segment meet in one task, sorted by offset.  A segment is
    written beside its place and moved there whole, so a task that runs again
    leaves the same file and readers never see half of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, f, place, n = None, None, None, 0
        log = None
        for batch in batches:
            topics, partitions, offsets = (batch.column(c).to_pylist() for c in ("topic", "partition", "offset"))
            stamps = batch.column("_ms").to_pylist()
            for topic, partition, offset, stamp, value in zip(topics, partitions, offsets, stamps, batch.column("value")):
                key = (topic, partition, offset // segment_pages)
                if key != now:
                    if f is not None:
                        f.close()
                        log.fs.move(f"{place}.part", place)
                    log, now = PageLog(path, topic), key
                    folder = f"{log.root}/{partition}"
                    log.fs.create_dir(folder, recursive=True)
                    place = f"{folder}/{offset:020d}.seg"
                    f = log.fs.open_output_stream(f"{place}.part")
                data = value.as_py()
                if len(data) != PAGE_BYTES:
                    raise ValueError(f"a page of {len(data)} bytes at {topic}-{partition}, offset {offset}")
                f.write(int(stamp).to_bytes(8, "big", signed=True) + data)
                n += 1
        if f is not None:
            f.close()
            log.fs.move(f"{place}.part", place)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows = pages.select("topic", "partition", "offset", "value", F.unix_millis("timestamp").alias("_ms"))
    rows = rows.withColumn("_segment", F.expr(f"offset div {int(segment_pages)}"))
    rows = rows.repartition("topic", "partition", "_segment").sortWithinPartitions("topic", "partition", "offset")
    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def offsets_read(query) -> dict[str, int]:
    """The offsets up to which a query's last batch has read its (first) page log."""
    progress = query.lastProgress
    for source in (json.loads(progress.json)["sources"] if progress else []):
        if "PythonMicroBatchStream" in source["description"]:
            return source["endOffset"] or {}
    return {}


def run_to_end(query, path: str, topic: str, timeout_s: float | None = None, poll_s: float = 0.5) -> bool:
    """Wait until ``query`` has read every partition of the log to its end of
    input, then stop it; False if it ended by itself or time ran out."""
    log = PageLog(path, topic)
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    while query.isActive and (deadline is None or time.monotonic() < deadline):
        ends, at = log.ends(), offsets_read(query)
        if ends and all(done and at.get(p, -1) >= end for p, (end, done) in ends.items()):
            query.processAllAvailable()
            query.stop()
            return True
        time.sleep(poll_s)
    if query.isActive:
        query.stop()
    return False
