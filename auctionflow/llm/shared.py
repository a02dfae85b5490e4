"""Helpers that several corpus operators share: staged tables, split prefix sums, word hashes and Arrow plumbing."""

from __future__ import annotations

import ctypes
import functools
import math
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auctionflow.session import ensure_checkpoint_dir

#: Words are runs of anything but the six ASCII white-space characters (fixed by the operators' contracts).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_STAGED: list[str] = []


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the session's shared checkpoint folder and return the stored table.

    Cuts the lineage, so a lost executor costs a re-read and no recomputation, and keeps columns prunable.
    ``release`` deletes what a session has staged.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the staged tables of this process; call it when no result that reads them is needed any more."""
    jvm, conf, gone = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def bucket_count(rows: int, rows_per_bucket: int) -> int:
    return max(1, math.ceil(rows / rows_per_bucket))


def with_offsets(df: DataFrame, keys: list[str], bucket: str, order: list[str], amount: Column, out: str,
                 extra: DataFrame | None = None, narrow: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows of the same ``keys`` that come before, by (bucket, order).

    ``bucket`` must agree with ``order``, or stand before it, so a hot key is summed bucket by bucket: totals of
    (keys, bucket) are partial aggregates, their running sum sees one row per bucket, and the rows themselves are
    windowed within (keys, bucket).  ``keys`` and ``bucket`` must not be null.  ``extra`` (one row per ``keys``) is
    joined to the totals and so reaches every row without another shuffle of the rows.  ``narrow`` has the same rows as
    ``df`` with fewer columns; the totals are taken from it.
    """
    totals = (df if narrow is None else narrow).groupBy(*keys, bucket).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    if extra is not None:
        totals = totals.join(extra, keys)
    own = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(totals, [*keys, bucket])
            .withColumn(out, (F.col("_base") + F.coalesce(F.sum(amount).over(own), F.lit(0))).cast("long"))
            .drop("_base"))


# --- inside tasks ---------------------------------------------------------------


def tidy(run: Callable) -> Callable:
    """``run`` (batches in, batches out), giving unused memory back to the system when its task ends.

    Python workers are reused by later tasks of any kind; without this each keeps the largest size it ever had.
    """

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # a function of the GNU C library
            if trim is not None:
                trim(0)

    return task


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column; null reads as empty."""
    for value in column:
        yield value.as_py() or ""


def word_hashes(words: Iterable[bytes], count: int) -> np.ndarray:
    """One 64-bit hash a word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=count)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, to draw independent values from a hash."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes, order included (length n - width + 1)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + n]
    return mixed(out)
