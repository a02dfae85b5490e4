"""Bucketed event tables.

Jobs that run again and again over the same events store them bucketed by
the key they group and join on; the shuffle of the input is then done once,
when the table is written.  Bids and auctions are bucketed by
``auction_id``, persons (and auctions, for the new-user joins) by
``person_id``, each bucket sorted by key and time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Compressed bytes of a bucket to aim for.
BUCKET_BYTES = 256 * 1024 * 1024


def bucket_number(input_bytes: int, bucket_bytes: int = BUCKET_BYTES, least: int = 1) -> int:
    """Buckets for ``input_bytes`` of data: a power of two, so tables of different sizes still join bucket by bucket (Spark
    coalesces the finer one where ``spark.sql.bucketing.coalesceBucketsInJoin.enabled`` is set)."""
    return max(least, 2 ** max(0, math.ceil(math.log2(max(1, input_bytes / bucket_bytes)))))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, time: str = "ts",
                   mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as Parquet table ``table``, bucketed by ``key`` into ``buckets`` and sorted by (key, time) within each
    bucket; returns the table.

    Rows are dealt to the buckets before they are written, so each bucket is one file, not one per task.  A key that holds
    a large share of all rows makes a large bucket file; scans of it stay one task, so tables with such keys are better
    left unbucketed (the operators cut hot keys themselves).  ``path`` makes it an external table."""
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    dealt = df.repartition(buckets, F.col(key))
    writer = dealt.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key, time)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def hottest_share(df: DataFrame, key: str) -> float:
    """The share of all rows that the most frequent key holds: whether bucketing by it pays."""
    found = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return found["most"] / found["all"] if found["all"] else 0.0
