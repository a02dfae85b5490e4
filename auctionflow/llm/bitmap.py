"""A bitmap of hashed ids: 8 MB whatever the number of ids, so it may go to every task.

It lets through every id that was put in and others by chance, so what passes still joins exactly.  It saves the shuffle
of long texts that cannot have a partner.  Where ids outnumber its bits it lets everything through and saves nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26


def id_bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the column ``h`` (64-bit hashes), as 2^20 words of 64; Spark merges them before they come to the driver."""
    slot = F.shiftrightunsigned("h", 64 - BITS)
    bit = F.expr("shiftleft(1L, cast(_s & 63 as int))")
    words = hashes.select(slot.alias("_s")).select(F.shiftright("_s", 6).alias("word"), bit.alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # 2^20 rows at most
    out = np.zeros(1 << (BITS - 6), dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def tester(bitmap: np.ndarray) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """A function for tasks: call it once a task for the test of hashes (whether each is in ``bitmap``)."""
    set_words = np.flatnonzero(bitmap)
    sparse = bitmap[set_words]  # what is sent grows with the ids up to its bound

    def make() -> Callable[[np.ndarray], np.ndarray]:
        words = np.zeros(1 << (BITS - 6), dtype=np.int64)
        words[set_words] = sparse

        def test(hashes: np.ndarray) -> np.ndarray:
            slot = hashes.astype(np.uint64) >> np.uint64(64 - BITS)
            return ((words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)).astype(np.int64)) & 1).astype(bool)

        return test

    return make


def in_bitmap(rows: DataFrame, hash_column: str, bitmap: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` and found: whether the row's hash is in ``bitmap``."""
    schema = rows.select(*keep, F.lit(True).alias("found")).schema
    make = tester(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            found = test(table[hash_column].to_numpy())
            yield from table.select(keep).append_column("found", pa.array(found)).to_batches()

    return rows.select(*keep, hash_column).mapInArrow(run, schema)
