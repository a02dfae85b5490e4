"""P5: deterministic 1-in-N sampling per subtask.

The reference counts records per parallel subtask in arrival order.  Here a
subtask is ``pmod(key, subtasks)`` and arrival order is an explicit total
order; the row number is computed by :func:`plans.ordered.sequence_numbers`,
which stays parallel when a subtask holds most of the data.

phase ``"nth"``   keeps rows N, 2N, 3N, ...   (``++seen % N == 0``)
phase ``"first"`` keeps rows 1, N+1, 2N+1, ... (``seen++ % N == 0``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, sequence_numbers


def subtask_of(key: Column, subtasks: int) -> Column:
    if subtasks < 1:
        raise ValueError("subtasks must be >= 1")
    return F.pmod(F.abs(key), F.lit(subtasks)).cast("int")


def sample_every(df: DataFrame, n: int, order_cols: list[str], key_col: str, subtasks: int = 4,
                 phase: str = "nth", rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
                 at_most: DataFrame | int | None = None) -> DataFrame:
    """Keep every n-th row per subtask; adds ``subtask`` and ``seq``.
    ``at_most`` as of :func:`plans.ordered.hot_keys`."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if phase not in ("nth", "first"):
        raise ValueError("phase is 'nth' or 'first'")
    tagged = df.withColumn("subtask", subtask_of(F.col(key_col), subtasks))
    numbered = sequence_numbers(tagged, ["subtask"], order_cols, out="seq", rows_per_slice=rows_per_slice, at_most=at_most)
    keep = (F.col("seq") % n == 0) if phase == "nth" else ((F.col("seq") - 1) % n == 0)
    return numbered.where(keep)
