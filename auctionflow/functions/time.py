"""Time columns.  Public schemas carry BIGINT epoch ms; timestamps are derived
only for ``window`` / ``session_window`` / ``withWatermark``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(col: str | Column) -> Column:
    """Epoch milliseconds (truncated) of a TIMESTAMP_NTZ column, its wall
    clock read as UTC whatever the session time zone: ``timestampdiff`` on
    two NTZ values is plain calendar arithmetic.  (For a zoned TIMESTAMP
    instant use ``F.unix_millis``.)"""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def event_time(col: str | Column = "ts") -> Column:
    """TIMESTAMP column for a BIGINT epoch-ms column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c)


def from_event_time(col: str | Column) -> Column:
    """Epoch ms of a TIMESTAMP column (window bounds etc.)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c)


def ms_interval(ms: int) -> str:
    """Interval string Spark's window functions accept, exact to the ms."""
    if ms <= 0:
        raise ValueError("durations must be positive")
    if ms % 1000 == 0:
        return f"{ms // 1000} seconds"
    return f"{ms} milliseconds"


def utc_wall_clock(col: str | Column) -> Column:
    """TIMESTAMP_NTZ holding the UTC wall clock of an epoch-ms column, so that
    ``year`` / ``month`` do not depend on the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
