"""Window specifications (W1-W5) and window assignment.

Tumbling and sliding windows use Spark's ``window`` (epoch aligned, half
open), so the same code runs on batch and streaming DataFrames.  Session
windows are built in :mod:`auctionflow.operators.sessions`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.functions.time import event_time, from_event_time, ms_interval

TUMBLING, SLIDING, SESSION = "tumbling", "sliding", "session"


@dataclass(frozen=True)
class WindowSpec:
    """``kind`` tumbling / sliding / session; ``size_ms`` is the length, or the
    gap for sessions; ``slide_ms`` only for sliding windows."""

    kind: str
    size_ms: int
    slide_ms: int | None = None

    def __post_init__(self):
        if self.kind not in (TUMBLING, SLIDING, SESSION):
            raise ValueError(f"unknown window kind {self.kind!r}")
        if self.size_ms <= 0:
            raise ValueError("window size must be positive")
        if self.kind == SLIDING:
            if self.slide_ms is None or self.slide_ms <= 0:
                raise ValueError("sliding windows need a positive slide")
            if self.slide_ms > self.size_ms:
                raise ValueError("slide must not exceed the window size")

    @staticmethod
    def from_type(window_type: int, duration_ms: int, slide_ms: int | None = None) -> "WindowSpec":
        """The numeric selector of the reference jobs: 0 tumbling, 1 sliding
        (default slide duration/2), 2 session (duration is the gap)."""
        if window_type == 0:
            return WindowSpec(TUMBLING, duration_ms)
        if window_type == 1:
            return WindowSpec(SLIDING, duration_ms, slide_ms if slide_ms is not None else duration_ms // 2)
        if window_type == 2:
            return WindowSpec(SESSION, duration_ms)
        raise ValueError(f"windowType must be 0, 1 or 2, got {window_type}")


def tumbling(size_ms: int) -> WindowSpec:
    return WindowSpec(TUMBLING, size_ms)


def sliding(size_ms: int, slide_ms: int) -> WindowSpec:
    return WindowSpec(SLIDING, size_ms, slide_ms)


def session(gap_ms: int) -> WindowSpec:
    return WindowSpec(SESSION, gap_ms)


EVENT_TIME = "event_time"


def window_column(spec: WindowSpec, ts_col: str = "ts", streaming: bool = False) -> Column:
    """``window`` struct column (start/end timestamps) for a BIGINT ms column.
    On streams the watermarked ``event_time`` column is used (see
    :func:`auctionflow.streaming.queries.with_event_time`)."""
    t = F.col(EVENT_TIME) if streaming else event_time(ts_col)
    if spec.kind == TUMBLING:
        return F.window(t, ms_interval(spec.size_ms))
    if spec.kind == SLIDING:
        return F.window(t, ms_interval(spec.size_ms), ms_interval(spec.slide_ms))
    return F.session_window(t, ms_interval(spec.size_ms))


def assign_window(df: DataFrame, spec: WindowSpec, ts_col: str = "ts") -> DataFrame:
    """Add ``window_start`` / ``window_end`` (ms) to every row; a row falls in
    one tumbling window and in size/slide sliding windows."""
    if spec.kind == SESSION:
        raise ValueError("session windows depend on other rows; use operators.sessions")
    w = window_column(spec, ts_col)
    return (df.withColumn("_w", w)
              .withColumn("window_start", from_event_time("_w.start"))
              .withColumn("window_end", from_event_time("_w.end"))
              .drop("_w"))


def panes_apply(spec: WindowSpec) -> bool:
    """Batch sliding windows whose size is a multiple of the slide are built
    from panes (one pane = one slide): aggregate per pane first, then expand
    each pane row into the size/slide windows that contain it.  Mergeable
    aggregates give the same result as expanding every input row, but the
    expansion now multiplies pane rows, not events."""
    return spec.kind == SLIDING and spec.size_ms % spec.slide_ms == 0


def pane_start(ts_col: str, spec: WindowSpec) -> Column:
    step = int(spec.slide_ms if spec.kind == SLIDING else spec.size_ms)
    return F.expr(f"{ts_col} - pmod({ts_col}, {step})")


def explode_pane(pane_col: str, spec: WindowSpec) -> Column:
    """Window starts (ms) of every sliding window containing the pane."""
    n = spec.size_ms // spec.slide_ms
    return F.explode(F.sequence(F.col(pane_col) - F.lit((n - 1) * spec.slide_ms), F.col(pane_col),
                                F.lit(spec.slide_ms).cast("long")))
