"""Latency sinks K1-K7.

"Now" is a column (``processed_ts``: the window or round close, or any
deterministic time), never the wall clock, so results are reproducible.

The reference keeps running statistics per sink subtask and writes one CSV
line per accepted record.  Here the running statistics are window
aggregates per subtask in a total order, computed by
:func:`plans.ordered.running_aggregates` (parallel within a subtask);
:func:`latency_summary` gives the final, fully parallel form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.operators.aggregates import exact_std, latency_summary  # noqa: F401
from auctionflow.operators.sampling import subtask_of
from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, fits_a_slice, running_aggregates
from auctionflow.session import ensure_checkpoint_dir

LATENCY_THRESHOLD_MS = 10 * 60 * 1000

# Fixed: the column names and their order must equal the published CSV headers.
Q8_COLUMNS = ["subtask", "ts", "personCount", "auctionCount", "flightTimeCount", "personMean", "auctionMean",
              "flightTimeMean", "personMin", "auctionMin", "flightTimeMin", "personMax", "auctionMax",
              "flightTimeMax"]
BID_COLUMNS = ["subtask", "ts", "bidLatencyCount", "flightTimeCount", "bidLatencyMean", "flightTimeMean",
               "bidLatencyMin", "flightTimeMin", "bidLatencyMax", "flightTimeMax"]
WINNING_COLUMNS = BID_COLUMNS[:6] + ["bidLatencyStd", "flightTimeStd"] + BID_COLUMNS[6:] + \
    ["bidLatencySum", "flightTimeSum"]


def _mean(prefix: str) -> Column:
    return F.when(F.col(f"{prefix}_rcount") > 0, F.col(f"{prefix}_rsum") / F.col(f"{prefix}_rcount"))


def q8_records(records: DataFrame, processed: Column, threshold_ms: int = LATENCY_THRESHOLD_MS) -> DataFrame:
    """P2/P3 on J2 output: person rows (id > 0) give a person latency when it
    is < threshold; other rows give auction latency and flight time when the
    auction latency is <= threshold, and only those rows write a line.
    Adds ``processed_ts, person, auction, flight, _emit`` (replacing any
    input columns of those names)."""
    r = records.withColumn("processed_ts", processed).drop("person", "auction", "flight", "_emit")
    is_person = F.col("person_id") > 0
    p_lat = F.col("processed_ts") - F.col("person_creation_ts")
    a_lat = F.col("processed_ts") - F.col("auction_creation_ts")
    f_lat = F.col("processed_ts") - F.col("auction_ingestion_ts")
    accepted = ~is_person & (a_lat <= threshold_ms)
    return r.select("*",
                    F.when(is_person & (p_lat < threshold_ms), p_lat).alias("person"),
                    F.when(accepted, a_lat).alias("auction"),
                    F.when(accepted, f_lat).alias("flight"),
                    accepted.alias("_emit"))


def bid_records(results: DataFrame, processed: Column, threshold_ms: int = LATENCY_THRESHOLD_MS) -> DataFrame:
    """P2 on (key, last_ts, last_ingestion_ts) results: accepted when
    processed - last_ts <= threshold.  Adds ``processed_ts, bid, flight,
    _emit`` (replacing any input columns of those names)."""
    r = results.withColumn("processed_ts", processed).drop("bid", "flight", "_emit")
    lat = F.col("processed_ts") - F.col("last_ts")
    accepted = lat <= threshold_ms
    return r.select("*", F.when(accepted, lat).alias("bid"),
                    F.when(accepted, F.col("processed_ts") - F.col("last_ingestion_ts")).alias("flight"),
                    accepted.alias("_emit"))


def series_of(kind: str) -> tuple[list[str], list[str]]:
    """The series of a kind of latency lines and its columns."""
    if kind == "q8":
        return ["person", "auction", "flight"], Q8_COLUMNS
    if kind in ("q5", "session", "winning"):
        return ["bid", "flight"], WINNING_COLUMNS if kind == "winning" else BID_COLUMNS
    raise ValueError(f"unknown latency kind {kind!r}")


def line_columns(kind: str, time: str = "processed_ts") -> list[Column]:
    """The columns of a line from running statistics (``{series}_rcount``, ``_rsum``, ``_rmin``, ``_rmax``, ``_rss``)."""
    series, layout = series_of(kind)
    names = {"person": "person", "auction": "auction", "bid": "bidLatency", "flight": "flightTime"}
    out = {"subtask": F.col("subtask"), "ts": F.col(time)}
    for s in series:
        n = names[s]
        out[f"{n}Count"] = F.col(f"{s}_rcount")
        out[f"{n}Mean"] = _mean(s)
        out[f"{n}Min"] = F.col(f"{s}_rmin")
        out[f"{n}Max"] = F.col(f"{s}_rmax")
        out[f"{n}Std"] = exact_std(F.col(f"{s}_rcount"), F.col(f"{s}_rsum"), F.col(f"{s}_rss"))
        out[f"{n}Sum"] = F.col(f"{s}_rsum")
    return [out[c].alias(c) for c in layout]


def running_latency(records: DataFrame, kind: str, key_col: str, order_cols: list[str],
                    subtasks: int = 4, rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
                    checkpoint: bool = True, close_lines: bool = False, at_most: DataFrame | int | None = None) -> DataFrame:
    """K1-K4 lines.  ``records`` come from :func:`q8_records` (kind "q8") or
    :func:`bid_records` (kinds "q5", "session", "winning").  Rows are routed
    to ``pmod(|key|, subtasks)`` and ordered by ``processed_ts`` then
    ``order_cols``; counts are real counts (the reference's K3/K4 write sums
    under the count headers; "winning" adds separate sum columns).
    ``close_lines`` appends each subtask's closing line (statistics over all
    its rows, ts = its last processed time).  ``at_most`` (a table with at
    least as many rows, such as the events behind the records, or their
    number) saves the checkpoint and the count of subtasks' rows where all
    records fit one slice."""
    series, _ = series_of(kind)
    cols = ["subtask", "processed_ts", *order_cols, *series, "_emit"]
    r = records.withColumn("subtask", subtask_of(F.col(key_col), subtasks)).select(*dict.fromkeys(cols))
    at_most = at_most if at_most is None or isinstance(at_most, int) else at_most.count()
    if checkpoint and not fits_a_slice(at_most, rows_per_slice):
        # the sink input (rounds, sessions, sampled rows) is far smaller than
        # the events behind it; write it once so the per-subtask statistics
        # and the ordered pass do not both recompute the upstream plan
        ensure_checkpoint_dir(records.sparkSession)
        r = r.checkpoint()
        at_most = r.count()
    run = running_aggregates(r, ["subtask"], ["processed_ts", *order_cols], series, rows_per_slice=rows_per_slice, at_most=at_most)
    lines = run.where("_emit").select(*line_columns(kind))
    if not close_lines:
        return lines
    # The line written at close holds the statistics over all rows of the
    # subtask, i.e. per-subtask totals: a partial aggregate, no ordered pass.
    tot = r.groupBy("subtask").agg(
        F.max("processed_ts").alias("_ts"),
        *[a for v in series for a in (F.count(v).alias(f"{v}_rcount"), F.sum(v).alias(f"{v}_rsum"),
                                      F.min(v).alias(f"{v}_rmin"), F.max(v).alias(f"{v}_rmax"),
                                      F.sum(F.col(v).cast("decimal(38,0)") * F.col(v).cast("decimal(38,0)"))
                                      .alias(f"{v}_rss"))])
    return lines.unionByName(tot.select(*line_columns(kind, "_ts")))


def write_latency_csv(lines: DataFrame, path: str, mode: str = "append") -> None:
    """K5: one folder per subtask (``sink=<i>``); each file has a header, all
    columns of its layout (``subtask`` first) and its lines in ``ts`` order."""
    (lines.withColumn("sink", F.col("subtask")).sortWithinPartitions("sink", "ts")
          .write.mode(mode).partitionBy("sink").option("header", True).csv(path))


def discard(df: DataFrame) -> None:
    """K6: run the plan to completion and drop the rows (throughput)."""
    df.write.format("noop").mode("overwrite").save()


def observe_latency(df: DataFrame, name: str, col: str) -> DataFrame:
    """K7: gauge of the mean latency via ``observe`` (read it from
    ``Observation.get`` or a listener after the action)."""
    return df.observe(name, F.avg(col).alias("mean"), F.count(col).alias("count"))
