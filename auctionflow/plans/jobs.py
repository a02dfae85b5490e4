"""Jobs E1-E5: the reference's four benchmark jobs over shared inputs.

Inputs come from generators (``autogen=True``, S12-S14) or from binary
pages (files or Kafka, S1-S11).  Every job returns DataFrames (batch) or
StreamingQuery handles (stream); :func:`run` dispatches by name and raises
on unknown names instead of logging and continuing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auctionflow.operators import aggregates, chunks, joins, latency, rounds, sessions
from auctionflow.operators.sampling import sample_every
from auctionflow.operators.windows import WindowSpec
from auctionflow.sources import generate, pages


@dataclass
class Inputs:
    """Where events come from.  ``tables`` maps a kind ("person", "auction",
    "bid") to a DataFrame of decoded records and comes first; ``autogen``
    uses the generators with ``n_per_subtask`` events per subtask; otherwise
    ``pages`` maps a kind to a page path or Kafka option dict."""

    autogen: bool = True
    n_per_subtask: int = 1_000_000
    subtasks: int = 1
    seed: int = 42
    rows_per_second: int = generate.DEFAULT_RATE
    pages: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)

    def events(self, spark: SparkSession, kind: str) -> DataFrame:
        if kind in self.tables:
            return self.tables[kind]
        if self.autogen:
            c = generate.counters(spark, self.n_per_subtask, self.subtasks)
            fn = {"person": generate.generate_persons, "auction": generate.generate_auctions,
                  "bid": generate.generate_bids}[kind]
            return fn(c, self.seed, rows_per_second=self.rows_per_second)
        if kind not in self.pages:
            raise ValueError(f"no page source for {kind}")
        return pages.decode_pages(pages.read_pages(spark, self.pages[kind], kind), kind)


def job_decode_throughput(spark: SparkSession, inputs: Inputs) -> None:
    """Person pages -> records -> discard (decode throughput)."""
    src = Inputs(autogen=False, pages=inputs.pages) if inputs.pages else inputs
    latency.discard(src.events(spark, "person"))


def job_new_users(spark: SparkSession, inputs: Inputs, window: WindowSpec | None = None,
                  sample_n: int = 200_000, subtasks: int = 4, csv_dir: str | None = None) -> DataFrame:
    """Persons + auctions -> J2 (or J1 with ``window``) -> K1 lines."""
    p, a = inputs.events(spark, "person"), inputs.events(spark, "auction")
    if window is not None:
        return joins.new_user_auctions(p, a, window)
    conn = joins.connect_persons_auctions(p, a, sample_n, subtasks)
    rec = latency.q8_records(conn, F.greatest("person_ingestion_ts", "auction_ingestion_ts"))
    lines = latency.running_latency(rec, "q8", "person_id", ["person_creation_ts", "auction_creation_ts", "person_id"], subtasks,
                                    at_most=p.select("ts").unionAll(a.select("ts")))
    if csv_dir:
        latency.write_latency_csv(lines, f"{csv_dir}/q8")
    return lines


def job_bid_stats(spark: SparkSession, inputs: Inputs, duration_ms: int = 60_000, subtasks: int = 4,
                  csv_dir: str | None = None) -> DataFrame:
    """Bids -> A1 rounds -> K2 lines (now = round end)."""
    bids = inputs.events(spark, "bid")
    rec = latency.bid_records(rounds.bid_rounds(bids, duration_ms), F.col("round_end"))
    lines = latency.running_latency(rec, "q5", "auction_id", ["last_ts", "last_ingestion_ts", "auction_id", "round_no"], subtasks, at_most=bids)
    if csv_dir:
        latency.write_latency_csv(lines, f"{csv_dir}/q5")
    return lines


PROBE_ORDER = ["last_ts", "last_ingestion_ts", "auction_id", "bid_id"]


def probed(bids: DataFrame) -> DataFrame:
    """Sampled bids as the records of the winning-bid sink."""
    return bids.select("auction_id", "bid_id", F.col("ts").alias("last_ts"), F.col("ingestion_ts").alias("last_ingestion_ts"))


def job_combo_probe(spark: SparkSession, inputs: Inputs, sample_n: int = 200_000, subtasks: int = 4,
                    csv_dir: str | None = None) -> DataFrame:
    """E4's live output: the first of every ``sample_n`` bids per subtask goes
    to the winning-bid sink as it is read (now = its ingestion) -> K4 lines."""
    order = ["ts", "ingestion_ts", "bid_id"]
    bids = inputs.events(spark, "bid")
    probe = sample_every(bids.select("auction_id", *order), sample_n, order, "auction_id", subtasks, "first")
    rec = latency.bid_records(probed(probe), F.col("last_ingestion_ts"))
    lines = latency.running_latency(rec, "winning", "auction_id", PROBE_ORDER, subtasks, at_most=bids)
    if csv_dir:
        latency.write_latency_csv(lines, f"{csv_dir}/winning")
    return lines


def job_combo(spark: SparkSession, inputs: Inputs, session_gap_ms: int = 60_000, window_ms: int = 10_000,
              chunk_size: int = 32, subtasks: int = 4) -> dict[str, DataFrame]:
    """The combined job over shared bid / auction inputs: winning bids
    per round (J3 + K4), bid chunks (J4), bidder sessions (A5 + K3) and the
    highest session per window (A6).  :func:`job_combo_probe` is the live
    sampled output of the same job."""
    bids, auctions = inputs.events(spark, "bid"), inputs.events(spark, "auction")
    winning = rounds.last_bids_per_round(bids, auctions)
    sess = sessions.bidder_sessions(bids, session_gap_ms)
    order = ["last_ts", "last_ingestion_ts"]
    return {
        "winning_bids": winning,
        "winning_latency": latency.running_latency(latency.bid_records(winning, F.col("close_ts")), "winning",
                                                   "auction_id", order + ["auction_id", "round_no"], subtasks, at_most=auctions),
        "bid_chunks": chunks.bid_chunks(bids, chunk_size),
        "bidder_sessions": sess,
        "session_latency": latency.running_latency(latency.bid_records(sess, F.col("session_end")), "session",
                                                   "person_id", order + ["person_id", "session_start"], subtasks, at_most=bids),
        "highest_session": aggregates.highest_per_window(sess, window_ms),
    }


JOBS = {"debug": job_decode_throughput, "q8": job_new_users, "q5": job_bid_stats, "qx": job_combo,
        "qx_probe": job_combo_probe}


def run(name: str, spark: SparkSession, inputs: Inputs, **params):
    """E5: run a job by name ("debug", "q8", "q5", "qx", "qx_probe")."""
    try:
        job = JOBS[name]
    except KeyError:
        raise ValueError(f"unknown job {name!r}; expected one of {sorted(JOBS)}") from None
    return job(spark, inputs, **params)


# --------------------------------------------------------------------------- streams

@dataclass
class StreamInputs:
    """Stream sources: streaming DataFrames of decoded records per kind
    (``tables``, which come first), generators on the ``rate`` source
    (``autogen``), or page sources (Kafka option dicts or folders of page
    files) per kind."""

    autogen: bool = True
    rows_per_second: int = 1_000
    subtasks: int = 1
    seed: int = 42
    pages: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)
    delay_ms: int | None = None

    @property
    def delay(self) -> int:
        """How far behind the latest event the watermark runs."""
        from auctionflow.streaming.queries import GENERATOR_DELAY_MS, KAFKA_DELAY_MS
        if self.delay_ms is not None:
            return self.delay_ms
        return GENERATOR_DELAY_MS if self.autogen and not self.tables else KAFKA_DELAY_MS

    def records(self, spark: SparkSession, kind: str) -> DataFrame:
        if kind in self.tables:
            return self.tables[kind]
        if self.autogen:
            c = generate.stream_counters(spark, self.rows_per_second, self.subtasks)
            fn = {"person": generate.generate_persons, "auction": generate.generate_auctions,
                  "bid": generate.generate_bids}[kind]
            return fn(c, self.seed, rows_per_second=self.rows_per_second)
        if kind not in self.pages:
            raise ValueError(f"no page source for {kind}")
        return pages.decode_pages(pages.read_pages(spark, self.pages[kind], kind, stream=True), kind)

    def events(self, spark: SparkSession, kind: str) -> DataFrame:
        from auctionflow.streaming.queries import with_event_time
        return with_event_time(self.records(spark, kind), self.delay)


def start_job(name: str, spark: SparkSession, inputs: StreamInputs, checkpoint_root: str,
              output_root: str | None = None, trigger: dict | None = None, **params) -> dict:
    """Start a job as one Structured Streaming query and return
    ``{output name: StreamingQuery}``.  Each source is read once, whatever
    the number of outputs; a batch's outputs become visible together
    (:class:`streaming.batched.BatchStore`).  Outputs go to Parquet folders
    ``{output}/batch={id}`` under ``output_root`` (discarded when None);
    checkpoint and carries lie under ``checkpoint_root`` (a shared folder on
    clusters).

    * ``debug``: person pages decoded and discarded (E1);
    * ``q8``: J2 connect + K1 latency lines (E2);
    * ``q5``: A1 bid rounds + K2 latency lines (E3);
    * ``qx``: the live probe (P5 "first") + K4 lines ``combo``, J3 winning bids + K4, J4 chunks, A5 sessions + K3
      ``session_latency``, A6 highest session (E4);
    * ``qx_probe``: the live probe and its lines only.

    Rows that come too late go to ``too_late``.  ``reorder_ms`` is how far
    processing times of records that are written as they are read (K1, the
    probe) may run against event times.
    """
    from auctionflow.streaming import batched as M
    from auctionflow.streaming import queries as S

    if name not in JOBS:
        raise ValueError(f"unknown job {name!r}; expected one of {sorted(JOBS)}")
    subtasks, sample_n = params.get("subtasks", 4), params.get("sample_n", 200_000)
    reorder_ms = params.get("reorder_ms", 0)
    if name == "debug":
        src = inputs.events(spark, "person")
        kwargs = {"sink": "file", "path": f"{output_root}/persons"} if output_root else {"sink": "noop"}
        return {"persons": S.start(src, f"{checkpoint_root}/persons", trigger=trigger, **kwargs)}
    kinds = {"q8": ["person", "auction"], "q5": ["bid"], "qx": ["bid", "auction"], "qx_probe": ["bid"]}[name]
    source = M.tagged(**{k: inputs.records(spark, k) for k in kinds})

    def ready(batch: M.Batch, rows: DataFrame) -> tuple[list[DataFrame], int | None]:
        passed, mark = M.in_order(batch, rows, "ts", inputs.delay, by="kind", kinds=kinds, late_output="too_late")
        return [M.of_kind(passed, k) for k in kinds], mark

    def q8(batch: M.Batch, rows: DataFrame) -> None:
        (persons, auctions), _ = ready(batch, rows)
        kept = M.sampled(batch, auctions.select(*joins.AUCTION_ORDER), sample_n, joins.AUCTION_ORDER, "person_id", subtasks, "nth")
        rec = latency.q8_records(joins.connected(persons, kept), F.greatest("person_ingestion_ts", "auction_ingestion_ts"))
        batch.emit("q8_latency", M.latency_lines(batch, rec, "q8", "person_id", ["person_creation_ts", "auction_creation_ts", "person_id"],
                                                 subtasks, reorder_ms=reorder_ms))

    def q5(batch: M.Batch, rows: DataFrame) -> None:
        (bids,), mark = ready(batch, rows)
        rec = latency.bid_records(M.bid_rounds(batch, bids, params.get("duration_ms", 60_000), mark), F.col("round_end"))
        batch.emit("q5_latency", M.latency_lines(batch, rec, "q5", "auction_id", ["last_ts", "last_ingestion_ts", "auction_id", "round_no"], subtasks))

    def probe(batch: M.Batch, bids: DataFrame) -> None:
        order = ["ts", "ingestion_ts", "bid_id"]
        taken = M.sampled(batch, bids.select("auction_id", *order), sample_n, order, "auction_id", subtasks, "first", "probe")
        rec = latency.bid_records(probed(taken), F.col("last_ingestion_ts"))
        batch.emit("combo", M.latency_lines(batch, rec, "winning", "auction_id", PROBE_ORDER, subtasks, "combo", reorder_ms))

    def qx_probe(batch: M.Batch, rows: DataFrame) -> None:
        (bids,), _ = ready(batch, rows)
        probe(batch, bids)

    def qx(batch: M.Batch, rows: DataFrame) -> None:
        (bids, auctions), mark = ready(batch, rows)
        probe(batch, bids)
        order = ["last_ts", "last_ingestion_ts"]
        won = M.winning_bids(batch, bids, auctions, mark)
        batch.emit("winning_bids", won)
        batch.emit("winning_latency", M.latency_lines(batch, latency.bid_records(won, F.col("close_ts")), "winning", "auction_id",
                                                      [*order, "auction_id", "round_no"], subtasks, "winning"))
        batch.emit("bid_chunks", M.full_chunks(batch, bids, params.get("chunk_size", 32)))
        sess = M.closed_sessions(batch, bids, params.get("session_gap_ms", 60_000), mark)
        batch.emit("bidder_sessions", sess)
        batch.emit("session_latency", M.latency_lines(batch, latency.bid_records(sess, F.col("session_end")), "session", "person_id",
                                                      [*order, "person_id", "session_start"], subtasks, "session"))
        batch.emit("highest_session", M.highest_per_window(batch, sess, params.get("window_ms", 10_000), mark))

    step = {"q8": q8, "q5": q5, "qx": qx, "qx_probe": qx_probe}[name]
    outputs = {"q8": ["q8_latency"], "q5": ["q5_latency"], "qx_probe": ["combo"],
               "qx": ["combo", "winning_bids", "winning_latency", "bid_chunks", "bidder_sessions", "session_latency", "highest_session"]}[name]
    query, _ = M.start(source, f"{checkpoint_root}/{name}", step, output_root, trigger)
    return dict.fromkeys(outputs, query)
