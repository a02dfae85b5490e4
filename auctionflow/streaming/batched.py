"""Sequential operators on streams as ordered micro-batches.

Each micro-batch is an ordinary batch job: the rows that the watermark has
passed are scanned in order by the same operators as in batch (so one
subtask spreads over all cores, with no Python per row), and what has to go
on to the next batch is a small *carry* table: totals per subtask, open
sessions, open rounds, partial chunks.

* :class:`BatchStore` keeps the carries as versioned Parquet tables, one
  version a batch, and the outputs in one folder a batch.  A batch becomes
  visible with its marker file, all outputs at once.  A batch that is run
  again overwrites its folders and reads the same older carries, so replays
  give the same rows.  The root is a folder that all executors share.
* :func:`in_order` holds rows back until the watermark passes them and puts
  rows that come too late into a side output (T8).
* The steps (``sampled``, ``latency_lines``, ``closed_sessions``,
  ``highest_per_window``, ``winning_bids``, ``bid_rounds``, ``full_chunks``,
  ``refined_windows``, ``quantile_sketches``) each take one batch on.
* :func:`start` runs a step function on every micro-batch of one stream, so
  one read of a source feeds several outputs.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auctionflow.functions.ordering import order_key
from auctionflow.operators import aggregates, joins, latency, rounds, sessions
from auctionflow.operators.sampling import subtask_of
from auctionflow.operators.windows import WindowSpec, assign_window
from auctionflow.plans.ordered import DEFAULT_ROWS_PER_SLICE, next_marker, placed, running_aggregates, sequence_numbers


class BatchStore:
    """Carries, outputs and markers of one streaming query below ``root``;
    outputs go below ``outputs`` (discarded when None)."""

    def __init__(self, spark: SparkSession, root: str, outputs: str | None = None):
        self.spark, self.root, self.outputs = spark, root.rstrip("/"), outputs and outputs.rstrip("/")

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []

    def committed(self) -> list[int]:
        return sorted(int(n) for n in self._names(f"{self.root}/done") if n.isdigit())

    def facts(self, batch_id: int) -> dict:
        """The driver-side values that batch ``batch_id`` committed."""
        fs, p = self._at(f"{self.root}/done/{batch_id}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def begin(self, batch_id: int) -> Batch:
        return Batch(self, batch_id)

    def read(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        """The rows of output ``name`` of all committed batches, with ``batch``."""
        done = self.committed()
        there = {int(n.split("=")[1]) for n in self._names(f"{self.outputs}/{name}") if n.startswith("batch=")}
        paths = [f"{self.outputs}/{name}/batch={i}" for i in done if i in there]
        if not paths:
            if schema is None:
                raise ValueError(f"no committed batch has output {name!r}")
            return self.spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
        return self.spark.read.option("basePath", f"{self.outputs}/{name}").parquet(*paths)

    def latest(self, name: str, keys: list[str]) -> DataFrame:
        """Output ``name`` as upserts: for each of ``keys`` the row of its last batch."""
        rows = self.read(name)
        last = rows.groupBy(*keys).agg(F.max("batch").alias("batch"))
        return rows.join(last, [*keys, "batch"]).drop("batch")

    def carried(self, name: str) -> DataFrame:
        """Carry ``name`` as the last committed batch left it: the state of the stream as a table."""
        done = self.committed()
        if not done:
            raise ValueError("no batch is committed yet")
        return self.spark.read.parquet(f"{self.root}/state/{name}/batch={done[-1]}")

    def prune(self, below: int) -> None:
        """Delete carries of batches before ``below``; the newest two stay for a replay."""
        for name in self._names(f"{self.root}/state"):
            for version in self._names(f"{self.root}/state/{name}"):
                if int(version.split("=")[1]) < below:
                    fs, p = self._at(f"{self.root}/state/{name}/{version}")
                    fs.delete(p, True)


class Batch:
    """One micro-batch: reads the carries of the batch before, writes its own."""

    def __init__(self, store: BatchStore, batch_id: int):
        self.store, self.id, self.spark = store, batch_id, store.spark
        before = [i for i in store.committed() if i < batch_id]
        self.before = before[-1] if before else None
        self.facts = store.facts(self.before) if before else {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write carry ``name`` of this batch and return the stored table."""
        path = f"{self.store.root}/state/{name}/batch={self.id}"
        df.write.mode("overwrite").parquet(path)
        # a batch of a stream is written by the stream's own session, which runs without adaptive
        # plans; what is read back belongs to the caller's session
        return self.spark.read.schema(df.schema).parquet(path)

    def carry(self, name: str, schema: str | StructType) -> DataFrame:
        """Carry ``name`` as the batch before left it; empty at first."""
        if self.before is not None and f"batch={self.before}" in self.store._names(f"{self.store.root}/state/{name}"):
            return self.spark.read.schema(schema).parquet(f"{self.store.root}/state/{name}/batch={self.before}")
        return self.spark.createDataFrame([], schema)

    def emit(self, name: str, df: DataFrame) -> None:
        """Write output ``name`` of this batch; it shows once the batch is committed."""
        if self.store.outputs is None:
            df.write.format("noop").mode("overwrite").save()
        else:
            df.write.mode("overwrite").parquet(f"{self.store.outputs}/{name}/batch={self.id}")

    def commit(self) -> None:
        fs, p = self.store._at(f"{self.store.root}/done/{self.id}")
        out = fs.create(p, True)
        try:
            out.write(json.dumps(self.facts).encode())
        finally:
            out.close()
        if self.before is not None:
            self.store.prune(self.before)


def start(df: DataFrame, checkpoint: str, step: Callable[[Batch, DataFrame], None], outputs: str | None = None,
          trigger: dict | None = None, name: str | None = None):
    """Run ``step(batch, rows)`` on every micro-batch of ``df``; carries lie
    beside the query's checkpoint, so they share its life."""
    from auctionflow.streaming.queries import start as start_query

    store = BatchStore(df.sparkSession, f"{checkpoint.rstrip('/')}-batches", outputs)

    def run(rows: DataFrame, batch_id: int) -> None:
        batch = store.begin(batch_id)
        step(batch, rows)
        batch.commit()

    query = start_query(df, checkpoint, sink="foreach", foreach_batch=run, trigger=trigger, name=name)
    return query, store


# ------------------------------------------------------------------- order

def in_order(batch: Batch, rows: DataFrame, t_col: str, delay_ms: int, name: str = "rows", by: str | None = None,
             kinds: list[str] | None = None, late_output: str | None = None) -> tuple[DataFrame, int | None]:
    """The rows that the watermark has passed, and the watermark (None until
    there is one).  Rows come out in the batch whose watermark first exceeds
    their time, so batches follow each other in time order.

    The watermark is the greatest time seen less ``delay_ms``; with ``by``
    the least of those of ``kinds`` (every kind must have been seen).  Rows
    below the watermark of the batch before are too late: with
    ``late_output`` they go to that output, with their ``watermark``, and
    ``late_rows`` counts them; without, they come out with this batch.  Rows
    without a time are dropped."""
    new = batch.keep(f"{name}_new", placed(rows, [], t_col))
    groups = [by] if by else []
    seen = dict(batch.facts.get(f"{name}_seen", {}))
    for r in new.groupBy(*groups).agg(F.max(t_col).alias("t")).collect():  # a row a kind
        kind = str(r[by]) if by else "all"
        if r["t"] is not None:
            seen[kind] = max(seen.get(kind, r["t"]), r["t"])
    batch.facts[f"{name}_seen"] = seen
    old = batch.facts.get(f"{name}_mark")
    complete = all(k in seen for k in (kinds or ["all"]))
    mark = max([min(seen[k] for k in (kinds or ["all"])) - delay_ms] + ([] if old is None else [old])) if complete else old
    batch.facts[f"{name}_mark"] = mark
    if old is not None and late_output:
        late = new.where(F.col(t_col) < old).withColumn("watermark", F.lit(old).cast("long"))
        batch.emit(late_output, late)
        count = f"{name}_late_rows"
        batch.facts[count] = batch.facts.get(count, 0) + late.count()
        new = new.where(F.col(t_col) >= old)
    every = new.unionByName(batch.carry(f"{name}_held", new.schema))
    if mark is None:
        batch.keep(f"{name}_held", every)
        return every.limit(0), None
    batch.keep(f"{name}_held", every.where(F.col(t_col) >= mark))
    return every.where(F.col(t_col) < mark), mark


def late_rows(store: BatchStore, name: str = "rows") -> int:
    """How many rows came too late, up to the last committed batch."""
    done = store.committed()
    return store.facts(done[-1]).get(f"{name}_late_rows", 0) if done else 0


# ---------------------------------------------------- P5, J4: row numbers

def numbered(batch: Batch, rows: DataFrame, keys: list[str], order_cols: list[str], name: str, out: str = "seq",
             rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """Row numbers per ``keys`` that go on over the batches."""
    rows = placed(rows, keys, order_cols[0])
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    seen = batch.carry(f"{name}_seen", counts.schema)
    batch.keep(f"{name}_seen", counts.unionByName(seen).groupBy(*keys).agg(F.sum("_n").alias("_n")))
    own = sequence_numbers(rows, keys, order_cols, out, rows_per_slice)
    return own.join(seen, keys, "left").withColumn(out, F.col(out) + F.coalesce("_n", F.lit(0))).drop("_n")


def sampled(batch: Batch, rows: DataFrame, n: int, order_cols: list[str], key_col: str, subtasks: int = 4,
            phase: str = "nth", name: str = "sampled", rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """P5: every n-th row per subtask, counted over all batches."""
    tagged = rows.withColumn("subtask", subtask_of(F.col(key_col), subtasks))
    seq = F.col("seq") if phase == "nth" else F.col("seq") - 1
    return numbered(batch, tagged, ["subtask"], order_cols, name, "seq", rows_per_slice).where(seq % n == 0)


def full_chunks(batch: Batch, bids: DataFrame, size: int = 32, name: str = "chunks",
                rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """The chunks of ``size`` bids that fill up in this batch; partial ones are carried."""
    from auctionflow.operators.chunks import BID_ORDER

    rows = numbered(batch, bids.select("auction_id", *BID_ORDER, "bid"), ["auction_id"], BID_ORDER, name, "_seq", rows_per_slice)
    own = rows.select("auction_id", F.expr(f"(_seq - 1) div {int(size)}").alias("chunk"), F.lit(1).cast("long").alias("bid_count"),
                      F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"), F.col("ingestion_ts").alias("last_ingestion_ts"),
                      F.col("bid").alias("max_price"))
    every = own.unionByName(batch.carry(f"{name}_partial", own.schema)).groupBy("auction_id", "chunk").agg(
        F.sum("bid_count").alias("bid_count"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.max("last_ingestion_ts").alias("last_ingestion_ts"), F.max("max_price").alias("max_price"))
    every = batch.keep(f"{name}_all", every)
    batch.keep(f"{name}_partial", every.where(F.col("bid_count") < size))
    return every.where(F.col("bid_count") >= size)


# ------------------------------------------------------------ K1-K4, A7, A8

def latency_lines(batch: Batch, records: DataFrame, kind: str, key_col: str, order_cols: list[str], subtasks: int = 4,
                  name: str = "lines", reorder_ms: int | None = None,
                  rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """K1-K4 lines of this batch (arguments as
    :func:`operators.latency.running_latency`): running aggregates of the
    batch's records on top of the totals of all batches before.

    Records are taken in the order (batch, ``processed_ts``,
    ``order_cols``).  Where ``processed_ts`` does not rise from batch to
    batch, ``reorder_ms`` holds records back until the greatest
    ``processed_ts`` seen is that far ahead; stragglers come out with the
    batch they arrive in."""
    series, _ = latency.series_of(kind)
    cols = ["subtask", "processed_ts", *order_cols, *series, "_emit"]
    r = records.withColumn("subtask", subtask_of(F.col(key_col), subtasks)).select(*dict.fromkeys(cols))
    if reorder_ms is None:
        r = batch.keep(f"{name}_records", r)
    else:
        r, _ = in_order(batch, r, "processed_ts", reorder_ms, f"{name}_records")
    square = lambda v: F.col(v).cast("decimal(38,0)") * F.col(v).cast("decimal(38,0)")
    own = placed(r, ["subtask"], "processed_ts").groupBy("subtask").agg(*[
        a for v in series for a in (F.count(v).alias(f"{v}_c"), F.sum(v).alias(f"{v}_s"), F.min(v).alias(f"{v}_lo"), F.max(v).alias(f"{v}_hi"),
                                    F.sum(square(v)).cast("decimal(38,0)").alias(f"{v}_ss"))])
    before = batch.carry(f"{name}_totals", own.schema)
    add = {"c": F.sum, "s": F.sum, "lo": F.min, "hi": F.max, "ss": lambda c: F.sum(c).cast("decimal(38,0)")}
    batch.keep(f"{name}_totals", own.unionByName(before).groupBy("subtask").agg(*[f(f"{v}_{s}").alias(f"{v}_{s}") for v in series for s, f in add.items()]))
    run = running_aggregates(r, ["subtask"], ["processed_ts", *order_cols], series, rows_per_slice)
    run = run.join(F.broadcast(before), "subtask", "left")  # a row a subtask
    both = lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    for v in series:
        run = run.withColumns({f"{v}_rcount": F.col(f"{v}_rcount") + F.coalesce(f"{v}_c", F.lit(0)), f"{v}_rsum": both(F.col(f"{v}_rsum"), F.col(f"{v}_s")),
                               f"{v}_rmin": F.least(f"{v}_rmin", f"{v}_lo"), f"{v}_rmax": F.greatest(f"{v}_rmax", f"{v}_hi"),
                               f"{v}_rss": both(F.col(f"{v}_rss"), F.col(f"{v}_ss"))})
    return run.where("_emit").select(*latency.line_columns(kind))


def quantile_sketches(batch: Batch, records: DataFrame, series: list[str], groups: list[str] | None = None,
                      name: str = "sketches", k: int = 800) -> DataFrame:
    """A8 on streams: one mergeable KLL sketch per group and series over all
    batches so far (a carry of a few kilobytes a group, whatever the rows).
    Read quantiles with :func:`sketch_quantiles`.  A sketch of size ``k``
    gives a rank within about 2.296 / k^0.9021 of the asked one (99 %
    confidence, the figure published for KLL; 0.55 % at 800)."""
    groups = groups or []
    own = records.groupBy(*groups).agg(*[F.kll_sketch_agg_bigint(F.col(v).cast("long"), F.lit(k)).alias(v) for v in series])
    every = own.unionByName(batch.carry(name, own.schema)).groupBy(*groups)
    return batch.keep(name, every.agg(*[F.kll_merge_agg_bigint(v, F.lit(k)).alias(v) for v in series]))


def rank_error(k: int) -> float:
    """The rank error of a KLL sketch of size ``k`` (99 % confidence)."""
    return 2.296 / k ** 0.9021


def sketch_quantiles(sketches: DataFrame, series: list[str], quantiles: list[float]) -> DataFrame:
    """``{v}_n`` and ``{v}_p{100 q}`` of each row of ``quantile_sketches``."""
    others = [c for c in sketches.columns if c not in series]
    cols = [c for v in series for c in (F.kll_sketch_get_n_bigint(v).alias(f"{v}_n"),
                                        *[F.kll_sketch_get_quantile_bigint(v, F.lit(float(q))).alias(f"{v}_p{round(100 * q)}") for q in quantiles])]
    return sketches.select(*others, *cols)


# --------------------------------------------------------------------- J2

def person_states(batch: Batch, persons: DataFrame, auctions: DataFrame, mark: int | None, ttl_ms: int | None = None,
                  name: str = "person_state", evicted: str | None = None) -> DataFrame:
    """J2's state as a table (columns of :func:`operators.joins.person_auction_state`)
    after this batch; read it later with :meth:`BatchStore.carried`.

    With ``ttl_ms`` a person without any event for that long before the
    watermark is evicted (to output ``evicted``); one that comes back starts
    anew.  Without it, state grows with the persons, as in the reference."""
    own = joins.person_auction_state(persons, auctions)
    every = own.unionByName(batch.carry(name, own.schema)).groupBy("person_id").agg(
        F.max("person_ts").alias("person_ts"),
        F.max_by("person_ingestion_ts", order_key("person_ts", "person_ingestion_ts")).alias("person_ingestion_ts"),
        F.sum("person_events").alias("person_events"), F.sum("auction_count").alias("auction_count"),
        F.min("first_auction_ts").alias("first_auction_ts"), F.max("last_auction_ts").alias("last_auction_ts"),
        F.max("last_auction_ingestion_ts").alias("last_auction_ingestion_ts"))
    if ttl_ms is None or mark is None:
        return batch.keep(name, every)
    every = batch.keep(f"{name}_all", every)
    idle = F.greatest("person_ts", "last_auction_ts") < F.lit(mark - ttl_ms)
    if evicted:
        batch.emit(evicted, every.where(idle))
    return batch.keep(name, every.where(~idle))


# ------------------------------------------------------------------- A5, A6

def closed_sessions(batch: Batch, bids: DataFrame, gap_ms: int, mark: int | None, key: str = "person_id",
                    name: str = "sessions", rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """A5: the sessions (columns of :func:`operators.sessions.bidder_sessions`)
    that the watermark closes in this batch; open ones are carried, one row each."""
    bucket = sessions.gap_bucket("_hi", gap_ms).alias("_bucket")
    own = (bids.groupBy(key, sessions.gap_bucket("ts", gap_ms).alias("_bucket"))
               .agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi"), F.max("ingestion_ts").alias("_ing"), F.count(F.lit(1)).alias("_n")))
    # an open session stands in the bucket of its last event, where events of this batch may follow
    open_ = batch.carry(f"{name}_open", own.drop("_bucket").schema).select(key, bucket, "_lo", "_hi", "_ing", "_n")
    every = (own.unionByName(open_).groupBy(key, "_bucket")
                .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_ing").alias("_ing"), F.sum("_n").alias("_n")))
    ids = sessions.session_ids(every, [key], gap_ms, rows_per_slice=rows_per_slice)
    every = batch.keep(f"{name}_all", ids.groupBy(key, "_sid").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_ing").alias("_ing"),
                                                                    F.sum("_n").alias("_n")).drop("_sid"))
    closed = F.lit(False) if mark is None else F.col("_hi") + F.lit(gap_ms) < F.lit(mark)
    batch.keep(f"{name}_open", every.where(~closed))
    return every.where(closed).select(key, F.col("_lo").alias("session_start"), (F.col("_hi") + F.lit(gap_ms)).alias("session_end"),
                                      F.col("_hi").alias("last_ts"), F.col("_ing").alias("last_ingestion_ts"), F.col("_n").alias("bid_count"))


def highest_per_window(batch: Batch, closed: DataFrame, window_ms: int, mark: int | None, name: str = "highest", **columns) -> DataFrame:
    """The highest session of each window that no later session can reach; the others are carried."""
    best = aggregates.highest_per_window(closed.unionByName(batch.carry(f"{name}_open", closed.schema)), window_ms, **columns)
    best = batch.keep(f"{name}_all", best)
    done = F.lit(False) if mark is None else F.col("window_end") < F.lit(mark)
    batch.keep(f"{name}_open", best.where(~done).select(*closed.columns))
    return best.where(done)


# ------------------------------------------------------------------- J3, A1

def winning_bids(batch: Batch, bids: DataFrame, auctions: DataFrame, mark: int | None, strict: bool = False, name: str = "rounds",
                 rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """The rounds (columns of :func:`operators.rounds.last_bids_per_round`)
    that the watermark closes in this batch.

    Carried per auction: its last round's opener and number, with which the
    fold goes on, and one row of the bids that no closed round owns yet.
    (An auction's ``end`` lies after its ``ts``.)"""
    openers = (auctions.groupBy("auction_id", "ts").agg(F.min_by(F.col("end"), order_key("ingestion_ts", "item_id")).alias("end"))
                       .withColumn("_no", F.lit(None).cast("long")))
    last = batch.carry(f"{name}_last", "auction_id long, ts long, end long, _no long")
    known = last.select(F.col("auction_id").alias("key"), F.col("_no").alias("_first"))
    folded = rounds.fold_rounds(openers.unionByName(last), "auction_id", "ts", "end", rows_per_slice=rows_per_slice)
    found = folded.where("opener").join(known, "key", "left").select(
        F.col("key").alias("auction_id"), (F.col("round_no") + F.coalesce("_first", F.lit(1)) - 1).alias("round_no"),
        F.col("t").alias("open_ts"), F.col("round_close").alias("close_ts"))
    found = batch.keep(f"{name}_found", found)
    order = order_key("open_ts", "round_no")
    batch.keep(f"{name}_last", found.groupBy("auction_id").agg(F.max("open_ts").alias("ts"), F.max_by("close_ts", order).alias("end"),
                                                               F.max("round_no").alias("_no")))

    own = bids.groupBy("auction_id", "ts").agg(F.max("ingestion_ts").alias("_ing"), F.count(F.lit(1)).alias("_n"))
    waiting = batch.carry(f"{name}_waiting", own.schema)
    owned = next_marker(own.unionByName(waiting), found, ["auction_id"], "ts", "close_ts", ["round_no", "open_ts", "close_ts"],
                        strict=True, rows_per_slice=rows_per_slice)
    if strict:
        # bids before an opener belong to no round, those without a later close wait for none
        owned = owned.where(F.col("ts") >= F.col("open_ts"))
    every = (owned.groupBy("auction_id", "round_no", "close_ts")
                  .agg(F.max("ts").alias("last_ts"), F.max("_ing").alias("last_ingestion_ts"), F.sum("_n").alias("bid_count")))
    every = batch.keep(f"{name}_all", every)
    closed = F.lit(False) if mark is None else F.coalesce(F.col("close_ts") <= F.lit(mark), F.lit(False))
    batch.keep(f"{name}_waiting", every.where(~closed).select("auction_id", F.col("last_ts").alias("ts"), F.col("last_ingestion_ts").alias("_ing"),
                                                              F.col("bid_count").alias("_n")))
    return every.where(closed & (F.col("last_ts") > 0)).select("auction_id", "round_no", "close_ts", "last_ts", "last_ingestion_ts", "bid_count")


def bid_rounds(batch: Batch, bids: DataFrame, duration_ms: int, mark: int | None, name: str = "bid_rounds",
               rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """A1: the rounds (columns of :func:`operators.rounds.bid_rounds`) that
    the watermark closes in this batch; one row per auction is carried."""
    own = bids.groupBy("auction_id", "ts").agg(F.max("bid").alias("_max"), F.count(F.lit(1)).alias("_n"), F.min("ingestion_ts").alias("_ing"))
    own = own.select("*", F.col("ts").alias("_last"), F.lit(None).cast("long").alias("_no"))
    last = batch.carry(f"{name}_last", own.schema)
    # a round that was reported leaves only its number and its start
    folded = rounds.fold_rounds(own.unionByName(last), "auction_id", "ts", F.col("ts") + F.lit(duration_ms), rows_per_slice=rows_per_slice)
    every = folded.groupBy(F.col("key").alias("auction_id"), "round_no").agg(
        F.min("open_t").alias("round_start"), F.min("round_close").alias("round_end"), F.max("_max").alias("max_price"),
        F.max("_last").alias("last_ts"), F.max_by("_ing", "_last").alias("last_ingestion_ts"), F.sum("_n").alias("bid_count"))
    first = last.select("auction_id", F.col("_no").alias("_first"))
    every = every.join(first, "auction_id", "left").withColumn("round_no", F.col("round_no") + F.coalesce("_first", F.lit(1)) - 1).drop("_first")
    every = batch.keep(f"{name}_all", every)
    closed = F.lit(False) if mark is None else F.col("round_end") <= F.lit(mark)
    newest = every.groupBy("auction_id").agg(F.max("round_no").alias("round_no"))
    open_ = lambda c: F.when(~closed, F.col(c))
    batch.keep(f"{name}_last", every.join(newest, ["auction_id", "round_no"]).select(
        "auction_id", F.col("round_start").alias("ts"), open_("max_price").alias("_max"), F.coalesce(open_("bid_count"), F.lit(0)).alias("_n"),
        open_("last_ingestion_ts").alias("_ing"), open_("last_ts").alias("_last"), F.col("round_no").alias("_no")))
    return every.where(closed & (F.col("bid_count") > 0)).select("auction_id", "round_no", "round_start", "round_end", "max_price", "last_ts",
                                                                  "last_ingestion_ts", "bid_count")


# ----------------------------------------------------- T4, T8: refined windows

def refined_windows(batch: Batch, bids: DataFrame, spec: WindowSpec, delay_ms: int, lateness_ms: int, key: str = "auction_id",
                    name: str = "windows", late_output: str | None = "too_late") -> DataFrame:
    """T4: bid statistics per window and ``key`` (columns of
    :func:`operators.aggregates.bid_stats`) with allowed lateness.

    A window's rows come out in the batch whose watermark passes its end,
    and again, corrected, in every batch in which late rows of it arrive,
    until the watermark passes its end plus ``lateness_ms``; read them with
    :meth:`BatchStore.latest`.  Rows of a window that is past that count as
    too late: they go to ``late_output`` with the watermark they missed.
    State is one row per open window and key."""
    new = batch.keep(f"{name}_new", placed(bids, [key], "ts"))
    top = new.agg(F.max("ts")).first()[0]
    old = batch.facts.get(f"{name}_mark")
    marks = [m for m in (old, None if top is None else top - delay_ms) if m is not None]
    mark = batch.facts[f"{name}_mark"] = max(marks) if marks else None
    rows = assign_window(new, spec)
    missed = F.lit(False) if old is None else F.col("window_end") + F.lit(lateness_ms) <= F.lit(old)
    if late_output:
        late = rows.where(missed).withColumn("watermark", F.lit(old).cast("long"))
        batch.emit(late_output, late)
        batch.facts[f"{name}_late_rows"] = batch.facts.get(f"{name}_late_rows", 0) + late.count()
    group = ["window_start", "window_end", key]
    own = rows.where(~missed).groupBy(*group).agg(
        F.max("bid").alias("max_price"), F.max("ts").alias("last_ts"), F.max_by("ingestion_ts", order_key("ts", "ingestion_ts", b_desc=True)).alias("last_ingestion_ts"),
        F.count(F.lit(1)).alias("bid_count")).withColumn("_fired", F.lit(False)).withColumn("_new", F.lit(True))
    held = batch.carry(f"{name}_open", own.schema)
    every = own.unionByName(held).groupBy(*group).agg(
        F.max("max_price").alias("max_price"), F.max("last_ts").alias("last_ts"),
        F.max_by("last_ingestion_ts", order_key("last_ts", "last_ingestion_ts", b_desc=True)).alias("last_ingestion_ts"),
        F.sum("bid_count").alias("bid_count"), F.max("_fired").alias("_fired"), F.max("_new").alias("_new"))
    every = batch.keep(f"{name}_all", every)
    passed = F.lit(False) if mark is None else F.col("window_end") <= F.lit(mark)
    over = F.lit(False) if mark is None else F.col("window_end") + F.lit(lateness_ms) <= F.lit(mark)
    batch.keep(f"{name}_open", every.where(~over).withColumn("_fired", F.col("_fired") | passed).withColumn("_new", F.lit(False)))
    return every.where(passed & (~F.col("_fired") | F.col("_new"))).drop("_fired", "_new")


# ------------------------------------------------------------- tagged inputs

def tagged(**kinds: DataFrame) -> DataFrame:
    """One stream of several kinds of rows with a ``ts``: ``kind``, ``ts`` and
    one struct column per kind (J5 for any number of inputs)."""
    schemas = {k: df.schema for k, df in kinds.items()}

    def side(kind: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), "ts", *[(F.struct(*df.columns) if k == kind else F.lit(None).cast(s)).alias(k)
                                                            for k, s in schemas.items()])

    return reduce(DataFrame.unionByName, [side(k, df) for k, df in kinds.items()])


def of_kind(rows: DataFrame, kind: str) -> DataFrame:
    return rows.where(F.col("kind") == kind).select(f"{kind}.*")
