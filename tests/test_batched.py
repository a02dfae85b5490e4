"""Ordered micro-batches against the batch operators: rows arrive out of order within the watermark delay, in
several batches, one of which may run three times (a failed attempt, a success, a replay after its commit)."""

import pytest
from pyspark.sql import functions as F

from auctionflow.operators import aggregates, chunks, joins, latency, rounds, sampling, sessions
from auctionflow.operators.windows import sliding, tumbling
from auctionflow.plans import jobs
from auctionflow.sources import bindings as B
from auctionflow.streaming import batched as M
from conftest import SF01, rows

HOUR, DAY = 3_600_000, 86_400_000
DELAY, FAR, PARTS = 12 * HOUR, 2_000_000_000_000, 3
FLUSH_KEY = 999_999


def arriving(df, id_col, parts=PARTS):
    """``df`` cut into ``parts`` by arrival: ts plus up to DELAY, by id."""
    df = df.withColumn("_at", F.col("ts") + F.pmod(F.xxhash64(id_col), F.lit(DELAY)))
    lo, hi = df.agg(F.min("_at"), F.max("_at")).first()
    part = F.floor((F.col("_at") - lo) * parts / (hi - lo + 1))
    return [df.where(part == i).drop("_at") for i in range(parts)]


def flush(df, **keys):
    """One row far ahead in time, which moves the watermark past everything."""
    row = df.limit(1).withColumns({c: F.lit(FLUSH_KEY).cast(df.schema[c].dataType) for c in keys})
    times = {c: F.lit(FAR).cast("long") for c in ("ts", "ingestion_ts") if c in df.columns}
    return row.withColumns(times | ({"end": F.lit(FAR + DAY)} if "end" in df.columns else {}))


def run(spark, tmp_path, parts, step, again=None):
    store = M.BatchStore(spark, str(tmp_path / "state"), str(tmp_path / "out"))
    for i, part in enumerate(parts):
        if i == again:
            step(store.begin(i), part)  # fails before its commit: nothing of it shows
        for _ in range(2 if i == again else 1):
            batch = store.begin(i)
            step(batch, part)
            batch.commit()
    return store


@pytest.fixture(scope="module")
def bid_parts(spark):
    bids = B.bids(spark, SF01)
    return bids, [*arriving(bids, "bid_id"), flush(bids, auction_id=1, person_id=1, bid_id=1)]


def test_sampling_and_lines(spark, tmp_path, bid_parts):
    bids, parts = bid_parts
    order = ["ts", "ingestion_ts", "bid_id"]

    def step(batch, new):
        ready, _ = M.in_order(batch, new, "ts", DELAY, late_output="late")
        kept = M.sampled(batch, ready.select("auction_id", *order), 7, order, "auction_id", 4, "nth")
        batch.emit("sampled", kept)
        rec = latency.bid_records(jobs.probed(kept), F.col("last_ingestion_ts"))
        # slices of 20 rows: one subtask is many tasks
        batch.emit("lines", M.latency_lines(batch, rec, "winning", "auction_id", jobs.PROBE_ORDER, reorder_ms=DAY, rows_per_slice=20))

    store = run(spark, tmp_path, parts, step, again=1)
    want = sampling.sample_every(bids.select("auction_id", *order), 7, order, "auction_id", 4, "nth")
    assert rows(store.read("sampled"), want.columns) == rows(want)
    lines = latency.running_latency(latency.bid_records(jobs.probed(want), F.col("last_ingestion_ts")), "winning", "auction_id", jobs.PROBE_ORDER)
    got = store.read("lines")
    held = lines.where(F.col("ts") >= lines.agg(F.max("ts")).first()[0] - DAY)
    assert set(rows(got, lines.columns)) | set(rows(held)) == set(rows(lines)) and got.count() >= lines.count() - held.count()
    assert M.late_rows(store) == 0 and store.read("late").count() == 0


@pytest.mark.parametrize("kind", ["q8", "q5"])
def test_lines_of_live_jobs(spark, tmp_path, kind, bid_parts):
    if kind == "q8":
        people, auctions = B.persons(spark, SF01), B.auctions(spark, SF01)
        parts = [M.tagged(p=x, a=y) for x, y in zip([*arriving(people, "person_id"), flush(people, person_id=1)],
                                                    [*arriving(auctions, "item_id"), flush(auctions, auction_id=1, person_id=1, item_id=1)])]

        def step(batch, new):
            ready, _ = M.in_order(batch, new, "ts", DELAY, by="kind", kinds=["p", "a"])
            kept = M.sampled(batch, M.of_kind(ready, "a").select(*joins.AUCTION_ORDER), 10, joins.AUCTION_ORDER, "person_id")
            rec = latency.q8_records(joins.connected(M.of_kind(ready, "p"), kept), F.greatest("person_creation_ts", "auction_creation_ts"))
            batch.emit("lines", M.latency_lines(batch, rec, "q8", "person_id", ["person_creation_ts", "auction_creation_ts", "person_id"]))

        conn = joins.connect_persons_auctions(people, auctions, 10)
        rec = latency.q8_records(conn, F.greatest("person_creation_ts", "auction_creation_ts"))
        want = latency.running_latency(rec, "q8", "person_id", ["person_creation_ts", "auction_creation_ts", "person_id"])
    else:
        bids, parts = bid_parts
        order = ["last_ts", "last_ingestion_ts", "auction_id", "round_no"]

        def step(batch, new):
            ready, mark = M.in_order(batch, new, "ts", DELAY)
            found = M.bid_rounds(batch, ready, DAY, mark)
            batch.emit("rounds", found)
            batch.emit("lines", M.latency_lines(batch, latency.bid_records(found, F.col("round_end"), 2 * DAY), "q5", "auction_id", order))

        every = rounds.bid_rounds(bids, DAY)
        want = latency.running_latency(latency.bid_records(every, F.col("round_end"), 2 * DAY), "q5", "auction_id", order)
    store = run(spark, tmp_path, parts, step)
    assert rows(store.read("lines"), want.columns) == rows(want) and want.count() > 10
    if kind == "q5":
        assert rows(store.read("rounds"), every.columns) == rows(every)


@pytest.mark.parametrize("strict", [False, True])
def test_winning_bids_and_chunks(spark, tmp_path, strict):
    bids, auctions = B.bids(spark, SF01), B.auctions(spark, SF01)
    parts = [M.tagged(bid=x, auction=y) for x, y in zip([*arriving(bids, "bid_id"), flush(bids, auction_id=1, person_id=1, bid_id=1)],
                                                        [*arriving(auctions, "item_id"), flush(auctions, auction_id=1, person_id=1, item_id=1)])]

    def step(batch, new):
        ready, mark = M.in_order(batch, new, "ts", DELAY, by="kind", kinds=["bid", "auction"])
        batch.emit("won", M.winning_bids(batch, M.of_kind(ready, "bid"), M.of_kind(ready, "auction"), mark, strict, rows_per_slice=40))
        if not strict:
            batch.emit("chunks", M.full_chunks(batch, M.of_kind(ready, "bid"), 8))

    store = run(spark, tmp_path, parts, step, again=None if strict else 1)
    want = rounds.last_bids_per_round(bids, auctions, strict)
    assert rows(store.read("won"), want.columns) == rows(want) and want.count() > 100
    if not strict:
        full = chunks.bid_chunks(bids, 8).where("bid_count = 8")
        assert rows(store.read("chunks"), full.columns) == rows(full) and full.count() > 100
    # only the newest two versions of a carry stay
    assert all(len(store._names(f"{store.root}/state/{n}")) <= 2 for n in store._names(f"{store.root}/state"))


def test_sessions_and_highest(spark, tmp_path, bid_parts):
    bids, parts = bid_parts

    def step(batch, new):
        ready, mark = M.in_order(batch, new, "ts", DELAY)
        closed = M.closed_sessions(batch, ready, 6 * HOUR, mark)
        batch.emit("sessions", closed)
        batch.emit("lines", M.latency_lines(batch, latency.bid_records(closed, F.col("session_end")), "session", "person_id",
                                            ["last_ts", "last_ingestion_ts", "person_id", "session_start"]))
        batch.emit("highest", M.highest_per_window(batch, closed, DAY, mark))

    store = run(spark, tmp_path, parts, step, again=2)
    want = sessions.bidder_sessions(bids, 6 * HOUR)
    assert rows(store.read("sessions"), want.columns) == rows(want)
    lines = latency.running_latency(latency.bid_records(want, F.col("session_end")), "session", "person_id",
                                    ["last_ts", "last_ingestion_ts", "person_id", "session_start"])
    assert rows(store.read("lines"), lines.columns) == rows(lines)
    best = aggregates.highest_per_window(want, DAY)
    assert rows(store.read("highest"), best.columns) == rows(best)


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    """T8 against a plain replay: what is older than the watermark of the batch before is kept with that watermark."""
    bids = B.bids(spark, SF01)
    parts, delay = arriving(bids, "bid_id"), DELAY // 4
    want, mark = [], None
    for part in parts:
        times = [(r.ts, r.bid_id) for r in part.select("ts", "bid_id").collect()]
        want += [(i, mark) for t, i in times if mark is not None and t < mark]
        mark = max([t for t, _ in times] + ([mark + delay] if mark is not None else [])) - delay

    def step(batch, new):
        ready, _ = M.in_order(batch, new, "ts", delay, late_output="late")
        batch.emit("ready", ready)

    store = run(spark, tmp_path, parts, step)
    assert want and rows(store.read("late"), ["bid_id", "watermark"]) == sorted(want) and M.late_rows(store) == len(want)
    out = store.read("ready")
    bounds = sorted((r.batch, r.lo, r.hi) for r in out.groupBy("batch").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect())
    assert all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))
    assert out.count() + len(want) + out.sparkSession.read.parquet(f"{store.root}/state/rows_held/batch={len(parts) - 1}").count() == bids.count()


def test_refined_windows(spark, tmp_path):
    """T4: a row 10 s late corrects its window once, a row beyond 15 s does not and is kept as too late."""
    schema = "auction_id long, ts long, ingestion_ts long, bid double, bid_id long"
    sec = lambda s, bid, i: (1, s * 1000, s * 1000 + 5, bid, i)
    parts = [[sec(1, 5.0, 1), sec(8, 3.0, 2)], [sec(12, 1.0, 3)], [sec(20, 1.0, 4)], [sec(2, 9.0, 5)], [sec(26, 1.0, 6)], [sec(3, 99.0, 7)], [sec(27, 2.0, 8)]]
    store = run(spark, tmp_path, [spark.createDataFrame(p, schema) for p in parts],
                lambda batch, new: batch.emit("stats", M.refined_windows(batch, new, tumbling(10_000), 0, 15_000)), again=3)
    first = [(r.batch, r.max_price, r.bid_count) for r in store.read("stats").where("window_start = 0").orderBy("batch").collect()]
    assert first == [(1, 5.0, 2), (3, 9.0, 3)]  # at the watermark, and once more for the late row
    late = store.read("too_late").collect()
    assert [(r.bid_id, r.watermark) for r in late] == [(7, 26_000)] and M.late_rows(store, "windows") == 1
    last = store.latest("stats", ["window_start", "auction_id"]).orderBy("window_start").collect()
    assert [(r.window_start, r.max_price, r.bid_count) for r in last] == [(0, 9.0, 3), (10_000, 1.0, 1)]


@pytest.mark.parametrize("spec", [tumbling(6 * HOUR), sliding(6 * HOUR, 2 * HOUR)])
def test_refined_windows_end_as_batch(spark, tmp_path, bid_parts, spec):
    bids, parts = bid_parts
    store = run(spark, tmp_path, parts, lambda batch, new: batch.emit("stats", M.refined_windows(batch, new, spec, HOUR, DELAY)), again=2)
    want = aggregates.bid_stats(bids, spec)
    got = store.latest("stats", ["window_start", "auction_id"])
    assert rows(got, want.columns) == rows(want) and store.read("stats").count() > got.count() and M.late_rows(store, "windows") == 0


def test_quantile_sketches(spark, tmp_path, bid_parts):
    """A8 on streams: the rank error stays within the stated bound; a small sketch so that it is not exact."""
    bids, _ = bid_parts
    values = bids.select((F.col("ts") % 1_000_003).alias("a"), F.col("bid_id").alias("b"), F.pmod("auction_id", F.lit(3)).alias("g"))
    parts = [values.where(F.pmod(F.xxhash64("b"), F.lit(4)) == i) for i in range(4)]
    k, quantiles = 100, [0.01, 0.25, 0.5, 0.75, 0.99]
    kept = []

    def step(batch, new):
        kept.append((M.quantile_sketches(batch, new, ["a", "b"], k=k), M.quantile_sketches(batch, new, ["a"], ["g"], "by_group", k)))

    run(spark, tmp_path, parts, step)
    one = M.sketch_quantiles(kept[-1][0], ["a", "b"], quantiles).first()
    n = values.count()
    for v in ("a", "b"):
        assert one[f"{v}_n"] == n
        for q in quantiles:
            found = one[f"{v}_p{round(100 * q)}"]
            low, high = values.where(F.col(v) < found).count() / n, values.where(F.col(v) <= found).count() / n
            assert low - M.rank_error(k) <= q <= high + M.rank_error(k)
    groups = M.sketch_quantiles(kept[-1][1], ["a"], [0.5])
    assert sum(r.a_n for r in groups.collect()) == n and groups.count() == 3
    exact = aggregates.exact_quantiles(values, ["a"], [0.5]).first().a_p50
    assert abs(values.where(F.col("a") <= one.a_p50).count() - values.where(F.col("a") <= exact).count()) / n <= M.rank_error(k)


def test_live_chain_of_the_combined_job(spark, tmp_path):
    """E4 as a stream: every output equals its batch form, from one read of each source."""
    import pyarrow.parquet as pq
    bids, auctions = B.bids(spark, SF01), B.auctions(spark, SF01)
    for name, df, key in (("bid", bids, "bid_id"), ("auction", auctions, "item_id")):
        (tmp_path / name).mkdir()
        keys = {"auction_id": 1, "person_id": 1, key: 1}
        for i, part in enumerate([*arriving(df, key, 2), flush(df, **keys)]):
            pq.write_table(part.toArrow(), str(tmp_path / name / f"{i}.parquet"))
    stream = lambda df, name: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    inputs = jobs.StreamInputs(tables={"bid": stream(bids, "bid"), "auction": stream(auctions, "auction")}, delay_ms=DELAY)
    handles = jobs.start_job("qx", spark, inputs, str(tmp_path / "ck"), str(tmp_path / "out"), {"availableNow": True}, sample_n=50, session_gap_ms=HOUR // 12,
                             window_ms=DAY, chunk_size=8, reorder_ms=HOUR)
    assert len(set(handles.values())) == 1 and {"combo", "session_latency"} <= set(handles)
    query = next(iter(handles.values()))
    query.awaitTermination()
    assert query.exception() is None and len(query.lastProgress["sources"]) == 2
    store = M.BatchStore(spark, str(tmp_path / "ck" / "qx-batches"), str(tmp_path / "out"))
    source = jobs.Inputs(tables={"bid": bids, "auction": auctions})
    want = jobs.job_combo(spark, source, session_gap_ms=HOUR // 12, window_ms=DAY, chunk_size=8)
    want["bid_chunks"] = want["bid_chunks"].where("bid_count = 8")
    want["combo"] = jobs.job_combo_probe(spark, source, sample_n=50)
    for name in handles:
        assert rows(store.read(name), want[name].columns) == rows(want[name]), name
        assert want[name].count() > 0, name


def test_stream_jobs_by_name(spark, tmp_path):
    for name in ("q9", "", "QX"):
        with pytest.raises(ValueError, match="qx_probe"):
            jobs.start_job(name, spark, jobs.StreamInputs(), str(tmp_path))
    bids = B.bids(spark, SF01).limit(50)
    bids.write.parquet(str(tmp_path / "bids"))
    inputs = jobs.StreamInputs(tables={"bid": spark.readStream.schema(bids.schema).parquet(str(tmp_path / "bids"))})
    query = jobs.start_job("qx_probe", spark, inputs, str(tmp_path / "ck"), str(tmp_path / "out"), {"availableNow": True}, sample_n=2)["combo"]
    query.awaitTermination()
    assert query.exception() is None


def test_person_state_as_a_table(spark, tmp_path):
    """The state of the stream equals the batch form; with a time to live it stays flat in a long replay."""
    people, auctions = B.persons(spark, SF01), B.auctions(spark, SF01)
    parts = [M.tagged(p=x, a=y) for x, y in zip([*arriving(people, "person_id"), flush(people, person_id=1)],
                                                [*arriving(auctions, "item_id"), flush(auctions, auction_id=1, person_id=1, item_id=1)])]

    def step(batch, new):
        ready, mark = M.in_order(batch, new, "ts", DELAY, by="kind", kinds=["p", "a"])
        M.person_states(batch, M.of_kind(ready, "p"), M.of_kind(ready, "a"), mark)

    store = run(spark, tmp_path, parts, step)
    want = joins.person_auction_state(people, auctions)
    assert rows(store.carried("person_state"), want.columns) == rows(want)

    schema = "person_id long, ts long, ingestion_ts long"
    sizes = []

    def evicting(batch, new):
        ready, mark = M.in_order(batch, new, "ts", 0)
        kept = M.person_states(batch, ready.select("person_id", "ts", "ingestion_ts"), ready.select("person_id", "ts", "ingestion_ts").limit(0), mark, 1_000, evicted="gone")
        sizes.append(kept.count())

    long = [spark.createDataFrame([(100 * i + j, 1_000 * i + j, 0) for j in range(20)], schema) for i in range(6)]
    store = run(spark, tmp_path / "long", long, evicting)
    assert max(sizes) <= 41 and sizes[-1] <= sizes[2] + 1
    gone = store.read("gone")
    assert gone.count() == gone.select("person_id").distinct().count() > 60
