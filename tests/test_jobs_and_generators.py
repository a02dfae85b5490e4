"""Jobs on generated input, generator invariants, CSV sink."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from auctionflow.functions.hashing import py_hash
from auctionflow.operators import latency
from auctionflow.plans import jobs
from auctionflow.sources import generate


def test_portable_hash_matches_python(spark):
    from auctionflow.functions.hashing import portable_hash
    df = spark.range(0, 50).select("id", portable_hash(F.col("id"), 3).alias("h"))
    assert all(r.h == py_hash(r.id, 3) for r in df.collect())


def test_generator_invariants(spark):
    c = generate.counters(spark, 903, subtasks=3)
    assert c.count() == 905 * 3                       # rounded up to a multiple of 5
    p = generate.generate_persons(c)
    per = p.groupBy("person_id").count().where("count <> 9 and person_id % 10800000 < 100")
    assert per.count() == 0                            # each id 9 times (last epoch may be partial)
    a = generate.generate_auctions(c)
    assert a.where("pmod(auction_id, 4) <> 3").count() == 0
    assert a.where("`end` - ts <> 10000").count() == 0
    b = generate.generate_bids(c)
    assert b.where("bid < 0 or bid >= 10000000 or bid_id <> -1").count() == 0
    hot = b.where("auction_id % 100 = 0").count() / b.count()
    assert 0.08 < hot < 0.25
    with pytest.raises(ValueError):
        generate.counters(spark, 10, subtasks=51)


def test_jobs_run_on_generated_input(spark):
    inputs = jobs.Inputs(autogen=True, n_per_subtask=2000, subtasks=2)
    out = tempfile.mkdtemp(prefix="auctionflow-csv-")
    lines = jobs.run("q5", spark, inputs, duration_ms=60_000, csv_dir=out)
    assert lines.count() > 0 and set(lines.columns) == set(latency.BID_COLUMNS)
    assert os.path.isdir(os.path.join(out, "q5"))
    q8 = jobs.run("q8", spark, inputs, sample_n=50, subtasks=2)
    assert set(q8.columns) >= {"personCount", "auctionCount", "flightTimeCount"}
    combo = jobs.run("qx", spark, inputs)
    assert combo["bid_chunks"].count() > 0 and combo["highest_session"].count() > 0
    jobs.run("debug", spark, inputs)
    with pytest.raises(ValueError):
        jobs.run("q9", spark, inputs)


def test_page_progress_incomplete_and_drop_mode(spark):
    from auctionflow.sources import bindings as B
    from auctionflow.sources import pages
    from conftest import SF001
    written = pages.write_pages(B.bids(spark, SF001), "bid", ["ts", "bid_id"], partitions=1)
    n_pages = written.count()
    # without the last page the partition is not complete
    partial = written.where(F.col("offset") < n_pages - 1)
    prog = pages.page_progress(partial).collect()[0]
    assert prog.pages == n_pages - 1 and not prog.is_complete
    full = pages.page_progress(written).collect()[0]
    assert full.is_complete and full.items == B.bids(spark, SF001).count()
    bad = written.withColumn("value", F.substring("value", 1, 100))
    assert pages.validate_pages(written.unionByName(bad), "bid", "drop").count() == n_pages


def test_csv_sink_layout(spark, tmp_path):
    """Header, ``subtask`` first and lines in time order, for the winning-bid layout."""
    from auctionflow.operators import latency
    names = latency.WINNING_COLUMNS
    rows_ = [tuple([i % 2, 100 - i] + [i] * (len(names) - 2)) for i in range(40)]
    out = str(tmp_path / "csv")
    latency.write_latency_csv(spark.createDataFrame(rows_, names).repartition(3), out)
    dirs = sorted(d for d in os.listdir(out) if d.startswith("sink="))
    assert dirs == ["sink=0", "sink=1"]
    seen = 0
    for k, d in enumerate(dirs):
        for name in (f for f in os.listdir(os.path.join(out, d)) if f.endswith(".csv")):
            with open(os.path.join(out, d, name)) as f:
                head, *lines = [line.strip().split(",") for line in f]
            assert head == names and {line[0] for line in lines} == {str(k)}
            times = [int(line[1]) for line in lines]
            assert times == sorted(times)
            seen += len(lines)
    assert seen == 40


def test_debug_job_reads_page_files(spark, tmp_path):
    from auctionflow.sources import bindings as B
    from auctionflow.sources import pages
    from conftest import SF001
    path = str(tmp_path / "persons")
    pages.write_pages(B.person_wire_fields(spark, SF001), "person", ["ts", "card0"]).write.parquet(path)
    jobs.run("debug", spark, jobs.Inputs(autogen=False, pages={"person": path}))
    decoded = jobs.Inputs(autogen=False, pages={"person": path}).events(spark, "person")
    assert decoded.count() == B.persons(spark, SF001).count()


def test_rate_source_generator(spark, tmp_path):
    c = generate.stream_counters(spark, rows_per_second=50, subtasks=2)
    q = (generate.generate_bids(c).writeStream.format("memory").queryName("gen_rate")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start())
    import time
    deadline = time.time() + 60
    while time.time() < deadline and spark.table("gen_rate").count() == 0:
        time.sleep(1)
    q.stop()
    got = spark.table("gen_rate")
    assert got.count() > 0 and got.where("bid_id <> -1").count() == 0


def test_streaming_jobs_start_and_write(spark, tmp_path):
    import time
    inputs = jobs.StreamInputs(autogen=True, rows_per_second=200, subtasks=2)
    handles = {}
    for name in ("q5", "qx", "q8", "debug"):
        handles.update(jobs.start_job(name, spark, inputs, str(tmp_path / "ck" / name), str(tmp_path / "out"),
                                      trigger={"processingTime": "1 second"}, duration_ms=2_000,
                                      session_gap_ms=1_000, window_ms=2_000, chunk_size=4, sample_n=10))
    def chunk_rows():
        try:
            return spark.read.parquet(str(tmp_path / "out" / "bid_chunks")).count()
        except Exception:  # no committed file yet
            return 0

    deadline = time.time() + 120
    while time.time() < deadline and not (all(h.lastProgress for h in handles.values()) and chunk_rows() > 0):
        time.sleep(1)
    for h in handles.values():
        assert h.exception() is None
        h.stop()
    chunks_out = spark.read.parquet(str(tmp_path / "out" / "bid_chunks"))
    assert chunks_out.count() > 0 and chunks_out.where("bid_count <> 4").count() == 0


def test_cluster_conf_sizes_partitions():
    from auctionflow.session import cluster_conf
    conf = cluster_conf(100 * 1024**4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1024**3, total_cores=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128      # at least 2x the cores


def test_checkpoint_dir_is_read_from_the_session(spark):
    from auctionflow.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
