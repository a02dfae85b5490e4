"""The page log: offsets, task planning, restart and the end of input."""

import pytest
from pyspark.sql import functions as F

from auctionflow.sources import bindings as B
from auctionflow.sources import pagelog, pages
from auctionflow.streaming import queries as S
from conftest import SF01, rows


@pytest.fixture(scope="module")
def written(spark):
    out = pages.write_pages(B.bids(spark, SF01), "bid", ["ts", "bid_id"], partitions=3, partition_key="auction_id")
    return spark.createDataFrame(out.collect(), out.schema)


def test_batch_read(spark, tmp_path, written):
    n = written.count()
    assert pagelog.append(written, str(tmp_path), segment_pages=3) == n
    source = {"format": "pagelog", "path": str(tmp_path), "pagesPerTask": "2"}
    got = pages.read_pages(spark, source, "bid")
    assert rows(got.drop("key")) == rows(written.drop("key"))
    assert rows(pages.decode_pages(got, "bid")) == rows(pages.decode_pages(written, "bid"))
    log = pagelog.PageLog(str(tmp_path), pages.BIDS_TOPIC)
    tasks = log.tasks({}, {p: end for p, (end, _) in log.ends().items()}, 2)
    covered = [(t.value[0].partition, i) for t in tasks for i in range(t.value[1], t.value[2])]
    assert len(covered) == len(set(covered)) == n and all(t.value[2] - t.value[1] <= 2 for t in tasks)
    assert all(done for _, done in log.ends().values())
    with pytest.raises(ValueError, match="segment_pages|missing or twice"):
        pagelog.append(written.where("offset = 1"), str(tmp_path), segment_pages=2)  # overlaps: the log says so
        log.segments()


def test_stream_stops_by_itself_and_restarts_without_rereading(spark, tmp_path, written):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    half = F.col("offset") < 2
    source = {"format": "pagelog", "path": log}
    pagelog.append(written.where(half), log, 2)

    def start():
        stream = pages.read_pages(spark, source, "bid", stream=True)
        return S.start(stream.drop("key"), str(tmp_path / "ck"), sink="file", path=out)

    first = start()
    first.processAllAvailable()
    assert first.isActive and not pagelog.run_to_end(first, log, pages.BIDS_TOPIC, timeout_s=3) and not first.isActive
    pagelog.append(written.where(~half), log, 2)
    second = start()
    assert pagelog.run_to_end(second, log, pages.BIDS_TOPIC, timeout_s=120) and not second.isActive
    got = spark.read.parquet(out)
    assert rows(got, ["partition", "offset", "value"]) == rows(written, ["partition", "offset", "value"])


def test_pages_after_the_end_and_starting_offsets(spark, tmp_path, written):
    one = written.where("partition = 1")
    n = one.count()
    # a page after the end mark is not read
    more = one.unionByName(one.where(F.col("offset") == n - 1).withColumn("offset", F.lit(n).cast("long")))
    pagelog.append(more, str(tmp_path), 100)
    source = {"format": "pagelog", "path": str(tmp_path)}
    assert pages.read_pages(spark, source, "bid").count() == n
    late = S.start(pages.read_pages(spark, source | {"startingOffsets": "latest"}, "bid", stream=True), str(tmp_path / "ck"), name="log_latest")
    late.processAllAvailable()
    late.stop()
    assert spark.table("log_latest").count() == 0
    # what comes later is read in batches of the given size
    two = str(tmp_path / "growing")
    pagelog.append(one.where("offset < 2"), two, 2)
    source = {"format": "pagelog", "path": two, "maxPagesPerTrigger": "2"}
    few = S.start(pages.read_pages(spark, source, "bid", stream=True), str(tmp_path / "ck2"), name="log_few")
    few.processAllAvailable()
    pagelog.append(one.where("offset >= 2"), two, 2)
    few.processAllAvailable()
    sizes = [p["numInputRows"] for p in few.recentProgress if p["numInputRows"]]
    few.stop()
    assert spark.table("log_few").count() == n == sum(sizes) and max(sizes) <= 2 and len(sizes) > 2
    for bad in ({"format": "pagelog"}, source | {"startingOffsets": "middle"}):
        with pytest.raises(Exception, match="path and topic|startingOffsets"):
            pages.read_pages(spark, bad, "bid").count()
