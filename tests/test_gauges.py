"""K7: the gauge series of a replay equals the means of its batches."""

import time

from pyspark.sql import functions as F

from auctionflow.operators import latency as L
from auctionflow.streaming import queries as S
from auctionflow.streaming.gauges import Gauges


def test_gauge_series(spark, tmp_path):
    src = tmp_path / "src"
    for i in range(3):
        spark.range(10 * i, 10 * i + 10 + i).select(F.col("id").alias("v")).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).parquet(str(src))
    gauges = Gauges().attach(spark)
    try:
        query = S.start(L.observe_latency(stream, "latency", "v"), str(tmp_path / "ck"), sink="memory", name="gauged", trigger={"availableNow": True})
        query.awaitTermination()
        deadline = time.time() + 30
        while time.time() < deadline and not (len(gauges.series("latency")) >= 3 and gauges.ended()):
            time.sleep(0.2)
        series = gauges.series("latency", "gauged")
        want = {(sum(range(10 * i, 10 + 11 * i)) / (10 + i), 10 + i) for i in range(3)}
        assert {(v["mean"], v["count"]) for _, v in series} == want and [b for b, _ in series] == [0, 1, 2]
        assert gauges.series("latency", "other") == [] and gauges.ended() == {"gauged": None}
        assert {r.gauge for r in gauges.table(spark).collect()} == {"latency"}
    finally:
        gauges.detach()
