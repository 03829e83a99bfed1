"""Streams at size: what comes before the shuffle, and what a task reads."""

import pathlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cellweave.plans import source_queries
from cellweave.streaming import status


def sent(spark):
    """Rows that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    none = sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(sc._jvm.double, 0), none)
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_sessions_are_joined_before_they_are_sent(spark, tmp_path):
    spark.range(4000).selectExpr("timestamp_seconds(id) as ts", "'a' as event_type").coalesce(1).write.parquet(f"{tmp_path}/e/0.parquet")
    spark.range(1).selectExpr("timestamp_seconds(9000000) as ts", "'z' as event_type").coalesce(1).write.parquet(f"{tmp_path}/e/1.parquet")
    stream = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/e").withWatermark("ts", "1 second")
    before = sent(spark)
    rows = status.run_available(status.debounced(stream, "1 minute")).collect()
    assert [(r.event_type, r.n) for r in rows] == [("a", 4000)]
    assert sent(spark) - before < 100  # 4000 rows of one session


def test_parts_of_a_stream_have_groups_of_bounded_size(spark, tmp_path):
    class T:
        pass

    T.spark = spark
    rows = spark.range(3_000_000, numPartitions=1).select(F.xxhash64("id").alias("x"))
    stream = source_queries.in_parts(T, rows, F.lit(0), 1)
    found = status.run_available(stream.select("x"))
    assert found.count() == 3_000_000
    sizes = []
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://")
    for f in max(pathlib.Path(top).glob("parts-*"), key=lambda p: p.stat().st_mtime).rglob("*.parquet"):
        if f.is_file():
            meta = pq.ParquetFile(f).metadata
            sizes += [meta.row_group(k).total_byte_size for k in range(meta.num_row_groups)]
    assert len(sizes) > 1 and max(sizes) < 12 << 20
