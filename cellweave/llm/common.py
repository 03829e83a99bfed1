"""What several operators share: reading tables, durable cuts of lineage, linked components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What empties caches that this Python worker keeps between tasks, as encoders do.
CACHES: list[Callable[[], None]] = []
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others have none


def drop_caches() -> None:
    """Called by tasks that need memory of their own: a worker serves one operator after another, and what one of them
    keeps for its next task would lie idle in the tasks of all others."""
    for empty in CACHES:
        empty()
    release_unused()


def release_unused() -> None:
    """Gives back what Arrow and the C library hold of what is gone."""
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)


def portions(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches, so many at a time as have about so many bytes of text at most, one at least."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where that is unset, a temporary folder serves a local session
    (tests), and any other is an error: its executors would not see such a folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("cellweave.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cellweave-")
        spark.conf.set("cellweave.shared.dir", found)
    return found.rstrip("/")


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """df, written as Parquet to the shared folder and read again, and where it is."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def durable(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there, so lost executors cost no recomputation of
    what lies before. What lazy results still read is left there; the folder is the cluster's to clear."""
    return written(df)[0]


def forget(spark: SparkSession, path: str) -> None:
    """Deletes what written() wrote, once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside gets Arrow batches of so many rows at most, for rows that hold much."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an edge the smallest node that links reach.

    Alternates large-star and small-star steps until the edges are stars. Each step groups by node with partial sums
    and joins the minimum back, so a hub is only a skewed join that AQE can split. Null ends and loops are left out; no
    edges give no rows.
    """
    spark = edges.sparkSession
    e, path = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u is not null and v is not null and u > v").distinct()
    )
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        old = path
        e, path = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        forget(spark, old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaf = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return leaf.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
