"""Session settings and the shared folder for checkpoints and written streams."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "cellweave", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new folder under the cluster's spark.checkpoint.dir. Where that is unset, a temporary folder serves a local
    session, and any other is an error: its executors would not see such a folder."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("cellweave.shared", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="cellweave-")
        spark.conf.set("cellweave.shared", top)
    return f"{top.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """df, written to the shared folder and read again, and where it is."""
    path = shared_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def durable(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again, so that its lineage ends there."""
    return written(df)[0]


def forget(spark: SparkSession, path: str) -> None:
    """Deletes what written() wrote, once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


PART, SPLIT, PER_PART = 16 << 20, 8 << 20, 4 << 20  # bytes of a part of a shuffle, of a file, and that are read for each part at first
MANY = 16  # how often the bytes of a table count whose rows become many each


def bounded_parts(spark: SparkSession, path: str, before: int = 0, weight: int = 1) -> int:
    """Lets adaptive execution cut the shuffles of queries over a table into parts of bounded size, and files too, so that
    what a task holds does not grow with the table. A fixed number of parts would. Smaller parts that the session asks for
    stay, and so does its spark.sql.shuffle.partitions, which is the least. Gives the bytes of the table, as often as they count, and those before."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = before + weight * place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PER_PART)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    for name, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", PART), ("spark.sql.files.maxPartitionBytes", SPLIT)):
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > most:
            spark.conf.set(name, f"{most}b")
    return size


def spread(df: DataFrame, size: int) -> DataFrame:
    """A table whose rows become many each, in a part for each PER_PART bytes of its size as it counts: a file of few bytes a
    row is otherwise read by one or two tasks, which hold all that comes of it until they have sent it."""
    return df.repartition(-(-size // PER_PART)) if size > PER_PART else df


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """What runs inside has the session's setting at a value."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)
