"""Streams of inputs and statuses. Each function takes and gives streaming (or plain) DataFrames; run_available writes what
is there now to the shared folder, so that no result passes through the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import setting, shared_path
from .timers import PROVIDER

MERGED = ("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")  # sessions are joined before they are sent


def read_folder(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files of a folder whose names match, in batches of bounded size."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_available(stream: DataFrame, mode: str = "append", each: Callable[[DataFrame, int], DataFrame] | None = None, places: tuple[str, str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Runs a stream over what is available and gives what it wrote. In complete mode the last state stays; in update mode
    each key's row of the last batch that has one. each changes a batch before it is written; a batch that is run again
    replaces its own folder, so retries leave no duplicates. places are folders for the output and the checkpoint; with those of an earlier run, the stream goes on from there."""
    spark = stream.sparkSession
    out, state = places or (shared_path(spark, "stream"), shared_path(spark, "stream-state"))

    def write(batch: DataFrame, number: int) -> None:
        df = each(batch, number) if each else batch
        df.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={number}")

    with setting(spark, *PROVIDER), setting(spark, *MERGED):
        running = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    running.awaitTermination()
    found = spark.read.parquet(out)
    if mode == "complete":
        return found
    if mode == "update":
        found = found.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in found.columns if c not in keys]), "batch").alias("last")).select(*keys, "last.*")
    return found.drop("batch")


def timed(events: DataFrame) -> DataFrame:
    """With ts as an instant, which watermarks need."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def inserted(events: DataFrame) -> DataFrame:
    """One notice per insert: the condition that it is for."""
    return events.select("event_id", F.concat(F.lit("R"), (F.col("user_id") % 25).cast("string"), F.lit("_PC")).alias("condition"))


def processed(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")


def current_status(events: DataFrame, key: str = "user_id") -> DataFrame:
    """The last status of each key by time, then id."""
    return events.groupBy(key).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("since"))


def new_keys(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """The first row of each key; keys are forgotten once the watermark is past them."""
    return timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys).select(*keys)


def per_window(events: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def bursts(events: DataFrame, gap: str) -> DataFrame:
    """Activity of a user without a pause of the gap: start, the time at which the pause is over, and size."""
    s = F.session_window("ts", gap)
    return events.groupBy("user_id", s.alias("s")).agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("idle_at"), "n")


def volume_gate(events: DataFrame, length: str, least: int) -> DataFrame:
    """Windows that closed with enough products: the gate stands in the stream, so what it holds back is not written."""
    return events.groupBy(F.window("ts", length).alias("w")).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(F.col("w.start").alias("start"), "n")


def heartbeat(events: DataFrame, after: str) -> DataFrame:
    """One row of the events' columns, null but for ts: so long after the last event. As it passes, all that waits for
    time to go on is closed. An empty table has a null time, which moves nothing."""
    last = events.agg((F.max("ts") + F.expr(f"interval {after}")).alias("ts"))
    return last.select(*[F.col("ts").cast(f.dataType).alias("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema])


def all_processed(events: DataFrame) -> DataFrame:
    """Users of whom every event so far is processed or viewed: those may be harvested again."""
    return events.groupBy("user_id").agg(F.bool_and(F.col("event_type").isin("purchase", "view")).alias("ready"), F.count("*").alias("n"))


def look_back(events: DataFrame, now, days: dict[str, int], otherwise: int) -> DataFrame:
    """Events not older than the days of their type before now, or than those of other types."""
    limit = F.lit(otherwise)
    for kind, n in days.items():
        limit = F.when(F.col("event_type") == kind, n).otherwise(limit)
    return events.where(F.col("ts") >= F.lit(now) - F.make_interval(days=limit))


def debounced(events: DataFrame, pause: str) -> DataFrame:
    """One run for all events of a kind that follow each other within the pause: the first, the time of the run, and how
    many it serves."""
    s = F.session_window("ts", pause)
    return events.groupBy("event_type", s.alias("s")).agg(F.count("*").alias("n")).select("event_type", F.col("s.start").alias("start"), F.col("s.end").alias("run_at"), "n")
