"""Streaming constructs: a queue worker over micro-batches, a resumable log, idempotent upserts, event-time windows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuemill.functions import text as X
from cuemill.operators.records import last_wins
from cuemill.runtime import subfolders

LOG = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("line", T.StringType())])
DONE = "done"


def drain(source: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, every: str = "60 seconds"):
    """Run ``work`` on every micro-batch of a streaming source and return the query.

    ``once`` drains what is there and stops; otherwise the source is polled at the interval. Progress is in the checkpoint,
    so a restarted worker goes on where the last committed batch ended.
    """
    writer = source.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def snapshot_upsert(folder: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps the newest row per key as numbered snapshots; a batch that is run again writes the same snapshot."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        older = [n for n in _snapshots(spark, folder) if n < number]
        current = spark.read.schema(batch.schema).parquet(f"{folder}/v{max(older)}") if older else batch.limit(0)
        merged = last_wins(current.unionByName(batch), key, order).drop("first_at")
        merged.write.mode("overwrite").parquet(f"{folder}/v{number}")

    return write


def _snapshots(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete snapshots."""
    return sorted(int(f[1:]) for f in subfolders(spark, folder) if f[:1] == "v" and f[1:].isdigit() and "_SUCCESS" in subfolders(spark, f"{folder}/{f}", files=True))


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/v{_snapshots(spark, folder)[-1]}")


def follow_log(spark: SparkSession, folder: str, after: int = 0) -> DataFrame:
    """The lines of an append-only JSON log after a position, as a stream."""
    return spark.readStream.schema(LOG).json(folder).where(F.col("seq") > after)


def log_events(log: DataFrame) -> DataFrame:
    """(job_id, seq, event, data): every line as an event, the terminal line as the event "done", after which a job has no more."""
    ended = F.col("line") == DONE
    return log.select("job_id", "seq", F.when(ended, F.lit(DONE)).otherwise(F.lit("line")).alias("event"), F.when(~ended, X.line_event(F.col("line"))).alias("data"))


def log_status(log: DataFrame) -> DataFrame:
    """(job_id, lines, last_seq, finished) of every job; the terminal event is the line "done"."""
    return log.groupBy("job_id").agg(F.count("*").alias("lines"), F.max("seq").alias("last_seq"), F.max(F.col("line") == DONE).alias("finished"))


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and kind with a watermark; the same plan runs on batch and streaming inputs."""
    stamped = events.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late)
    return stamped.groupBy(F.window("_at", width).alias("w"), kind).agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), kind, "events")


def sessions(events: DataFrame, user: str, time: str, gap: str, late: str = "2 hours") -> DataFrame:
    """Session windows: the event-time form of the pause rule."""
    stamped = events.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late)
    return stamped.groupBy(user, F.session_window("_at", gap).alias("w")).agg(F.count("*").alias("events")).select(user, F.col("w.start").alias("started"), "events")


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table (a file or a folder of files) as a file stream."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if not subfolders(spark, os.path.dirname(path), files=True).count(os.path.basename(path)):
        return reader.parquet(path)
    folder, name = os.path.split(path)
    return reader.option("pathGlobFilter", name).parquet(folder)
