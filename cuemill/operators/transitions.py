"""Stage transitions as outcome columns: what happens to each record of a stage is decided in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuemill.functions import text as X


def clean_outcomes(cleaned: DataFrame, documents: DataFrame, host: str = X.DOCUMENT_HOST) -> DataFrame:
    """Outcome of every cleaned record against the document already at its path.

    ``cleaned`` has video_id, path, cleaned (null when filtered); ``documents`` has path and content. A document of another
    video, or without identity, is an error and nothing is touched; one of the same video is skipped.
    """
    d = documents.select(F.col("path").alias("_path"), X.document_video_id(F.col("content"), host).alias("_owner"), F.lit(True).alias("_there"))
    j = cleaned.join(d, cleaned["path"] == d["_path"], "left")
    outcome = (
        F.when(F.col("_there") & ~F.col("_owner").eqNullSafe(F.col("video_id")), F.lit("error"))
        .when(F.col("_there"), F.lit("skipped"))
        .when(F.col("cleaned").isNull(), F.lit("filtered"))
        .otherwise(F.lit("saved"))
    )
    return j.withColumn("outcome", outcome).drop("_path", "_owner", "_there")


def clean_row(status: Column, queue: Column, exists: Column, requeue: Column) -> dict[str, Column]:
    """The registry row after a clean stage: inserted if missing, raw becomes cleaned, other states stay.

    Returns inserted, status, audited (status and word count are written with an audit row), queue and queued.
    """
    audited = ~exists | status.isNull() | (status == "raw")
    known = F.coalesce(queue.isin("pending", "failed", "done"), F.lit(False)) & exists
    again = requeue | ~known
    return {
        "inserted": ~exists,
        "status": F.when(audited, F.lit("cleaned")).otherwise(status),
        "audited": audited,
        "queue": F.when(again, F.lit("pending")).otherwise(queue),
        "queued": again | queue.isin("pending", "failed"),
    }


def ingest_row(status: Column, clean_path: Column, destination: Column, companion: Column) -> dict[str, Column]:
    """The registry row after ingesting a document: raw and cleaned become ingested, ingested and embedded stay.

    Any other state, and a missing row (null status), is an error. clean_path is set unless the document is a companion
    or the path is there already.
    """
    fine = F.coalesce(status.isin("raw", "cleaned", "ingested", "embedded"), F.lit(False))
    moved = fine & status.isin("raw", "cleaned")
    pathed = fine & ~companion & ~clean_path.eqNullSafe(destination)
    return {
        "outcome": F.when(~fine, F.lit("error")).when(moved | pathed, F.lit("updated")).otherwise(F.lit("unchanged")),
        "status": F.when(moved, F.lit("ingested")).otherwise(status),
        "clean_path": F.when(pathed, destination).otherwise(clean_path),
    }


def ingest_files(source: DataFrame, target: DataFrame, host: str = X.DOCUMENT_HOST) -> DataFrame:
    """(path, video_id, action) of every source document: copy, keep, or error when it has no identity or the target is another video's."""
    s = source.select("path", X.document_video_id(F.col("content"), host).alias("video_id"))
    t = target.select("path", X.document_video_id(F.col("content"), host).alias("_owner"), F.lit(True).alias("_there"))
    action = F.when(F.col("video_id").isNull() | (F.col("_there") & ~F.col("_owner").eqNullSafe(F.col("video_id"))), F.lit("error")).when(F.col("_there"), F.lit("keep")).otherwise(F.lit("copy"))
    return s.join(t, "path", "left").select("path", "video_id", action.alias("action"))


def verdict(outcomes: DataFrame) -> DataFrame:
    """One row: counts by outcome and whether the stage succeeded, which is when nothing failed."""
    return outcomes.agg(F.count("*").alias("rows"), F.count_if(F.col("outcome") == "error").alias("errors")).withColumn("ok", F.col("errors") == 0)
