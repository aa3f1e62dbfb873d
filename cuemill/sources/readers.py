"""Sources: record files, document trees, source lists, and connector output."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.operators.resilience import transient
from cuemill.schema import RECORD


def records(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """The record file with its fixed schema; blank lines are skipped. An unreadable line fails the scan, or is dropped where asked."""
    return spark.read.schema(RECORD).option("mode", "DROPMALFORMED" if lenient else "FAILFAST").json(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of every Markdown document below a folder, paths relative to it."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    whole = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*", "/"), F.lit("+"), F.lit("%2B")))
    base = folder.rstrip("/") if "://" in folder and not folder.startswith("file:") else os.path.realpath(re.sub("^file:/*", "/", folder))
    return files.select(F.substring(whole, len(base) + 2, 1 << 20).alias("path"), F.col("value").alias("content"))


def source_list(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, source) of a text file: stripped lines without blank ones and comments."""
    text = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), X.strip(F.col("value")).alias("source"))
    return text.where((F.col("source") != "") & ~F.startswith("source", F.lit("#")))


def normalised_info(info: DataFrame) -> DataFrame:
    """Connector rows as video metadata: id from the id or the address, dates as yyyy-mm-dd, the channel from its two fields.

    ``info`` has id, url, title, upload_date, channel, uploader, channel_id, description; rows without any id are dropped.
    """
    ident = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.nullif(F.element_at(F.split("url", "v="), -1), F.lit("")))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return info.select(
        ident.alias("video_id"), text("url").alias("url"), text("title").alias("title"), X.upload_date(F.col("upload_date")).alias("published"),
        X.first_filled(F.col("channel"), F.col("uploader")).alias("channel"), text("channel_id").alias("channel_id"), text("description").alias("description"),
    ).where("video_id IS NOT NULL")


def fetched(ids: DataFrame, fetch: Callable[[str], dict]) -> DataFrame:
    """Connector calls in Arrow batches: (video_id, segments, reason, detail, transient).

    ``fetch`` returns {"segments": [...]} or {"reason": ..., "detail": ...}; an exception is the reason "failed". ``transient`` tells
    whether a failure may pass by itself; it is null where there is none.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for v in f["video_id"]:
                try:
                    got = fetch(v)
                except Exception as e:  # a connector may raise anything
                    got = {"reason": "failed", "detail": f"{type(e).__name__}: {e}"}
                rows.append((v, got.get("segments"), got.get("reason"), got.get("detail")))
            yield pd.DataFrame(rows, columns=["video_id", "segments", "reason", "detail"])

    out = ids.select("video_id").mapInPandas(run, "video_id string, segments array<struct<text:string,start:double,duration:double>>, reason string, detail string")
    return out.withColumn("transient", F.when(F.col("reason").isNotNull(), transient(F.col("reason"))))


def expanded(entries: DataFrame, column: str = "entries") -> DataFrame:
    """Playlist rows to one row per entry; null entries are dropped, a row that is no playlist stays."""
    return entries.withColumn("entry", F.explode_outer(column)).where(F.col("entry").isNotNull() | F.col(column).isNull())
