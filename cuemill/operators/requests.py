"""Checks of requests before any work starts: each request row gets the reason it is refused for, or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuemill.functions import text as X


def request_error(kind: Column, url: Column, transcript: Column, limit: Column, hosts: tuple[str, ...] = X.VIDEO_HOSTS, short_hosts: tuple[str, ...] = ("youtu.be",)) -> Column:
    """Why a request is refused: a scrape without an address, a paste without an address or a text or with an address that names no
    video, a queue run with a negative limit, an unknown kind; null when it is fine. Null values are blank, a null limit is 0."""
    blank = lambda c: X.strip(F.coalesce(c, F.lit(""))) == ""
    paste = (
        F.when(blank(url), F.lit("url or video id required"))
        .when(blank(transcript), F.lit("transcript is required"))
        .when(X.video_id_of(url, hosts, short_hosts).isNull(), F.concat(F.lit("no video id in "), X.strip(url)))
    )
    return (
        F.when(kind == "scrape", F.when(blank(url), F.lit("url required")))
        .when(kind == "manual", paste)
        .when(kind.isin("enrich", "rewrite"), F.when(F.coalesce(limit, F.lit(0)) < 0, F.lit("limit must not be negative")))
        .when(~F.coalesce(kind.isin("clean", "ingest", "run-all"), F.lit(False)), F.lit("unknown request"))
    )


def checked(requests: DataFrame, **hosts) -> DataFrame:
    """Requests (kind, url, transcript, limit) with ``error``."""
    return requests.withColumn("error", request_error(F.col("kind"), F.col("url"), F.col("transcript"), F.col("limit"), **hosts))
