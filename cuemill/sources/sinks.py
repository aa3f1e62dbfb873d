"""Sinks: record file, manifest, documents, failure report, benchmark report."""

from __future__ import annotations

import os
import posixpath
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANIFEST = ("video_id", "title", "channel", "published", "url", "word_count", "md_path")


def append_records(records: DataFrame, folder: str, batch: str | None = None) -> None:
    """Append to the record file, a folder whose files are its lines. Each job commits files of its own at once, so appends that run
    side by side need no lock. A named batch is written whole or not at all, and only once however often it is run."""
    if batch is None:
        records.write.mode("append").json(folder)
    else:
        records.write.mode("overwrite").json(f"{folder}/batch={batch}")


def append_manifest(records: DataFrame, folder: str) -> None:
    """Seven columns; further ones are ignored."""
    records.select(*MANIFEST).write.mode("append").option("header", True).csv(folder)


def write_documents(docs: DataFrame, folder: str) -> DataFrame:
    """Write (path, content) under a folder of a file system all executors share, unless the file is there; returns (path, written).

    A path that would leave the folder is refused. Files appear by rename, so a task that is run again leaves no half document.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        place = re.sub("^file:/*", "file:///", folder)
        fs, root = pafs.FileSystem.from_uri(place if "://" in place else os.path.realpath(place))
        root = root.rstrip("/")
        for f in frames:
            done = []
            for path, content in zip(f["path"], f["content"]):
                target = posixpath.normpath(posixpath.join(root, path or ""))
                fresh = target.startswith(root + "/") and fs.get_file_info(target).type == pafs.FileType.NotFound
                if fresh:
                    fs.create_dir(posixpath.dirname(target), recursive=True)
                    part = f"{target}.{uuid.uuid4().hex}.part"
                    with fs.open_output_stream(part) as out:
                        out.write((content or "").encode())
                    fs.move(part, target)
                done.append(fresh)
            yield pd.DataFrame({"path": f["path"], "written": done})

    return docs.select("path", "content").mapInPandas(run, "path string, written boolean")


def failure_report(failures: DataFrame, folder: str) -> DataFrame:
    """Append the failures and return their counts by reason."""
    failures.write.mode("append").json(folder)
    return failures.groupBy("reason").agg(F.count("*").alias("failures"), F.count_if("transient").alias("transient")).orderBy("reason")


def report_json(rows: DataFrame) -> DataFrame:
    """One row with all rows as a JSON array; for reports of a few rows."""
    return rows.agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("report"))
