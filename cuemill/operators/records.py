"""Record-level operators: last and first record of an id, left lookups, positional joins, existence checks, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuemill.functions import text as X


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per non-empty key: the last record's values, with ``first_at``, the place of the key's first record.

    An aggregation with a map-side part: a key with a third of all rows is reduced before the exchange.
    """
    rest = [c for c in rows.columns if c != key]
    out = rows.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r"), F.min(order).alias("first_at"))
    return out.select(key, *[F.col("r")[c].alias(c) for c in rest], "first_at")


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per non-empty key: the first record's values."""
    rest = [c for c in rows.columns if c != key]
    out = rows.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r"))
    return out.select(key, *[F.col("r")[c].alias(c) for c in rest])


def metadata(records: DataFrame) -> DataFrame:
    """The seven metadata keys of a record; missing values are empty. channel_id isn't among them."""
    keys = ("video_id", "url", "title", "channel", "published", "description", "created_at")
    return records.select("line_no", *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys])


def newest_first(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Six columns with defaults, the last line first."""
    out = records.select("line_no", *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in ("video_id", "title", "channel", "published", "url")], F.coalesce("word_count", F.lit(0)).alias("word_count"))
    out = out.orderBy(F.desc("line_no"))
    return out if limit is None else out.limit(limit)


def choose_track(tracks: DataFrame, key: str, wanted: str) -> DataFrame:
    """One caption track per key: the wanted language first, else the first made by hand, else the first generated.

    ``tracks`` has (key, pos, language, generated).
    """
    rank = F.when(F.col("language") == wanted, 0).when(~F.col("generated"), 1).otherwise(2)
    return first_wins(tracks.withColumn("place", F.struct(rank.alias("rank"), F.col("pos"))), key, "place").drop("place")


def queue_lookup(queue: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Queue entries with their record; entries without one are failed."""
    found = queue.join(index.withColumn("_found", F.lit(True)), key, "left")
    return found.withColumn("outcome", F.when(F.col("_found"), F.lit("ready")).otherwise(F.lit("failed"))).drop("_found")


def timed_sections(videos: DataFrame, sections: str, chapters: str) -> DataFrame:
    """Sections with the times of the chapters at the same places, only if there are as many of both and any.

    Rows keep their other columns; ``sections`` becomes array<struct<idx, heading, summary, start_ts, end_ts>>.
    """
    s, c = F.col(sections), F.col(chapters)
    aligned = (F.size(s) == F.size(c)) & (F.size(s) > 0)
    timed = F.transform(s, lambda x, i: F.struct(i.alias("idx"), x["heading"].alias("heading"), x["summary"].alias("summary"), F.when(aligned, F.get(c, i)["start_time"]).alias("start_ts"), F.when(aligned, F.get(c, i)["end_time"]).alias("end_ts")))
    return videos.withColumn(sections, timed)


def unseen(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't there yet."""
    return rows.join(existing.select(key).distinct(), key, "left_anti")


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows that refer to no parent."""
    return rows.join(parents.select(key).distinct(), key, "left_anti")


def merged_metadata(override: DataFrame, fetched: DataFrame, key: str, *kept: str) -> DataFrame:
    """Given values win where they aren't blank, stripped; then fetched ones; then defaults. ``kept`` names further columns of the given rows."""
    o, f = override.alias("o"), fetched.alias("f")
    pick = lambda c, default: F.coalesce(F.nullif(X.strip(F.col(f"o.{c}")), F.lit("")), F.nullif(F.col(f"f.{c}"), F.lit("")), default)
    out = o.join(f, F.col(f"o.{key}") == F.col(f"f.{key}"), "left")
    return out.select(
        F.col(f"o.{key}").alias(key), *[F.col(f"o.{c}").alias(c) for c in kept], pick("title", F.col(f"o.{key}")).alias("title"), pick("channel", F.lit("unknown_channel")).alias("channel"),
        pick("published", F.lit("")).alias("published"), pick("description", F.lit("")).alias("description"),
    )


def output_path(channel: Column, title: Column, suffix: str = ".md") -> Column:
    """Path of a document under the output folder: both parts are made safe, so it can't leave the folder."""
    return F.concat(X.sanitize_filename(X.first_filled(channel, default="unknown_channel")), F.lit("/"), X.sanitize_filename(X.first_filled(title, default="untitled")), F.lit(suffix))


def is_companion(path: Column) -> Column:
    return F.endswith(path, F.lit(".transcript.md"))


def companion_path(path: Column) -> Column:
    return F.when(is_companion(path), path).otherwise(F.regexp_replace(path, r"\.md$", ".transcript.md"))


def last_lines(log: DataFrame, job: str, seq: str, keep: int) -> DataFrame:
    """The newest ``keep`` lines of every job. The limit on the row number reaches the tasks before the exchange, so a hot job sends
    ``keep`` lines a task."""
    w = Window.partitionBy(job).orderBy(F.desc(seq))
    return log.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep).drop("_n")


def numbered(log: DataFrame, job: str, *order: str) -> DataFrame:
    """Log lines with a sequence number from 1 in every job."""
    return log.withColumn("seq", F.row_number().over(Window.partitionBy(job).orderBy(*order)).cast("long"))


def resume_after(log: DataFrame, seq: str, last: Column) -> DataFrame:
    """The lines after a resume position, in order."""
    return log.where(F.col(seq) > last).orderBy(seq)


def retained_jobs(jobs: DataFrame, keep: int) -> DataFrame:
    """Running jobs and the newest ``keep`` of the others."""
    done = jobs.where("status <> 'running'")
    return jobs.where("status = 'running'").unionByName(done.orderBy(F.desc("started"), F.desc("job_id")).limit(keep))


def outcome_counts(rows: DataFrame, outcome: str = "outcome") -> DataFrame:
    return rows.groupBy(outcome).agg(F.count("*").alias("n"))
