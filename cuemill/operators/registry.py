"""The metadata registry: merge-style upserts, audited updates, sections, runs, queues.

A registry table is a snapshot; every change is a new snapshot from one join on the key, and audit and run rows are appended.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.params import IMMUTABLE, UPDATABLE
from cuemill.schema import REGISTRY


def create_tables(spark) -> dict[str, DataFrame]:
    """Empty registry tables."""
    return {name: spark.createDataFrame([], schema) for name, schema in REGISTRY.items()}


def upsert_videos(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Merge by video_id: title, description, word_count and status are overwritten, raw_path is filled once, all else is kept.

    ``incoming`` has video_id, url, channel, channel_id, published, title, description, word_count, status, raw_path, unique
    by video_id. New rows get language en, status raw and no tags by default. Nothing is audited.
    """
    c, i = current.alias("c"), incoming.alias("i")
    j = c.join(i, F.col("c.video_id") == F.col("i.video_id"), "full_outer")
    new, hit = F.col("c.video_id").isNull(), F.col("i.video_id").isNotNull()
    published = F.nullif(F.col("i.published"), F.lit("")).try_cast("date")
    fresh = {
        "published_date": published, "scraped_at": now, "created_at": now, "updated_at": now, "language": F.lit("en"), "tags": F.array().cast("array<string>"),
        "key_concepts": F.array().cast("array<string>"), "domains": F.array().cast("array<string>"), "enrichment_status": F.lit("pending"), "rewrite_status": F.lit("pending"),
        "status": F.coalesce(F.col("i.status"), F.lit("raw")),
    }
    given = set(incoming.columns)
    out = []
    for f in current.schema.fields:
        old = F.col(f"c.{f.name}")
        first = fresh.get(f.name, F.col(f"i.{f.name}") if f.name in given else F.lit(None)).cast(f.dataType)
        if f.name in ("title", "description", "word_count", "status"):
            value = F.when(new, first).when(hit, (F.coalesce(F.col("i.status"), F.lit("raw")) if f.name == "status" else F.col(f"i.{f.name}")).cast(f.dataType)).otherwise(old)
        elif f.name == "raw_path":
            value = F.when(new, first).when(hit, F.coalesce(old, F.col("i.raw_path"))).otherwise(old)
        elif f.name == "updated_at":
            value = F.when(hit, now.cast(f.dataType)).otherwise(old)
        else:
            value = F.when(new, first).otherwise(old)
        out.append(value.alias(f.name))
    return j.select(*out)


def check_fields(names) -> None:
    """Refuse fields that can't be changed, and unknown ones."""
    fixed, unknown = sorted(set(names) & set(IMMUTABLE)), sorted(set(names) - set(IMMUTABLE) - set(UPDATABLE))
    if fixed:
        raise ValueError(f"immutable fields: {', '.join(fixed)}")
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")


def update_videos(current: DataFrame, changes: DataFrame, fields: list[str], now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Audited update of ``fields`` from ``changes`` (video_id and the fields, unique by video_id).

    Returns the new snapshot, one audit row per changed row and field even where the value stays, and the ids that have no row.
    """
    check_fields(fields)
    types = {f.name: f.dataType for f in current.schema.fields}
    given = changes.select("video_id", *[F.col(f).cast(types[f]).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_hit"))
    j = current.join(given, "video_id", "left")
    hit = F.col("_hit").isNotNull() & F.lit(bool(fields))
    snapshot = j.select(*[F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.when(hit, now.cast(types[c])).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c) for c in current.columns])
    pairs = [F.struct(F.lit(f).alias("field_name"), X.audit_text(F.col(f), types[f]).alias("old_value"), X.audit_text(F.col(f"_new_{f}"), types[f]).alias("new_value")) for f in fields]
    audit = j.where(hit).select("video_id", F.explode(F.array(*pairs) if pairs else F.array().cast("array<struct<field_name:string,old_value:string,new_value:string>>")).alias("a"))
    audit = audit.select("video_id", "a.field_name", "a.old_value", "a.new_value", now.alias("changed_at"))
    return snapshot, audit, changes.select("video_id").join(current.select("video_id"), "video_id", "left_anti")


def upsert_sections(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merge by (video_id, idx); sections that a shorter list no longer has are kept."""
    keys = ["video_id", "idx"]
    own, new = current.select(*keys, *[F.col(c).alias(f"_c_{c}") for c in ("heading", "summary", "start_ts", "end_ts")], F.lit(True).alias("_c")), incoming.select(*keys, "heading", "summary", "start_ts", "end_ts", F.lit(True).alias("_i"))
    j = own.join(new, keys, "full_outer")
    return j.select(*keys, *[F.when(F.col("_i"), F.col(c)).otherwise(F.col(f"_c_{c}")).alias(c) for c in ("heading", "summary", "start_ts", "end_ts")])


def set_state(current: DataFrame, ids: DataFrame, column: str, state: str) -> DataFrame:
    """Queue state of the given ids; neither audited nor a change of updated_at."""
    j = current.join(ids.select("video_id").distinct().withColumn("_hit", F.lit(True)), "video_id", "left")
    return j.select(*[F.when(F.col("_hit"), F.lit(state)).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in current.columns])


def get_video(videos: DataFrame, video_id: str) -> DataFrame:
    """The row of one video, none if it isn't registered; the filter reaches the scan."""
    return videos.where(F.col("video_id") == video_id).limit(1)


def get_sections(sections: DataFrame, video_id: str) -> DataFrame:
    """(idx, heading, summary, start_ts, end_ts) of one video's sections, in order."""
    return sections.where(F.col("video_id") == video_id).select("idx", "heading", "summary", "start_ts", "end_ts").orderBy("idx")


def record_runs(runs: DataFrame, new: DataFrame) -> DataFrame:
    """Runs with the new ones appended; a missing column is null."""
    return runs.unionByName(new, allowMissingColumns=True)


def pending(videos: DataFrame, queue: str, limit: int = 0) -> DataFrame:
    """First in, first out: cleaned or ingested videos whose queue state is pending or failed, oldest first; 0 is no limit."""
    out = videos.where(F.col("status").isin("cleaned", "ingested") & F.col(queue).isin("pending", "failed"))
    out = out.orderBy(F.col("created_at").asc_nulls_last(), "video_id")
    return out.limit(limit) if limit else out


def with_given(values: Mapping[str, Column]) -> dict[str, Column]:
    """Non-blank strings only."""
    return {k: F.nullif(X.strip(v), F.lit("")) for k, v in values.items()}
