"""Schemas of records, documents and the registry."""

from __future__ import annotations

from pyspark.sql import types as T

SEGMENT = T.StructType([T.StructField("text", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("duration", T.DoubleType())])
CHAPTER = T.StructType([T.StructField("title", T.StringType()), T.StructField("start_time", T.DoubleType()), T.StructField("end_time", T.DoubleType())])
RECORD = T.StructType(
    [
        *(T.StructField(c, T.StringType()) for c in ("video_id", "created_at", "url", "title", "channel", "channel_id", "published", "description")),
        T.StructField("chapters", T.ArrayType(CHAPTER)),
        T.StructField("transcript_text", T.StringType()),
        T.StructField("transcript_segments", T.ArrayType(SEGMENT)),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("md_path", T.StringType()),
    ]
)
SECTION_NOTE = T.StructType([T.StructField("heading", T.StringType()), T.StructField("summary", T.StringType())])
ENRICHMENT = T.StructType(
    [
        T.StructField("summary", T.StringType()),
        T.StructField("key_concepts", T.ArrayType(T.StringType())),
        T.StructField("domains", T.ArrayType(T.StringType())),
        T.StructField("difficulty", T.StringType()),
        T.StructField("content_kind", T.StringType()),
        T.StructField("sections", T.ArrayType(SECTION_NOTE)),
    ]
)
CHUNK = T.StructType(
    [
        T.StructField("chunk_idx", T.IntegerType()),
        T.StructField("heading", T.StringType()),
        T.StructField("paragraphs", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("words", T.IntegerType()),
    ]
)
VIDEOS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("video_id", "url", "channel", "channel_id")),
        T.StructField("published_date", T.DateType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("language", T.StringType()),
        T.StructField("raw_path", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        *(T.StructField(c, T.StringType()) for c in ("title", "description")),
        T.StructField("word_count", T.IntegerType()),
        *(T.StructField(c, T.StringType()) for c in ("status", "clean_path", "topic")),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("notes", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("summary", T.StringType()),
        T.StructField("key_concepts", T.ArrayType(T.StringType())),
        T.StructField("domains", T.ArrayType(T.StringType())),
        *(T.StructField(c, T.StringType()) for c in ("difficulty", "content_kind", "enrichment_status", "rewrite_status")),
    ]
)
AUDIT = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("old_value", T.StringType()),
        T.StructField("new_value", T.StringType()),
        T.StructField("changed_at", T.TimestampType()),
    ]
)
SECTIONS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("heading", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("start_ts", T.DoubleType()),
        T.StructField("end_ts", T.DoubleType()),
    ]
)
RUNS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
REGISTRY = {"videos": VIDEOS, "video_audit_log": AUDIT, "sections": SECTIONS, "processing_runs": RUNS}
