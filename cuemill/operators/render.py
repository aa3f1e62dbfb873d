"""Documents as column expressions: front matter, transcript, knowledge and article documents, JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuemill.functions import text as X

ARTICLE_MARKER = "## Article"


def _lines(*parts: Column) -> Column:
    """Parts joined by line feeds; null parts are left out."""
    return F.concat_ws("\n", *parts)


def _quoted(name: str, value: Column, escaped: bool = True) -> Column:
    v = F.coalesce(value, F.lit(""))
    return F.concat(F.lit(f'{name}: "'), X.escape_yaml(v) if escaped else v, F.lit('"'))


def _block(name: str, value: Column) -> Column:
    v = X.strip(F.coalesce(value, F.lit("")))
    return F.concat(F.lit(f"{name}: "), F.when(v != "", X.block_scalar(v)).otherwise(F.lit('""')))


def front_matter(meta: dict[str, Column], enrichment: Column | None = None) -> Column:
    """Lines between the fences; created_at is left out where it is missing, enrichment fields where there is none."""
    created = meta.get("created_at")
    parts = [_quoted("title", meta["title"]), _quoted("channel", meta["channel"]), _quoted("published", meta["published"], False), _quoted("url", meta["url"], False)]
    if created is not None:
        parts.append(F.when(F.coalesce(created, F.lit("")) != "", _quoted("created_at", created, False)))
    if enrichment is not None:
        e = enrichment
        extra = _lines(
            _quoted("difficulty", e["difficulty"], False), _quoted("content_kind", e["content_kind"], False),
            F.concat(F.lit("domains: "), X.flow_list(e["domains"])), F.concat(F.lit("key_concepts: "), X.flow_list(e["key_concepts"])), _block("summary", e["summary"]),
        )
        parts.append(F.when(e.isNotNull(), extra))
    return _lines(*parts, _block("description", meta["description"]))


def raw_markdown(meta: dict[str, Column], segments: Column) -> Column:
    """Front matter and one stamped line per segment, texts as they are."""
    rows = F.transform(segments, lambda s: F.concat(X.format_timestamp(s["start"]), F.lit(" "), X.one_line(F.coalesce(s["text"], F.lit("")))))
    head = front_matter({k: v for k, v in meta.items() if k != "created_at"})
    body = F.when(F.size(rows) > 0, F.concat(F.array_join(rows, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("---\n"), head, F.lit("\n---\n\n## Transcript\n\n"), body)


def clean_markdown(meta: dict[str, Column], cleaned: Column) -> Column:
    """Front matter and the cleaned transcript; also the verbatim companion of an article."""
    return F.concat(F.lit("---\n"), front_matter(meta), F.lit("\n---\n\n## Transcript\n\n"), cleaned, F.lit("\n"))


def _summary(e: Column) -> Column:
    s = X.strip(F.coalesce(e["summary"], F.lit("")))
    return F.when(s != "", F.concat(F.lit("## Summary\n\n"), s, F.lit("\n")))


def _concepts(e: Column) -> Column:
    items = F.coalesce(e["key_concepts"], F.array().cast("array<string>"))
    return F.when(F.size(items) > 0, F.concat(F.lit("## Key Concepts\n\n"), F.array_join(F.transform(items, lambda c: F.concat(F.lit("- "), c)), "\n"), F.lit("\n")))


def _sections(e: Column) -> Column:
    def one(s: Column) -> Column:
        note = X.strip(F.coalesce(s["summary"], F.lit("")))
        return F.concat(F.lit("### "), X.strip(s["heading"]), F.when(note != "", F.concat(F.lit("\n\n"), note)).otherwise(F.lit("")), F.lit("\n"))

    given = F.coalesce(e["sections"], F.array().cast("array<struct<heading:string,summary:string>>"))
    named = F.filter(given, lambda s: X.strip(F.coalesce(s["heading"], F.lit(""))) != "")
    return F.when(F.size(given) > 0, F.concat(F.lit("## Sections\n"), F.array_join(F.transform(named, lambda s: F.concat(F.lit("\n"), one(s))), "")))


def knowledge_doc(meta: dict[str, Column], cleaned: Column, enrichment: Column) -> Column:
    """Enriched front matter, summary, concepts and sections, then the transcript; the plain document where there is no enrichment."""
    head = F.concat(F.lit("---\n"), front_matter(meta, enrichment), F.lit("\n---\n"))
    rich = _lines(head, _summary(enrichment), _concepts(enrichment), _sections(enrichment), F.concat(F.lit("## Transcript\n\n"), cleaned, F.lit("\n")))
    return F.when(enrichment.isNull(), clean_markdown(meta, cleaned)).otherwise(rich)


def article_doc(meta: dict[str, Column], body: Column, enrichment: Column) -> Column:
    """Enriched front matter, summary and concepts if any, then the article under its marker."""
    head = F.concat(F.lit("---\n"), front_matter(meta, enrichment), F.lit("\n---\n"))
    extra = F.when(enrichment.isNotNull(), _lines(_summary(enrichment), _concepts(enrichment)))
    return _lines(head, F.nullif(extra, F.lit("")), F.concat(F.lit(ARTICLE_MARKER + "\n\n"), body, F.lit("\n")))


def json_record(meta: dict[str, Column], segments: Column, transcript: Column, path: Column, now: Column) -> Column:
    """The 13-key record as JSON; created_at is kept where it is given, else it is ``now``."""
    fields = [F.coalesce(meta[k], F.lit("")).alias(k) for k in ("video_id",)]
    fields.append(X.first_filled(meta["created_at"], now).alias("created_at"))
    fields += [F.coalesce(meta[k], F.lit("")).alias(k) for k in ("url", "title", "channel", "channel_id", "published", "description")]
    fields += [meta["chapters"].alias("chapters"), transcript.alias("transcript_text"), segments.alias("transcript_segments"), X.word_count(transcript).alias("word_count"), path.alias("md_path")]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
