"""Thresholds of the engine, with the defaults that the results depend on. Every field can be overridden from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Params:
    # fixed values: defaults that results must agree with
    min_words: int = 200
    paragraph_min_words: int = 60
    gap_default: float = 2.0
    gap_min_segments: int = 10
    gap_rank: float = 0.80
    gap_low: float = 1.0
    gap_high: float = 8.0
    heading_max_words: int = 7
    heading_gap_factor: float = 2.0
    chunk_words: int = 900
    context_words: int = 100
    min_ratio: float = 0.55
    max_ratio: float = 1.60
    min_retention: float = 0.72
    rewrite_attempts: int = 2
    max_input_words: int = 25000
    block_abort: int = 3
    backoff_base: float = 5.0
    backoff_factor: float = 3.0
    backoff_cap: float = 300.0
    fetch_attempts: int = 4
    request_delay: float = 2.0
    request_jitter: float = 0.6
    log_lines: int = 2000
    finished_jobs: int = 20

    @classmethod
    def from_env(cls, prefix: str = "CUEMILL_") -> Params:
        """Defaults, replaced by environment variables PREFIX + FIELD of the field's type."""
        own = {f.name: os.environ.get(prefix + f.name.upper()) for f in fields(cls)}
        return cls(**{k: type(getattr(cls, k))(v) for k, v in own.items() if v is not None})


DEFAULTS = Params()

# fixed values: state vocabularies
STATUSES = ("raw", "cleaned", "ingested", "embedded")
QUEUE_STATES = ("pending", "done", "failed")
DIFFICULTIES = ("beginner", "intermediate", "advanced")
CONTENT_KINDS = ("tutorial", "lecture", "talk", "interview", "explainer", "news", "other")
IMMUTABLE = ("id", "video_id", "url", "channel", "channel_id", "published_date", "scraped_at", "language", "raw_path", "created_at")
UPDATABLE = ("title", "description", "word_count", "status", "clean_path", "topic", "tags", "notes", "summary", "key_concepts", "domains", "difficulty", "content_kind")
FAILURE_REASONS = {"blocked": True, "network": True, "no_transcript": False, "video_unavailable": False, "auth_required": False, "failed": False}
