"""Stage runner: ordered stages over shared tables, stopping at the first that doesn't succeed."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.operators import chunks, enrich, pasted, records, registry, render, resilience, segments, transitions
from cuemill.params import DEFAULTS, Params
from cuemill.runtime import cut
from cuemill.sources import readers


@dataclass
class Stage:
    name: str
    run: Callable[[dict[str, DataFrame]], tuple[dict[str, DataFrame], bool]]


@dataclass
class Report:
    done: list[str] = field(default_factory=list)
    failed: str | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return self.failed is None


def run_all(stages: list[Stage], tables: dict[str, DataFrame]) -> Report:
    """Run the stages in order; each returns the tables it made and its verdict."""
    report = Report(tables=dict(tables))
    for stage in stages:
        made, ok = stage.run(report.tables)
        report.tables |= made
        if not ok:
            report.failed = stage.name
            break
        report.done.append(stage.name)
    return report


class Admission:
    """One running job per class; another one is refused."""

    def __init__(self):
        self._lock, self._running = threading.Lock(), {}

    def start(self, kind: str) -> str | None:
        with self._lock:
            if kind in self._running:
                return None
            self._running[kind] = job = uuid.uuid4().hex[:8]
            return job

    def finish(self, job: str) -> None:
        with self._lock:
            self._running = {k: j for k, j in self._running.items() if j != job}


def scrape_stage(fetch: Callable[[str], dict], p: Params = DEFAULTS) -> Stage:
    """sources (run, order, and video metadata) and documents (path) to records, failures and the run's attempts.

    A source whose document is there is skipped without a request. The breaker ends a run at the first blocks in a row; what lies behind
    them isn't saved. The stage succeeds when no run was ended and something was saved or was there already.
    """

    def run(t: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], bool]:
        sources = t["sources"].withColumn("path", records.output_path(F.col("channel"), F.col("title")))
        there = t["documents"].select("path").distinct().withColumn("_there", F.lit(True))
        marked = cut(sources.join(there, "path", "left"))
        got = readers.fetched(marked.where("_there IS NULL").select("video_id").distinct(), fetch)
        tried = marked.join(got, "video_id", "left")
        outcome = F.when(F.col("_there"), "skipped").when(F.col("reason") == "blocked", "blocked").when(F.col("reason").isNotNull(), "failed").otherwise("saved")
        made = cut(resilience.circuit_breaker(tried.withColumn("outcome", outcome), "run", "order", "outcome", p.block_abort))
        failed = made.where(F.col("reason").isNotNull()).select("video_id", "title", "reason", "detail", "transient")
        saved = made.where("outcome = 'saved'").drop("outcome", "run_length", "aborted", "reason", "detail", "transient", "_there")
        return {"attempts": made, "records": saved, "failures": failed}, bool(resilience.scrape_verdict(made).first().ok)

    return Stage("scrape", run)


def manual_stage(hosts: tuple[str, ...] = X.VIDEO_HOSTS, short_hosts: tuple[str, ...] = ("youtu.be",)) -> Stage:
    """pastes (url, transcript, title, channel, published, description), staged records and fetched metadata to new records.

    Given values win over fetched ones, then come defaults. A paste without an id, of a staged video, without a segment, or with a date
    that isn't one is refused; ``refused`` tells why. The stage succeeds when none was.
    """

    def run(t: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], bool]:
        given = {c: F.col(c) for c in ("title", "channel", "published", "description")}
        pastes = t["pastes"].select(X.video_id_of(F.col("url"), hosts, short_hosts).alias("video_id"), "url", "transcript", *[v.alias(c) for c, v in registry.with_given(given).items()])
        pastes = cut(pastes.withColumn("paste", F.monotonically_increasing_id()))
        cues = pasted.parse_pasted(pastes, "paste", "transcript")
        parsed = cues.groupBy(F.col("key").alias("paste")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text", "start", "duration"))), lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["duration"].alias("duration"))).alias("transcript_segments"))
        staged = t["records"].select("video_id").where("video_id IS NOT NULL").distinct().withColumn("_staged", F.lit(True))
        named = records.merged_metadata(pastes.where("video_id IS NOT NULL").drop("url", "transcript"), t["fetched"], "video_id", "paste")
        j = pastes.select("paste", "video_id", "url").join(named.drop("video_id"), "paste", "left").join(parsed, "paste", "left").join(staged, "video_id", "left")
        reason = (
            F.when(F.col("video_id").isNull(), "no video id").when(F.col("_staged"), "already staged").when(F.col("transcript_segments").isNull(), "no segment in the transcript")
            .when((F.col("published") != "") & ~X.is_date(F.col("published")), "published date must be a real date in YYYY-MM-DD format")
        )
        j = cut(j.withColumn("reason", reason))
        new = j.where("reason IS NULL").withColumn("transcript_text", segments.transcript_text(F.col("transcript_segments")))
        new = new.withColumn("word_count", X.word_count(F.col("transcript_text"))).withColumn("md_path", records.output_path(F.col("channel"), F.col("title"))).drop("reason", "_staged", "paste")
        refused = j.where("reason IS NOT NULL").select("url", "video_id", "reason")
        return {"manual_records": new, "refused": refused}, refused.isEmpty()

    return Stage("manual", run)


def ingest_stage(folder: str = "", host: str = X.DOCUMENT_HOST) -> Stage:
    """clean_documents (path, content), ingested documents (path, content) and registry videos to the files to copy and the new rows.

    A document without an identity, one whose target is another video's, and one whose video is missing or in another state is an error;
    a target of the same video is kept and the row is repaired. The stage succeeds when there is no error.
    """

    def run(t: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], bool]:
        files = transitions.ingest_files(t["clean_documents"], t["ingested_documents"], host)
        v = t["videos"].select(F.col("video_id").alias("_id"), F.col("status").alias("_status"), F.col("clean_path").alias("_path"))
        j = files.join(v, F.col("video_id") == F.col("_id"), "left")
        row = transitions.ingest_row(F.col("_status"), F.col("_path"), F.concat(F.lit(folder), F.col("path")), records.is_companion(F.col("path")))
        outcome = F.when(F.col("action") == "error", "error").otherwise(row["outcome"])
        out = cut(j.select("path", "video_id", "action", outcome.alias("outcome"), row["status"].alias("new_status"), row["clean_path"].alias("new_path")))
        return {"ingest": out, "copies": t["clean_documents"].join(out.where("action = 'copy'").select("path"), "path", "left_semi")}, out.where("outcome = 'error'").isEmpty()

    return Stage("ingest", run)


def clean_stage(p: Params = DEFAULTS, host: str = X.DOCUMENT_HOST) -> Stage:
    """records and documents to cleaned rows with their outcome; the documents are columns, written by a sink."""

    def run(t: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], bool]:
        rows = segments.clean(records.last_wins(t["records"], "video_id", "line_no"), p)
        rows = rows.withColumn("path", records.output_path(F.col("channel"), F.col("title")))
        rows = cut(transitions.clean_outcomes(rows, t["documents"], host))
        meta = {c: F.col(c) for c in ("title", "channel", "published", "url", "created_at", "description")}
        docs = rows.where("outcome = 'saved'").select("video_id", "path", render.clean_markdown(meta, F.col("cleaned")).alias("content"))
        return {"cleaned": rows, "clean_documents": docs}, not rows.where("outcome = 'error'").limit(1).count()

    return Stage("clean", run)


def rewrite_stage(model: enrich.ModelClient, p: Params = DEFAULTS) -> Stage:
    def run(t: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], bool]:
        if not model.ping():
            return {}, False
        chunked = t["cleaned"].where("cleaned IS NOT NULL").select("video_id", "title", chunks.chunk_blocks(chunks.split_blocks(F.col("cleaned")), p.chunk_words).alias("chunks"))
        return {"rewritten": cut(enrich.rewrite(chunked, model, p))}, True

    return Stage("rewrite", run)


def enrich_stage(model: enrich.ModelClient, p: Params = DEFAULTS) -> Stage:
    """Item failures are rows with an error and never fail the stage."""

    def run(t: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], bool]:
        if not model.ping():
            return {}, False
        bodies = t["cleaned"].where("cleaned IS NOT NULL").select("video_id", "title", "chapters", F.col("cleaned").alias("body"))
        if "rewritten" in t:
            bodies = bodies.join(t["rewritten"].select("video_id", "article"), "video_id", "left").select("video_id", "title", "chapters", X.first_filled(F.col("article"), F.col("body")).alias("body"))
        return {"enriched": cut(enrich.enrich(bodies, model, p))}, True

    return Stage("enrich", run)
