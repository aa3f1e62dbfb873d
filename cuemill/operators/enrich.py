"""Model-backed operators behind a small client protocol: enrichment, rewriting, prompts, and normalisation of answers.

Records hold their chunks as an array, so a video's sequential rewrite runs inside one row and videos run in parallel.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.operators.chunks import covers
from cuemill.params import CONTENT_KINDS, DEFAULTS, DIFFICULTIES, Params
from cuemill.schema import ENRICHMENT


#: What the follow-up prompt for concepts asks for.
CONCEPTS_ASKED = "Name three to eight terms or concepts of this video, as the JSON list 'concepts'."
REASONING_OFF = "/no_think\n"
FENCE = re.compile(r"^```(?:markdown|md)?\s*\n(.*)\n```$", re.S)


class ModelClient(Protocol):
    """What the operators need of a language model; it must be picklable."""

    name: str

    def ping(self) -> bool: ...

    def complete(self, prompt: str, temperature: float, limit: int) -> str | None: ...


class EchoModel:
    """A deterministic stand-in: rewrites return the marked source, enrichment answers a fixed shape.

    ``fenced`` wraps rewrites in a code fence, as many models do; ``forgetful`` leaves the concepts of an enrichment out.
    """

    def __init__(self, name: str = "echo", fenced: bool = False, forgetful: bool = False):
        self.name, self.fenced, self.forgetful = name, fenced, forgetful

    def ping(self) -> bool:
        return True

    def complete(self, prompt: str, temperature: float, limit: int) -> str | None:
        if CONCEPTS_ASKED in prompt:
            return json.dumps({"concepts": [f" {w} " for w in prompt.split("Summary:\n", 1)[-1].split()[:2]] + [" "]})
        if "JSON" in prompt:
            head = prompt.rsplit("\n", 1)[-1].split()[:3]
            chapters = [x for line in prompt.split("\n") if line.startswith("Chapters: ") for x in line.removeprefix("Chapters: ").split("; ")]
            sections = [{"heading": c, "summary": ""} for c in chapters]
            return json.dumps({"summary": " ".join(head), "key_concepts": [] if self.forgetful else head, "domains": ["General"], "difficulty": "Beginner", "content_kind": "talk", "sections": sections})
        out = prompt.rsplit("<source>\n", 1)[-1].removesuffix("\n</source>")
        return f"```markdown\n{out}\n```" if self.fenced else out


def system_prefix(model: Column) -> Column:
    """The switch that turns long reasoning off for models of one family."""
    return F.when(F.startswith(F.lower(model), F.lit("qwen")), F.lit(REASONING_OFF)).otherwise(F.lit(""))


def prefix_of(model: str) -> str:
    """The same for a model's name."""
    return REASONING_OFF if model.lower().startswith("qwen") else ""


def unfenced(answer: str) -> str:
    """An answer without one outer code fence around the whole of it."""
    m = FENCE.match(answer.strip())
    return m[1].strip() if m else answer


def enrichment_prompt(title: Column, body: Column, chapters: Column | None = None, p: Params = DEFAULTS) -> Column:
    """Prompt for structured metadata of a capped text."""
    if chapters is None:
        hints = F.lit(None).cast("string")
    else:
        titles = F.transform(F.filter(chapters, lambda c: F.coalesce(c["title"], F.lit("")) != ""), lambda c: X.line_event(X.strip(c["title"])))
        hints = F.when(F.size(titles) > 0, F.concat(F.lit("Chapters: "), F.array_join(titles, "; ")))
    return F.concat_ws("\n", F.concat(F.lit("Describe the following video as JSON. Title: "), F.coalesce(title, F.lit(""))), hints, F.lit("Transcript:"), X.cap_words(body, p.max_input_words))


def rewrite_prompt(title: str, heading: str | None, before: str, source: str) -> str:
    parts = [f"Rewrite a part of the transcript of “{title}” as readable prose. Leave nothing out and add nothing."]
    if heading:
        parts.append(f"Section: {heading}")
    if before:
        parts.append(f"The text so far ends with:\n{before}")
    return "\n\n".join([*parts, f"<source>\n{source}\n</source>"])


def normalised(e: Column) -> Column:
    """Answer with its enums in vocabulary, lists trimmed, without blanks and cut to length, domains in lower case."""
    known = lambda c, allowed, other: F.when(F.lower(X.strip(c)).isin(*allowed), F.lower(X.strip(c))).otherwise(F.lit(other))
    tidy = lambda c, n: F.slice(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), X.strip), lambda x: x != ""), 1, n)
    return F.struct(
        e["summary"].alias("summary"), tidy(e["key_concepts"], 8).alias("key_concepts"), F.transform(tidy(e["domains"], 4), F.lower).alias("domains"),
        known(e["difficulty"], DIFFICULTIES, "intermediate").alias("difficulty"), known(e["content_kind"], CONTENT_KINDS, "other").alias("content_kind"), e["sections"].alias("sections"),
    )


def _concepts(model: ModelClient, enrichment: str) -> list[str]:
    """Concepts asked for once more, over the summary and the section notes alone; none where the answer is no such list."""
    e = json.loads(enrichment)
    notes = [f"{x.get('heading') or ''}: {x.get('summary') or ''}" for x in e.get("sections") or []]
    answer = model.complete("\n".join([prefix_of(model.name) + CONCEPTS_ASKED, "Summary:", e.get("summary") or "", *notes]), 0.2, 512)
    try:
        found = json.loads(answer or "")["concepts"]
        return [c.strip() for c in found if c.strip()][:8]
    except (ValueError, TypeError, KeyError, AttributeError):
        return []


def enrich(texts: DataFrame, model: ModelClient, p: Params = DEFAULTS) -> DataFrame:
    """(video_id, enrichment, error, duration_ms, model) of (video_id, title, body, chapters where there are any).

    An answer that isn't the schema's JSON is an error. Valid answers without a concept are asked for concepts once more.
    """
    chapters = F.col("chapters") if "chapters" in texts.columns else None
    prompt = F.concat(F.lit(prefix_of(model.name)), enrichment_prompt(F.col("title"), F.col("body"), chapters, p))
    asked = texts.select("video_id", prompt.alias("prompt"), X.first_filled(F.col("body")).alias("body"))

    def usable(raw: str | None) -> bool:
        try:
            e = json.loads(raw or "")
            return isinstance(e, dict) and isinstance(e.get("summary"), str)
        except ValueError:
            return False

    def call(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw, more, ms = [], [], []
            for prompt, body in zip(f["prompt"], f["body"]):
                began = time.monotonic()
                answer = model.complete(prompt, 0.2, 2048) if body.strip() else None
                lacking = usable(answer) and not any(isinstance(c, str) and c.strip() for c in json.loads(answer).get("key_concepts") or [])
                raw.append(answer)
                more.append(_concepts(model, answer) if lacking else None)
                ms.append(int((time.monotonic() - began) * 1000))
            yield pd.DataFrame({"video_id": f["video_id"], "raw": raw, "more": more, "duration_ms": ms, "blank": [not b.strip() for b in f["body"]]})

    out = asked.mapInPandas(call, "video_id string, raw string, more array<string>, duration_ms int, blank boolean")
    parsed = out.withColumn("e", F.from_json("raw", ENRICHMENT))
    bad = F.when(F.col("blank"), "no prose").when(F.col("raw").isNull(), "no answer").when(F.col("e").isNull() | F.col("e.summary").isNull(), "invalid answer")
    tidy = normalised(F.col("e"))
    whole = F.when(F.col("more").isNotNull(), tidy.withField("key_concepts", F.col("more"))).otherwise(tidy)
    return parsed.select("video_id", F.when(bad.isNull(), whole).alias("enrichment"), bad.alias("error"), "duration_ms", F.lit(model.name).alias("model"))


def rewrite(records: DataFrame, model: ModelClient, p: Params = DEFAULTS) -> DataFrame:
    """(video_id, article, chunks, fallbacks, words_in, words_out, error) of (video_id, title, chunks).

    Chunks go in order, each prompt with the last words of the text so far; answers lose an outer code fence; a chunk whose tries all fail the coverage guard
    stays verbatim; headings are written once per run.
    """

    def one(title: str, chunks) -> tuple:
        shown, parts, before, fallbacks, n_in, n_out = None, [], "", 0, 0, 0
        for c in chunks:
            out = None
            for attempt in range(p.rewrite_attempts):
                limit = int(c["words"] * p.max_ratio * 1.4) + 128
                answer = model.complete(prefix_of(model.name) + rewrite_prompt(title, c["heading"], before, c["text"]), 0.3 / (attempt + 1), limit)
                if answer is None:
                    break
                answer = unfenced(answer)
                if covers(c["text"], answer, p):
                    out = answer.strip()
                    break
            fallbacks += out is None
            out = c["text"] if out is None else out
            if c["heading"] and c["heading"] != shown:
                parts.append(f"## {c['heading']}")
                shown = c["heading"]
            parts.append(out)
            before = " ".join(out.split()[-p.context_words :])
            n_in, n_out = n_in + len(c["text"].split()), n_out + len(out.split())
        return ("\n\n".join(parts) or None, len(chunks), fallbacks, n_in, n_out, None if parts else "no_prose_to_rewrite")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["article", "chunks", "fallbacks", "words_in", "words_out", "error"]
        for f in frames:
            rows = [one(t or "", [] if c is None else list(c)) for t, c in zip(f["title"], f["chunks"])]
            yield pd.DataFrame({"video_id": f["video_id"], **{n: [r[i] for r in rows] for i, n in enumerate(names)}})

    return records.select("video_id", "title", "chunks").mapInPandas(run, "video_id string, article string, chunks int, fallbacks int, words_in int, words_out int, error string")
