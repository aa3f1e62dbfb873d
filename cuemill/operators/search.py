"""Registry search: full text over title and description, channel, topic, status and tags."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that a full-text query ignores.
IGNORED = frozenset(
    """a an the and or but if then else of at by for with about to from in out on off over under is are was were be been being have has had
    do does did will would can could should this that these those i you he she it we they me him her us them my your his its our their
    what which who whom when where why how all any both each few more most other some such no nor not only own same so than too very""".split()
)


def _measure(stem: str) -> int:
    return len(re.findall(r"[aeiouy]+[^aeiouy]+", stem))


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """A light suffix stemmer for English: plurals, -ed, -ing, and common derivations whose stem keeps a syllable."""
    w = word
    if len(w) <= 3:
        return w
    w = re.sub(r"(ss|i)es$", r"\1", w) if w.endswith(("sses", "ies")) else re.sub(r"([^s])s$", r"\1", w)
    for end in ("eed", "ed", "ing"):
        if w.endswith(end):
            base = w[: -len(end)]
            if end == "eed":
                w = base + "ee" if _measure(base) else w
            elif re.search(r"[aeiouy]", base):
                w = base
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif re.search(r"([^aeiouylsz])\1$", w):
                    w = w[:-1]
                elif _measure(w) == 1 and re.search(r"[^aeiou][aeiouy][^aeiouwxy]$", w):
                    w += "e"
            break
    if w.endswith("y") and re.search(r"[aeiouy]", w[:-1]):
        w = w[:-1] + "i"
    for end, to in (("ational", "ate"), ("ization", "ize"), ("fulness", "ful"), ("iveness", "ive"), ("ousness", "ous"), ("biliti", "ble"), ("tional", "tion"), ("alism", "al"), ("aliti", "al"), ("ation", "ate"), ("izer", "ize"), ("ator", "ate"), ("entli", "ent"), ("ousli", "ous"), ("alli", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", "")):
        if w.endswith(end) and _measure(w[: -len(end)]) > 0:
            w = w[: -len(end)] + to
            break
    if w.endswith("e") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


def terms(text: str) -> list[str]:
    return [stem(w) for w in re.findall(r"[^\W_]+", text.lower()) if w not in IGNORED]


@F.pandas_udf(T.ArrayType(T.StringType()))
def stems(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(set(terms(t or ""))))


def searchable(videos: DataFrame) -> DataFrame:
    """Rows with ``stems``, the terms of title and description, to be stored where many queries follow: a search then stems its query only."""
    return videos.withColumn("stems", stems(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))))


def matches(document: Column, query: str) -> Column:
    """Every term of the query stands among the document's stems; a query without terms matches nothing."""
    wanted = sorted(set(terms(query)))
    if not wanted:
        return F.lit(False)
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), document)) == 0


def search(
    videos: DataFrame, query: str | None = None, channel: str | None = None, topic: str | None = None, status: str | None = None,
    tags: list[str] | None = None, limit: int = 50, offset: int = 0,
) -> DataFrame:
    """Videos that pass all given filters, the newest scrape first. Empty filters are skipped.

    Channel is a pattern anywhere in the name, case aside; all tags must be there. A stored ``stems`` column (searchable) is used
    where there is one; otherwise the cheap filters come first, so the stemmer sees what they leave.
    """
    out = videos
    if status:
        out = out.where(F.col("status") == status)
    if topic:
        out = out.where(F.col("topic") == topic)
    if channel:
        out = out.where(F.col("channel").ilike(f"%{channel}%"))
    if tags:
        out = out.where(F.size(F.array_except(F.array(*map(F.lit, tags)), F.coalesce("tags", F.array().cast("array<string>")))) == 0)
    if query:
        kept = videos.columns
        out = (out if "stems" in kept else searchable(out)).where(matches(F.col("stems"), query)).select(*kept)
    return out.orderBy(F.col("scraped_at").desc_nulls_last(), "video_id").offset(offset).limit(limit)
