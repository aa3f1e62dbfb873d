"""Blocks, size-bounded chunks, the coverage guard, and assembly of rewritten chunks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.params import DEFAULTS, Params
from cuemill.runtime import widen


def split_blocks(body: Column) -> Column:
    """array<struct<kind, text>>: parts between blank lines; parts that begin with # are headings, without their #s."""
    parts = F.filter(F.transform(F.split(body, "\n\n"), X.strip), lambda b: b != "")
    return F.transform(
        parts,
        lambda b: F.when(F.startswith(b, F.lit("#")), F.struct(F.lit("heading").alias("kind"), X.strip(F.regexp_replace(b, "^#+", "")).alias("text"))).otherwise(
            F.struct(F.lit("para").alias("kind"), b.alias("text"))
        ),
    )


_CHUNK = "struct<heading:string,paragraphs:array<string>,words:int>"


def chunk_blocks(blocks: Column, target: int = DEFAULTS.chunk_words) -> Column:
    """Chunks of whole paragraphs: a heading closes the chunk and names the next; a chunk closes once it reaches the target.

    array<struct<chunk_idx, heading, paragraphs, text, words>>. Headings without a paragraph leave no chunk.
    """
    none = F.array().cast("array<string>")
    zero = F.struct(F.array().cast(f"array<{_CHUNK}>").alias("done"), F.lit(None).cast("string").alias("heading"), none.alias("open"), F.lit(0).alias("words"))

    def closed(a: Column) -> Column:
        return F.when(F.size(a["open"]) == 0, a["done"]).otherwise(F.concat(a["done"], F.array(F.struct(a["heading"].alias("heading"), a["open"].alias("paragraphs"), a["words"].alias("words")))))

    def step(a: Column, b: Column) -> Column:
        grown = F.concat(a["open"], F.array(b["text"]))
        n = a["words"] + X.word_count(b["text"])
        full = F.concat(a["done"], F.array(F.struct(a["heading"].alias("heading"), grown.alias("paragraphs"), n.alias("words"))))
        fresh = lambda done, heading: F.struct(done.alias("done"), heading.alias("heading"), none.alias("open"), F.lit(0).alias("words"))
        return (
            F.when(b["kind"] == "heading", fresh(closed(a), b["text"]))
            .when(n >= target, fresh(full, a["heading"]))
            .otherwise(F.struct(a["done"].alias("done"), a["heading"].alias("heading"), grown.alias("open"), n.alias("words")))
        )

    kind = f"struct<done:array<{_CHUNK}>,heading:string,open:array<string>,words:int>"
    done = F.aggregate(blocks, zero.cast(kind), lambda a, b: step(a, b).cast(kind), closed)
    return F.transform(done, lambda c, i: F.struct(i.alias("chunk_idx"), c["heading"].alias("heading"), c["paragraphs"].alias("paragraphs"), F.array_join(c["paragraphs"], "\n\n").alias("text"), c["words"].alias("words")))


def chunk_rows(docs: DataFrame, key: str, body: str, target: int = DEFAULTS.chunk_words) -> DataFrame:
    """(key, chunk_idx, heading, text, words), one row per chunk."""
    out = widen(docs).select(key, F.explode(chunk_blocks(split_blocks(F.col(body)), target)).alias("c"))
    return out.select(key, "c.chunk_idx", "c.heading", "c.text", "c.words")


def coverage(source: Column, output: Column) -> tuple[Column, Column]:
    """(word ratio, share of the source's content words that survive); an empty source gives 0, one without content words 1."""
    n = X.word_count(source)
    ratio = F.when(n > 0, X.word_count(output) / n).otherwise(F.lit(0.0))
    terms = X.content_words(source)
    kept = F.size(F.array_intersect(terms, X.content_words(output)))
    return ratio, F.when(F.size(terms) == 0, F.lit(1.0)).otherwise(kept / F.size(terms))


def coverage_failure(output: Column, ratio: Column, retention: Column, p: Params = DEFAULTS) -> Column:
    """Why a rewrite isn't accepted, in the order of the checks; null when it is."""
    return (
        F.when(X.strip(output) == "", F.lit("empty output"))
        .when(ratio < p.min_ratio, F.concat(F.lit("too short (ratio "), X.two_decimals(ratio), F.lit(f" < {p.min_ratio})")))
        .when(ratio > p.max_ratio, F.concat(F.lit("too long (ratio "), X.two_decimals(ratio), F.lit(f" > {p.max_ratio})")))
        .when(retention < p.min_retention, F.concat(F.lit("dropped content (retention "), X.two_decimals(retention), F.lit(f" < {p.min_retention})")))
    )


def covers(source: str, output: str, p: Params = DEFAULTS) -> bool:
    """The same guard for one pair of texts, where a model's next call depends on it."""

    def terms(t: str) -> set[str]:
        return {w for w in re.findall(r"[a-z0-9][a-z0-9'\-]*", t.lower()) if len(w) > 3} - set(X.STOPWORDS)

    n, wanted = len(source.split()), terms(source)
    ratio = len(output.split()) / n if n else 0.0
    kept = len(wanted & terms(output)) / len(wanted) if wanted else 1.0
    return bool(output.strip()) and p.min_ratio <= ratio <= p.max_ratio and kept >= p.min_retention


def accepted(source: Column, *attempts: Column, p: Params = DEFAULTS) -> Column:
    """The first attempt that passes the guard; a null attempt ends the tries; otherwise the source itself."""
    out, alive = F.lit(None).cast("string"), F.lit(True)
    for attempt in attempts[: p.rewrite_attempts]:
        alive = alive & attempt.isNotNull()
        passes = alive & coverage_failure(attempt, *coverage(source, attempt), p).isNull()
        out = F.coalesce(out, F.when(passes, attempt))
    return F.coalesce(out, source)


def assemble(chunks: DataFrame, key: str, heading: str = "heading", text: str = "text") -> DataFrame:
    """(key, article): chunk texts in order, a heading once per run of equal headings."""
    w = Window.partitionBy(key).orderBy("chunk_idx")
    last = F.last(F.col(heading), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    shown = F.col(heading).isNotNull() & (F.col(heading) != "") & ~F.col(heading).eqNullSafe(last)
    part = F.when(shown, F.concat(F.lit("## "), F.col(heading), F.lit("\n\n"), F.col(text))).otherwise(F.col(text))
    marked = chunks.withColumn("part", part)
    ordered = marked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk_idx", "part"))).alias("parts"))
    return ordered.select(key, F.array_join(F.transform("parts", lambda x: x["part"]), "\n\n").alias("article"))


def rewrite_totals(chunks: DataFrame, key: str) -> DataFrame:
    """(key, chunks, fallbacks, words_in, words_out, ratio) over (source, output, fallback) rows."""
    out = chunks.groupBy(key).agg(
        F.count("*").alias("chunks"), F.count_if("fallback").alias("fallbacks"),
        F.sum(X.word_count(F.col("source"))).alias("words_in"), F.sum(X.word_count(F.col("output"))).alias("words_out"),
    )
    return out.withColumn("ratio", F.when(F.col("words_in") > 0, F.col("words_out") / F.col("words_in")).otherwise(F.lit(0.0)))
