"""Pasted transcripts: cues (SRT, WebVTT), timestamped lines, or prose with a made-up clock, as segments.

A document's style is an expression inside its row. Lines are exploded once for cues and stamps alike: their groups are running
counts over each document's lines, gathered in one aggregation behind one exchange. Prose is cut by an array fold inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.runtime import once, widen

# fixed values: stamp shape, pace and sizes
STAMP = r"(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?"
CUE = rf"^\s*({STAMP})\s*-->\s*({STAMP})"
STAMPED = rf"(?d)^\s*\[?\(?({STAMP})\)?\]?\s*(.*)$"
WORDS_PER_SECOND = 2.5
PARAGRAPH_GAP = 4.0
CHUNK_WORDS = 22
LAST_SECONDS = 3.0
LEAST_SECONDS = 0.1
# the same shapes anywhere in a whole text, line by line
_ANY_CUE = rf"(?md)^[^\S\n]*{STAMP}[^\S\n]*-->[^\S\n]*{STAMP}"
_ANY_STAMP = rf"(?md)^[^\S\n]*\[?\(?{STAMP}"


def _styled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, style, body) of every document: cues, stamped, prose, or empty. Line ends are line feeds, WEBVTT lines are gone."""
    lines = F.split(F.regexp_replace(F.col("body"), "\r\n|\r", "\n"), "\n")
    kept = F.coalesce(F.array_join(F.filter(lines, lambda x: F.upper(X.strip(x)) != "WEBVTT"), "\n"), F.lit(""))
    rows = once(widen(docs).select(F.col(key).alias("key"), F.col(text).alias("body")), tidy=kept).select("key", F.col("tidy").alias("body"))
    style = F.when(F.col("body").rlike(_ANY_CUE), "cues").when(F.col("body").rlike(_ANY_STAMP), "stamped").when(X.strip(F.col("body")) != "", "prose").otherwise("empty")
    return rows.select("key", style.alias("style"), "body")


def styles(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, style): cues, stamped, prose, or empty."""
    return _styled(docs, key, text).select("key", "style").distinct()


def _finish(pairs: DataFrame) -> DataFrame:
    """(key, style, at, start, end, text) to segments: an end after the start gives the duration, else the next start, else a default."""
    w = Window.partitionBy("key").orderBy("at")
    ahead = F.lead("start").over(w)
    duration = F.when(F.col("end") > F.col("start"), F.col("end") - F.col("start")).when(ahead.isNotNull(), F.greatest(F.lit(LEAST_SECONDS), ahead - F.col("start"))).otherwise(F.lit(LAST_SECONDS))
    out = pairs.withColumn("duration", duration).where(X.strip(F.col("text")) != "")
    return out.select("key", "style", "at", F.round("start", 3).alias("start"), F.round("duration", 3).alias("duration"), X.strip(F.col("text")).alias("text"))


def _line_segments(styled: DataFrame) -> DataFrame:
    """(key, style, at, start, duration, text) of rows (key, style, body) of the styles cues and stamped.

    A timing line opens a cue and a blank line closes it; other lines of an open cue are its text, numbers included. A stamped line
    opens a segment that later lines continue; blank lines don't count, nor do lines before the first stamp.
    """
    cue = F.col("style") == "cues"
    rows = styled.select("key", "style", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    rows = rows.select("key", "style", "pos", "line", F.when(cue, F.col("line").rlike(CUE)).otherwise(F.col("line").rlike(STAMPED) & (X.strip(F.col("line")) != "")).alias("opens"), (X.strip(F.col("line")) == "").alias("blank"))
    w = Window.partitionBy("key").orderBy("pos")
    last = lambda c: F.max(F.when(F.col(c), F.col("pos"))).over(w)
    rows = rows.select("*", F.sum(F.col("opens").cast("int")).over(w).alias("at"), last("opens").alias("opened"), F.coalesce(last("blank"), F.lit(-1)).alias("shut"))
    rows = rows.where((F.col("at") > 0) & F.when(cue, F.col("shut") < F.col("opened")).otherwise(~F.col("blank")))
    shape = lambda of_cue, of_stamp: F.when(cue, F.regexp_extract("line", CUE, of_cue)).otherwise(F.regexp_extract("line", STAMPED, of_stamp))
    head = F.col("opens")
    part = X.strip(F.when(head & cue, F.lit("")).when(head, F.regexp_extract("line", STAMPED, 2)).otherwise(F.col("line")))
    rows = rows.select("key", "style", "at", "pos", part.alias("part"), F.when(head, X.to_seconds(shape(1, 1))).alias("start"), F.when(head & cue, X.to_seconds(F.regexp_extract("line", CUE, 2))).alias("end"))
    parts = F.array_sort(F.collect_list(F.when(F.col("part") != "", F.struct("pos", "part"))))
    groups = rows.groupBy("key", "style", "at").agg(F.max("start").alias("start"), F.max("end").alias("end"), F.array_join(F.transform(parts, lambda x: x["part"]), " ").alias("text"))
    return _finish(groups.where("text <> ''"))


def _of_style(docs: DataFrame, key: str, text: str, style: str) -> DataFrame:
    return _line_segments(_styled(docs, key, text).withColumn("style", F.lit(style))).drop("style")


def cue_segments(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, start, duration, text) of every document read as cues."""
    return _of_style(docs, key, text, "cues")


def stamped_segments(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, start, duration, text) of every document read as stamped lines."""
    return _of_style(docs, key, text, "stamped")


def _sentence_chunks(paragraph: Column) -> Column:
    """Words of sentences gather until a chunk is long enough; a longer sentence stands alone, cut by the chunk size."""
    flat = F.array_join(X.words(paragraph), " ")
    sentences = F.filter(F.split(flat, r"(?U)(?<=[.!?])\s+"), lambda s: X.strip(s) != "")
    none = F.array().cast("array<string>")
    kind = "struct<done:array<array<string>>,open:array<string>>"
    zero = F.struct(F.array().cast("array<array<string>>").alias("done"), none.alias("open")).cast(kind)

    def shut(a: Column) -> Column:
        return F.when(F.size(a["open"]) == 0, a["done"]).otherwise(F.concat(a["done"], F.array(a["open"])))

    def step(a: Column, s: Column) -> Column:
        ws = X.words(s)
        cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size(ws) - 1) / CHUNK_WORDS).cast("int")), lambda i: F.slice(ws, i * CHUNK_WORDS + 1, F.lit(CHUNK_WORDS)))
        grown = F.concat(a["open"], ws)
        pair = lambda done, left: F.struct(done.alias("done"), left.alias("open")).cast(kind)
        return F.when(F.size(ws) > CHUNK_WORDS, pair(F.concat(shut(a), cuts), none)).when(F.size(grown) >= CHUNK_WORDS, pair(F.concat(a["done"], F.array(grown)), none)).otherwise(pair(a["done"], grown))

    return F.aggregate(sentences, zero, step, shut)


def _prose(bodies: DataFrame) -> DataFrame:
    paragraphs = F.filter(F.split("body", r"\n\s*\n"), lambda p: X.strip(p) != "")
    rows = bodies.select("key", F.posexplode(paragraphs).alias("para", "p")).select("key", "para", F.posexplode(_sentence_chunks(F.col("p"))).alias("k", "ws"))
    rows = rows.withColumn("seconds", F.greatest(F.lit(1.0), F.size("ws") / F.lit(WORDS_PER_SECOND)))
    w = Window.partitionBy("key").orderBy("para", "k")
    clock = F.coalesce(F.sum("seconds").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + F.col("para") * F.lit(PARAGRAPH_GAP)
    return rows.select("key", (F.row_number().over(w)).alias("at"), F.round(clock, 3).alias("start"), F.round("seconds", 3).alias("duration"), F.array_join("ws", " ").alias("text"))


def prose_segments(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Text without stamps: chunks at a speaking pace, a pause between paragraphs."""
    return _prose(_styled(docs, key, text))


def parse_pasted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, style, at, start, duration, text) of every document, read in its own style; empty documents have no rows."""
    styled = _styled(docs, key, text)
    lined = _line_segments(styled.where(F.col("style").isin("cues", "stamped")))
    spoken = _prose(styled.where("style = 'prose'")).withColumn("style", F.lit("prose"))
    return lined.select(*_COLUMNS).unionByName(spoken.select(*_COLUMNS)).withColumn("at", F.col("at").cast("int"))


_COLUMNS = ("key", "style", "at", "start", "duration", "text")


def word_totals(segments: DataFrame) -> DataFrame:
    """(key, segments, words) of parsed documents."""
    return segments.groupBy("key").agg(F.count("*").alias("segments"), F.sum(X.word_count(F.col("text"))).alias("words"))
