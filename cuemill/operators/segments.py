"""Ordered operators over a record's nested segments.

A record carries its segments in list order, so gaps, markers and the paragraph fold are array expressions inside one
row: no explode, no shuffle, and a video's cost never leaves its task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.params import DEFAULTS, Params
from cuemill.runtime import once, widen


def _length(s: Column) -> Column:
    return F.coalesce(s["duration"], F.lit(0.0))


def gaps(segments: Column) -> Column:
    """Silence before every segment but the first: its start minus the end of the one before."""
    later = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    earlier = F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 1, F.lit(0)))
    return F.zip_with(earlier, later, lambda a, b: b["start"] - (a["start"] + _length(a)))


def gap_threshold(segments: Column, p: Params = DEFAULTS) -> Column:
    """The adaptive pause length: the value at rank int(0.8 n) of the sorted positive gaps, within bounds.

    Fewer segments than the minimum, or no positive gap, give the default. The rank rule isn't a percentile function's.
    """
    positive = F.array_sort(F.filter(gaps(segments), lambda g: g > 0))
    ranked = F.get(positive, F.floor(F.size(positive) * F.lit(float(p.gap_rank))).cast("int"))
    bounded = F.greatest(F.lit(p.gap_low), F.least(F.lit(p.gap_high), ranked))
    default = F.lit(p.gap_default)
    return F.when(F.size(segments) < p.gap_min_segments, default).when(F.size(positive) == 0, default).otherwise(bounded)


def long_form(records: DataFrame, *keys: str) -> DataFrame:
    """One row per segment with its position."""
    out = records.select(*keys, F.posexplode("transcript_segments").alias("pos", "seg"))
    return out.select(*keys, "pos", F.col("seg.text").alias("text"), F.col("seg.start").alias("start"), F.col("seg.duration").alias("duration"))


def gap_rows(rows: DataFrame, key: str, pos: str, start: str, duration: str, p: Params = DEFAULTS) -> DataFrame:
    """The same threshold for rows that aren't nested: lag over each key, then the ranked pick. Returns (key, n, threshold)."""
    w = Window.partitionBy(key).orderBy(pos)
    end = F.lag(F.col(start) + F.coalesce(F.col(duration), F.lit(0.0))).over(w)
    g = rows.withColumn("gap", F.col(start) - end)
    g = g.withColumn("rank", F.row_number().over(Window.partitionBy(key, F.col("gap") > 0).orderBy("gap")))
    n = F.count_if(F.col("gap") > 0).over(Window.partitionBy(key))
    g = g.withColumn("pick", (F.col("gap") > 0) & (F.col("rank") == F.floor(n * F.lit(float(p.gap_rank))) + 1))
    out = g.groupBy(key).agg(F.count("*").alias("n"), F.max(F.when(F.col("pick"), F.col("gap"))).alias("ranked"))
    bounded = F.greatest(F.lit(p.gap_low), F.least(F.lit(p.gap_high), F.col("ranked")))
    return out.select(key, "n", F.when((F.col("n") < p.gap_min_segments) | F.col("ranked").isNull(), F.lit(p.gap_default)).otherwise(bounded).alias("threshold"))


def markers(chapters: Column) -> Column:
    """Usable chapters in order of start, stable: those with a title and a start."""
    usable = F.filter(F.coalesce(chapters, F.array().cast("array<struct<title:string,start_time:double,end_time:double>>")), lambda c: (F.coalesce(c["title"], F.lit("")) != "") & c["start_time"].isNotNull())
    keyed = F.transform(usable, lambda c, i: F.struct(c["start_time"].alias("start"), i.alias("i"), F.concat(F.lit("## "), X.strip(c["title"])).alias("text")))
    return F.array_sort(keyed)


def inject_chapters(segments: Column, chapters: Column) -> Column:
    """Segments with heading markers: each goes before the first segment, in list order, that starts no earlier; the rest go last.

    array<struct<text, start, duration, is_heading>>.
    """
    item = lambda text, start, duration, heading: F.struct(text.alias("text"), start.cast("double").alias("start"), duration.cast("double").alias("duration"), heading.alias("is_heading"))
    marks = markers(chapters)
    # the place of a marker: position of the first segment that starts at or after it, or the number of segments
    place = lambda m: F.coalesce(F.nullif(F.array_position(F.transform(segments, lambda s: s["start"] >= m["start"]), True), F.lit(0)).cast("int") - 1, F.size(segments))
    body = F.transform(segments, lambda s: item(s["text"], s["start"], _length(s), F.lit(False)))
    # one sort merges both: by place, markers before the segment at it, then their own order
    keyed = lambda at, kind, k, e: F.struct(at.cast("int").alias("at"), F.lit(kind).alias("kind"), k.cast("int").alias("k"), e.alias("e"))
    heads = F.transform(marks, lambda m, k: keyed(place(m), 0, k, item(m["text"], m["start"], F.lit(0.0), F.lit(True))))
    merged = F.array_sort(F.concat(heads, F.transform(body, lambda e, i: keyed(i, 1, F.lit(0), e))))
    return F.when(F.size(marks) == 0, body).otherwise(F.transform(merged, lambda x: x["e"]))


def chapter_positions(segments: DataFrame, chapters: DataFrame, key: str) -> DataFrame:
    """Marker places by a join on the key with the start as residual: (key, marker, at), for chapters kept in a table of their own."""
    n = segments.groupBy(key).agg(F.count("*").alias("n"))
    s = segments.select(F.col(key).alias("k"), "pos", F.col("start").alias("seg_start"))
    j = chapters.join(s, (chapters[key] == s["k"]) & (s["seg_start"] >= chapters["start_time"]), "left")
    least = j.groupBy(chapters[key], "marker").agg(F.min("pos").alias("pos"))
    return least.join(n, key).select(key, "marker", F.coalesce("pos", "n").cast("int").alias("at"))


def looks_like_heading(text: Column, gap: Column, threshold: Column, p: Params = DEFAULTS) -> Column:
    """Short, unpunctuated, beginning with a capital, after a pause well above the threshold."""
    short = X.word_count(text).between(1, p.heading_max_words)
    return short & ~text.rlike(r"[.!?,;:]$") & text.rlike(r"^\p{Lu}") & (gap >= threshold * p.heading_gap_factor)


_STATE = "struct<blocks:array<string>,open:array<string>,words:int,ends:boolean,end:double,first:boolean>"


def paragraph_blocks(enriched: Column, cleaned: Column, threshold: Column, p: Params = DEFAULTS) -> Column:
    """Left fold of (enriched, cleaned text) into blocks: headings and paragraphs.

    ``enriched`` comes from inject_chapters and ``cleaned`` holds the cleaned text of each of its elements. An open paragraph is
    an array of its pieces, joined once when it is closed; whether it ends a sentence is known from its last piece.
    """
    items = F.zip_with(enriched, cleaned, lambda e, t: F.struct(e["text"].alias("raw"), F.coalesce(t, F.lit("")).alias("text"), e["start"].alias("start"), e["duration"].alias("duration"), e["is_heading"].alias("is_heading")))
    nothing = F.array().cast("array<string>")

    def state(blocks: Column, pieces: Column, n: Column, ends: Column, e: Column) -> Column:
        return F.struct(blocks.alias("blocks"), pieces.alias("open"), n.cast("int").alias("words"), ends.alias("ends"), (e["start"] + e["duration"]).alias("end"), F.lit(False).alias("first"))

    def closed(acc: Column) -> Column:
        return F.when(F.size(acc["open"]) == 0, acc["blocks"]).otherwise(F.concat(acc["blocks"], F.array(F.array_join(acc["open"], " "))))

    def step(acc: Column, e: Column) -> Column:
        gap = F.when(acc["first"], F.lit(0.0)).otherwise(e["start"] - acc["end"])
        titled = ~acc["first"] & looks_like_heading(e["text"], gap, threshold, p)
        breaks = ~acc["first"] & (acc["words"] >= p.paragraph_min_words) & ((gap >= threshold) | acc["ends"])
        n, ends = X.word_count(e["text"]), e["text"].rlike(r"[.!?]['\"]?\s*$")
        heading = lambda text: state(F.concat(closed(acc), F.array(text)), nothing, F.lit(0), F.lit(False), e)
        return (
            F.when(e["is_heading"], heading(e["raw"]))
            .when(e["text"] == "", state(acc["blocks"], acc["open"], acc["words"], acc["ends"], e))
            .when(titled, heading(F.concat(F.lit("## "), e["text"])))
            .when(breaks, state(closed(acc), F.array(e["text"]), n, ends, e))
            .otherwise(state(acc["blocks"], F.concat(acc["open"], F.array(e["text"])), acc["words"] + n, ends, e))
        )

    zero = F.struct(nothing.alias("blocks"), nothing.alias("open"), F.lit(0).alias("words"), F.lit(False).alias("ends"), F.lit(0.0).alias("end"), F.lit(True).alias("first"))
    return F.aggregate(items, zero.cast(_STATE), lambda a, e: step(a, e).cast(_STATE), closed)


def clean(records: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Records with ``threshold``, ``blocks``, ``prose_words`` and ``cleaned``, the Markdown body; null where the record is filtered out.

    Needs transcript_segments and chapters. The threshold is taken from the raw segments; the body is null for records
    without segments and for those whose blocks other than headings hold fewer words than the minimum.
    """
    segments = F.coalesce(F.col("transcript_segments"), F.array().cast("array<struct<text:string,start:double,duration:double>>"))
    step1 = once(widen(records), threshold=gap_threshold(segments, p), _items=inject_chapters(segments, F.col("chapters")))
    step2 = step1.withColumn("_texts", X.unescape_all(F.transform("_items", lambda e: e["text"])))
    cleaned = F.transform("_texts", lambda t: X.strip_fillers(X.one_line(t)))
    step3 = once(step2, _cleaned=cleaned)
    step4 = once(step3, blocks=F.filter(paragraph_blocks(F.col("_items"), F.col("_cleaned"), F.col("threshold"), p), lambda b: X.strip(b) != ""))
    prose = F.aggregate(F.filter("blocks", lambda b: ~F.startswith(b, F.lit("##"))), F.lit(0), lambda n, b: n + X.word_count(b))
    step5 = once(step4, prose_words=prose)
    body = F.when((F.size(segments) > 0) & (F.col("prose_words") >= p.min_words), F.array_join("blocks", "\n\n"))
    return step5.withColumn("cleaned", body).drop("_items", "_texts", "_cleaned")


def transcript_text(segments: Column) -> Column:
    """Decoded segment texts, blank ones dropped, joined by spaces."""
    lines = F.transform(X.unescape_all(F.transform(segments, lambda s: F.coalesce(s["text"], F.lit("")))), X.one_line)
    return F.array_join(F.filter(lines, lambda t: t != ""), " ")
