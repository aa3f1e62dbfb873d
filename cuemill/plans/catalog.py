"""All queries of the core engine over the driver tables, and the SQL that checks them.

Every query runs over its whole tables. A limit stands only where it is the feature (a queue's batch, a search page).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.operators import chunks, enrich, pasted, records, registry, render, requests, resilience, segments, transitions
from cuemill.operators import search as searching
from cuemill.params import DEFAULTS
from cuemill.plans import pipeline
from cuemill.runtime import cut, own_folder, table, weighted_lookup
from cuemill.sources import readers, sinks
from cuemill.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
HOSTS, SHORT_HOSTS, HOST = ("tube.example", "www.tube.example", "m.tube.example"), ("tu.example",), "tube.example"
STAMP = "2026-01-01 00:00:00"
_WHITE = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_N = lambda c: f"len(regexp_extract_all(coalesce({c}, ''), '[^{_WHITE}]+'))"
_STRIP = lambda c: f"regexp_replace({c}, '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g')"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add

# --- scalars over whole tables ---------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {_N('text')}::INT AS words FROM documents WHERE {_N('text')} >= 200")
def word_count_filter(spark, sf):
    words = X.word_count(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", words.alias("words")).where(F.col("words") >= DEFAULTS.min_words)


# a filler between two characters that are no part of a word; twice, as two fillers in a row share such a character
_FILLER = r"regexp_replace({0}, '(^|[^\p{L}\p{M}\p{N}_])(?:um+|uh+|hmm+|hm+|mhm|uh-huh|err+)(?:,|([^\p{L}\p{M}\p{N}_])|$)', '\1\2', 'gi')"
_UNFILLED = lambda c: _STRIP("regexp_replace(" + _FILLER.replace("{0}", _FILLER.replace("{0}", c)) + f", '[{_WHITE}]{{2,}}', ' ', 'g')")
_DECODE = "replace(replace(replace(replace(replace(replace({0}, '&#39;', ''''), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&')"
_ONE_LINE = lambda c: _STRIP(f"replace({c}, chr(10), ' ')")
_CLEAN = lambda c: _UNFILLED(_ONE_LINE(_DECODE.replace("{0}", f"coalesce({c}, '')")))
_TEXTS = "s AS (SELECT line_no, unnest(range(len(transcript_segments)))::INT AS pos, unnest(list_transform(transcript_segments, lambda s: s.text)) AS t FROM dataset)"


@query(f"""WITH {_TEXTS} SELECT line_no, pos, {_UNFILLED(_ONE_LINE("coalesce(t, '')"))} AS text FROM s""")
def filler_strip(spark, sf):
    """Every segment's text on one line, without fillers."""
    d = table(spark, sf, "dataset").select("line_no", F.posexplode("transcript_segments").alias("pos", "s"))
    return d.select("line_no", "pos", X.strip_fillers(X.one_line(F.coalesce("s.text", F.lit("")))).alias("text"))


@query(f"WITH {_TEXTS} SELECT line_no, pos, {_CLEAN('t')} AS text FROM s")
def clean_texts(spark, sf):
    """Every segment's text decoded, on one line, without fillers."""
    d = table(spark, sf, "dataset").withColumn("t", X.unescape_all(F.transform("transcript_segments", lambda s: F.coalesce(s["text"], F.lit("")))))
    return d.select("line_no", F.posexplode(F.transform("t", lambda t: X.strip_fillers(X.one_line(t)))).alias("pos", "text"))


@query(rf"""
WITH s AS (SELECT line_no, unnest(range(len(transcript_segments))) AS pos, unnest(list_transform(transcript_segments, lambda s: s.text)) AS t FROM dataset),
  c AS (SELECT line_no, pos, {_STRIP(f"replace({_DECODE.replace('{0}', "coalesce(t, '')")}, chr(10), ' ')")} AS t FROM s),
  x AS (SELECT line_no, coalesce(string_agg(t, ' ' ORDER BY pos) FILTER (WHERE t <> ''), '') AS text FROM c GROUP BY line_no)
SELECT line_no, text, {_N('text')}::INT AS words FROM x""")
def transcript_text(spark, sf):
    d = table(spark, sf, "dataset").select("line_no", segments.transcript_text(F.col("transcript_segments")).alias("text"))
    return d.select("line_no", "text", X.word_count(F.col("text")).alias("words"))


@query(f"""SELECT line_no, {_N('transcript_text')}::INT AS words, word_count AS stated, word_count IS DISTINCT FROM {_N('transcript_text')} AS stale FROM dataset""")
def word_count_audit(spark, sf):
    """Counted words against the stated ones."""
    n = X.word_count(F.col("transcript_text"))
    return table(spark, sf, "dataset").select("line_no", n.alias("words"), F.col("word_count").alias("stated"), (~F.col("word_count").eqNullSafe(n)).alias("stale"))


_STAMP = lambda c: f"""CASE WHEN trunc({c})::BIGINT // 3600 <> 0 THEN printf('[%02d:%02d:%02d]', trunc({c})::BIGINT // 3600, trunc({c})::BIGINT % 3600 // 60, trunc({c})::BIGINT % 60)
  ELSE printf('[%02d:%02d]', trunc({c})::BIGINT // 60, trunc({c})::BIGINT % 60) END"""  # noqa: E731


@query(f"SELECT id, CASE WHEN start_ts IS NOT NULL THEN {_STAMP('start_ts')} END AS stamp, CASE WHEN start_ts IS NOT NULL THEN {_STAMP('(start_ts * 24.0)')} END AS day_stamp FROM sections")
def format_timestamp(spark, sf):
    """Stamps of section starts, and of the same starts in a recording 24 times as long, which reach hours."""
    t = F.col("start_ts")
    return table(spark, sf, "sections").select("id", F.when(t.isNotNull(), X.format_timestamp(t)).alias("stamp"), F.when(t.isNotNull(), X.format_timestamp(t * 24.0)).alias("day_stamp"))


@query(r"""
WITH l AS (SELECT id, unnest(regexp_extract_all(description, '(?m)^(?:\d{1,3}:)?\d{1,2}:\d{2}')) AS stamp FROM videos)
SELECT id, stamp, (CASE len(string_split(stamp, ':')) WHEN 3 THEN string_split(stamp, ':')[1]::DOUBLE * 3600 ELSE 0 END
  + string_split(stamp, ':')[-2]::DOUBLE * 60 + string_split(stamp, ':')[-1]::DOUBLE) AS seconds FROM l""")
def timestamp_parse(spark, sf):
    found = table(spark, sf, "videos").select("id", F.explode(F.regexp_extract_all("description", F.lit(r"(?m)^(?:\d{1,3}:)?\d{1,2}:\d{2}"), 0)).alias("stamp"))
    return found.select("id", "stamp", X.to_seconds(F.col("stamp")).alias("seconds"))


_CTRL = r"""regexp_replace({0}, '[<>:"/\\\\|?*\x00-\x1f]', '', 'g')"""
_SAFE = "substr(regexp_replace({0}, '[{1}]+', '_', 'g'), 1, 100)".replace("{1}", _WHITE)
_SAN = lambda c: f"(CASE WHEN {_SAFE.replace('{0}', _STRIP(_CTRL.replace('{0}', c)))} IN ('', '.', '..') THEN 'untitled' ELSE {_SAFE.replace('{0}', _STRIP(_CTRL.replace('{0}', c)))} END)"


@query(f"""WITH v AS (SELECT id, CASE WHEN coalesce(channel, '') = '' THEN 'unknown_channel' ELSE channel END AS channel, CASE WHEN coalesce(title, '') = '' THEN 'untitled' ELSE title END AS title FROM videos
  UNION ALL SELECT -id, 'unknown_channel', CASE WHEN coalesce(trim(notes), '') = '' THEN '..' ELSE notes END FROM videos)
SELECT id, {_SAN('channel')} || '/' || {_SAN('title')} || '.md' AS path FROM v""")
def sanitize_path(spark, sf):
    """Paths of all videos; and of their notes without a channel, where a missing note has the title ".."."""
    v = table(spark, sf, "videos")
    notes = F.when(F.coalesce(F.trim("notes"), F.lit("")) == "", F.lit("..")).otherwise(F.col("notes"))
    other = v.select((-F.col("id")).alias("id"), records.output_path(F.lit(None).cast("string"), notes).alias("path"))
    return v.select("id", records.output_path(F.col("channel"), F.col("title")).alias("path")).unionByName(other)


_ESC = lambda c: rf"""replace(replace({c}, '\', '\\'), '"', '\"')"""


@query(rf"""SELECT id, CASE WHEN len(list_filter(coalesce(key_concepts, []), lambda x: x IS NOT NULL)) = 0 THEN '[]'
  ELSE '["' || array_to_string(list_transform(list_filter(key_concepts, lambda x: x IS NOT NULL), lambda x: {_ESC('x')}), '", "') || '"]' END AS concepts FROM videos""")
def flow_list(spark, sf):
    return table(spark, sf, "videos").select("id", X.flow_list(F.col("key_concepts")).alias("concepts"))


@query(f"""SELECT doc_id, CASE WHEN {_N('text')} <= 100 THEN text ELSE array_to_string(regexp_extract_all(text, '[^{_WHITE}]+')[1:100], ' ') END AS text,
  (trunc({_N('text')}::DOUBLE * 1.6::DOUBLE * 1.4::DOUBLE)::BIGINT + 128) AS ceiling FROM documents WHERE text IS NOT NULL""")
def cap_words(spark, sf):
    """Texts cut to their first hundred words, and the token ceiling of a rewrite of the whole."""
    d = table(spark, sf, "documents").where("text IS NOT NULL")
    return d.select("doc_id", X.cap_words(F.col("text"), 100).alias("text"), X.output_ceiling(X.word_count(F.col("text"))).alias("ceiling"))


@query(r"""SELECT line_no, CASE WHEN regexp_matches(url, '^https://(www\.|m\.)?tube\.example/watch\?(.*&)?v=[A-Za-z0-9_-]{11}(&.*)?$') THEN regexp_extract(url, '[?&]v=([A-Za-z0-9_-]{11})', 1)
  WHEN regexp_matches(url, '^https://tu\.example/[A-Za-z0-9_-]{11}([?/].*)?$') THEN regexp_extract(url, 'tu\.example/([A-Za-z0-9_-]{11})', 1)
  WHEN regexp_matches(url, '^https://(www\.|m\.)?tube\.example/(shorts|embed|live)/[A-Za-z0-9_-]{11}/?([?].*)?$') THEN regexp_extract(url, '/([A-Za-z0-9_-]{11})', 1) END AS found FROM dataset""")
def url_video_id(spark, sf):
    return table(spark, sf, "dataset").select("line_no", X.video_id_of(F.col("url"), HOSTS, SHORT_HOSTS).alias("found"))


@query(r"""SELECT doc_id, nullif(regexp_extract(text, 'url:\s+"https://tube\.example/watch\?v=([^"]+)"', 1), '') AS found FROM documents""")
def document_identity(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.document_video_id(F.col("text"), HOST).alias("found"))


@query(r"""SELECT line_no, published, regexp_matches(published, '^\d{4}-\d{2}-\d{2}$') AND try_cast(published AS DATE) IS NOT NULL AS valid,
  replace(coalesce(published, ''), '-', '') AS compact, CASE WHEN len(replace(published, '-', '')) = 8 THEN substr(replace(published, '-', ''), 1, 4) || '-' || substr(replace(published, '-', ''), 5, 2) || '-' || substr(replace(published, '-', ''), 7, 2) ELSE coalesce(replace(published, '-', ''), '') END AS restored FROM dataset""")
def published_dates(spark, sf):
    compact = F.replace(F.col("published"), F.lit("-"), F.lit(""))
    return table(spark, sf, "dataset").select("line_no", "published", X.is_date(F.col("published")).alias("valid"), F.coalesce(compact, F.lit("")).alias("compact"), X.upload_date(compact).alias("restored"))


# --- ordered operators -----------------------------------------------------------------------------------------------

_SEGS = """s0 AS (SELECT line_no, unnest(range(len(transcript_segments))) AS pos, unnest(transcript_segments) AS x FROM dataset),
  s AS (SELECT line_no, pos, x.text AS text, x.start AS start, x.duration AS duration FROM s0),
  g AS (SELECT line_no, pos, text, start, duration, start - lag(start + coalesce(duration, 0)) OVER (PARTITION BY line_no ORDER BY pos) AS gap FROM s)"""
_THRESHOLD = f"""{_SEGS},
  p AS (SELECT line_no, gap, row_number() OVER (PARTITION BY line_no ORDER BY gap) AS rn, count(*) OVER (PARTITION BY line_no) AS m FROM g WHERE gap > 0),
  k AS (SELECT line_no, gap FROM p WHERE rn = floor(m * 0.8::DOUBLE) + 1),
  n AS (SELECT line_no, count(*) AS n FROM s GROUP BY line_no),
  th AS (SELECT n.line_no, CASE WHEN n < 10 OR gap IS NULL THEN 2.0::DOUBLE ELSE greatest(1.0::DOUBLE, least(8.0::DOUBLE, gap)) END AS threshold FROM n LEFT JOIN k USING (line_no))"""


@query(f"WITH {_SEGS} SELECT line_no, pos::INT AS pos, gap FROM g WHERE gap IS NOT NULL")
def segment_gaps(spark, sf):
    d = table(spark, sf, "dataset").select("line_no", F.posexplode(segments.gaps(F.col("transcript_segments"))).alias("k", "gap"))
    return d.select("line_no", (F.col("k") + 1).alias("pos"), "gap")


@query(f"WITH {_THRESHOLD} SELECT line_no, threshold FROM th")
def gap_threshold(spark, sf):
    return table(spark, sf, "dataset").select("line_no", segments.gap_threshold(F.col("transcript_segments")).alias("threshold"))


@query(f"WITH {_THRESHOLD} SELECT line_no, n.n, threshold FROM th JOIN n USING (line_no)")
def gap_threshold_rows(spark, sf):
    """The same rule over exploded rows, as windows."""
    return segments.gap_rows(segments.long_form(table(spark, sf, "dataset"), "line_no"), "line_no", "pos", "start", "duration")


_MARKS = f"""c0 AS (SELECT line_no, unnest(range(len(chapters))) AS i, unnest(chapters) AS x FROM dataset), c AS (SELECT line_no, i, x.title AS title, x.start_time AS start_time FROM c0),
  m AS (SELECT line_no, row_number() OVER (PARTITION BY line_no ORDER BY start_time, i) - 1 AS marker, title, start_time FROM c WHERE coalesce(title, '') <> '' AND start_time IS NOT NULL)"""


@query(f"""WITH {_SEGS}, {_MARKS}, n AS (SELECT line_no, count(*) AS n FROM s GROUP BY line_no)
SELECT m.line_no, marker::INT AS marker, coalesce(min(pos), any_value(n))::INT AS "at" FROM m JOIN n USING (line_no) LEFT JOIN s ON s.line_no = m.line_no AND s.start >= m.start_time GROUP BY m.line_no, marker""")
def chapter_positions(spark, sf):
    d = table(spark, sf, "dataset")
    marks = d.select("line_no", F.posexplode(segments.markers(F.col("chapters"))).alias("marker", "m")).select("line_no", "marker", F.col("m.start").alias("start_time"))
    return segments.chapter_positions(segments.long_form(d, "line_no"), marks, "line_no")


@query(rf"""WITH {_SEGS}, {_MARKS}, n AS (SELECT line_no, count(*) AS n FROM s GROUP BY line_no),
  a AS (SELECT m.line_no, marker, any_value(title) AS title, any_value(start_time) AS start, coalesce(min(pos), any_value(n)) AS place FROM m JOIN n USING (line_no) LEFT JOIN s ON s.line_no = m.line_no AND s.start >= m.start_time GROUP BY m.line_no, marker),
  u AS (SELECT line_no, place, 0 AS kind, marker AS k, '## ' || {_STRIP('title')} AS text, start, true AS is_heading FROM a
        UNION ALL SELECT line_no, pos, 1, 0, text, start, false FROM s)
SELECT line_no, (row_number() OVER (PARTITION BY line_no ORDER BY place, kind, k) - 1)::INT AS pos, text, start, is_heading FROM u""")
def chapter_injection(spark, sf):
    d = table(spark, sf, "dataset").select("line_no", F.posexplode(segments.inject_chapters(F.col("transcript_segments"), F.col("chapters"))).alias("pos", "e"))
    return d.select("line_no", "pos", F.col("e.text").alias("text"), F.col("e.start").alias("start"), F.col("e.is_heading").alias("is_heading"))


_FOLD = rf"""{_THRESHOLD}, {_MARKS},
  a AS (SELECT m.line_no, marker, any_value(title) AS title, any_value(start_time) AS start, coalesce(min(pos), any_value(n)) AS place FROM m JOIN n USING (line_no) LEFT JOIN s ON s.line_no = m.line_no AND s.start >= m.start_time GROUP BY m.line_no, marker),
  u AS (SELECT line_no, place, 0 AS kind, marker AS k, '## ' || {_STRIP('title')} AS text, start, 0.0::DOUBLE AS duration, true AS is_heading FROM a
        UNION ALL SELECT line_no, pos, 1, 0, text, start, coalesce(duration, 0.0), false FROM s),
  i AS MATERIALIZED (SELECT line_no, row_number() OVER (PARTITION BY line_no ORDER BY place, kind, k) AS i, text AS raw, {_CLEAN('text')} AS t, start, duration, is_heading FROM u),
  x AS MATERIALIZED (SELECT i.*, threshold, {_N('t')} AS n, regexp_matches(t, '[.!?][''"]?\s*$') AS stops,
    {_N('t')} BETWEEN 1 AND 7 AND NOT regexp_matches(t, '[.!?,;:]$') AND regexp_matches(t, '^\p{{Lu}}') AS titlelike FROM i JOIN th USING (line_no)),
  f AS (SELECT line_no, i, CASE WHEN is_heading THEN 1 WHEN t = '' THEN 0 ELSE 3 END AS kind, CASE WHEN is_heading OR t <> '' THEN 1 ELSE 0 END AS blk,
      NOT is_heading AND t <> '' AS open, CASE WHEN is_heading THEN 0 ELSE n END AS words, CASE WHEN is_heading OR t = '' THEN false ELSE stops END AS ends, start + duration AS till FROM x WHERE i = 1
    UNION ALL SELECT line_no, i, kind, CASE WHEN kind = 0 THEN blk WHEN kind = 4 AND open THEN blk ELSE blk + 1 END,
      CASE WHEN kind = 0 THEN open ELSE kind > 2 END, CASE kind WHEN 0 THEN words WHEN 3 THEN n WHEN 4 THEN words + n ELSE 0 END, CASE WHEN kind = 0 THEN ends WHEN kind > 2 THEN stops ELSE false END, till
    FROM (SELECT x.line_no, x.i, CASE WHEN x.is_heading THEN 1 WHEN x.t = '' THEN 0 WHEN x.titlelike AND x.start - f.till >= x.threshold * 2.0::DOUBLE THEN 2
        WHEN f.words >= 60 AND (x.start - f.till >= x.threshold OR f.ends) THEN 3 ELSE 4 END AS kind, f.blk, f.open, f.words, f.ends, x.n, x.stops, x.start + x.duration AS till
      FROM f JOIN x ON x.line_no = f.line_no AND x.i = f.i + 1)),
  w AS (SELECT f.line_no, blk, string_agg(CASE kind WHEN 1 THEN raw WHEN 2 THEN '## ' || t ELSE t END, ' ' ORDER BY f.i) AS text FROM f JOIN x ON x.line_no = f.line_no AND x.i = f.i WHERE kind > 0 GROUP BY f.line_no, blk),
  bl AS (SELECT line_no, (row_number() OVER (PARTITION BY line_no ORDER BY blk) - 1)::INT AS block, text FROM w WHERE {_STRIP('text')} <> '')"""


@query(rf"""WITH RECURSIVE {_FOLD}, gb AS (SELECT line_no, count(*) AS n_blocks, coalesce(sum({_N('text')}) FILTER (WHERE NOT starts_with(text, '##')), 0) AS words, string_agg(text, chr(10) || chr(10) ORDER BY block) AS body FROM bl GROUP BY line_no)
SELECT d.line_no, d.video_id, coalesce(threshold, 2.0::DOUBLE) AS threshold, coalesce(n_blocks, 0)::INT AS n_blocks, coalesce(words, 0)::INT AS prose_words, CASE WHEN words >= 200 THEN body END AS cleaned FROM dataset d LEFT JOIN th USING (line_no) LEFT JOIN gb USING (line_no)""")
def clean_transcripts(spark, sf):
    """The whole cleaning fold: threshold, blocks, words and body of every line."""
    return segments.clean(table(spark, sf, "dataset")).select("line_no", "video_id", "threshold", F.size("blocks").alias("n_blocks"), "prose_words", "cleaned")


@query(f"WITH RECURSIVE {_FOLD} SELECT line_no, block, text FROM bl")
def paragraph_blocks(spark, sf):
    return segments.clean(table(spark, sf, "dataset")).select("line_no", F.posexplode("blocks").alias("block", "text"))


@query(rf"""WITH RECURSIVE {_FOLD}, h AS (SELECT line_no, count(*) FILTER (WHERE kind = 1) AS chapters, count(*) FILTER (WHERE kind = 2) AS titles FROM f GROUP BY line_no)
SELECT line_no, chapters, titles FROM h""")
def detected_headings(spark, sf):
    """Headings of each line: those of its chapters, and those that the fold detected by their look and the pause before."""
    d = segments.clean(table(spark, sf, "dataset"))
    chapters = F.size(segments.markers(F.col("chapters")))
    return d.where(F.size("transcript_segments") > 0).select("line_no", chapters.cast("long").alias("chapters"), (F.size(F.filter("blocks", lambda b: F.startswith(b, F.lit("## ")))) - chapters).cast("long").alias("titles"))


_BLOCKS = rf"""b AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_STRIP('x')}), lambda x: x <> '')) AS t,
    unnest(generate_series(1, len(list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_STRIP('x')}), lambda x: x <> '')))) AS idx FROM documents),
  k AS (SELECT doc_id, idx, starts_with(t, '#') AS head, CASE WHEN starts_with(t, '#') THEN {_STRIP("regexp_replace(t, '^#+', '')")} ELSE t END AS t FROM b)"""


@query(f"WITH {_BLOCKS} SELECT doc_id, (idx - 1)::INT AS idx, CASE WHEN head THEN 'heading' ELSE 'para' END AS kind, t AS text FROM k")
def split_blocks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(chunks.split_blocks(F.col("text"))).alias("idx", "b"))
    return d.select("doc_id", "idx", "b.kind", "b.text")


@query(f"""WITH RECURSIVE {_BLOCKS}, w AS (SELECT *, {_N('t')} AS n FROM k),
  f AS (SELECT doc_id, idx, t, head, CASE WHEN head THEN t END AS heading, CASE WHEN head THEN 0 ELSE n END AS words, 0 AS chunk, CASE WHEN head THEN false ELSE n >= 100 END AS full_now, n FROM w WHERE idx = 1
   UNION ALL SELECT w.doc_id, w.idx, w.t, w.head, CASE WHEN w.head THEN w.t ELSE f.heading END, CASE WHEN w.head THEN 0 WHEN f.full_now THEN w.n ELSE f.words + w.n END,
     f.chunk + CASE WHEN f.full_now OR (w.head AND NOT f.head AND NOT f.full_now) THEN 1 ELSE 0 END,
     CASE WHEN w.head THEN false WHEN f.full_now THEN w.n >= 100 ELSE f.words + w.n >= 100 END, w.n FROM f JOIN w ON w.doc_id = f.doc_id AND w.idx = f.idx + 1),
  c AS (SELECT doc_id, chunk, any_value(heading) AS heading, string_agg(t, chr(10) || chr(10) ORDER BY idx) AS text, sum(n) AS words FROM f WHERE NOT head GROUP BY doc_id, chunk)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY chunk) - 1)::INT AS chunk_idx, heading, text, words::INT AS words FROM c""")
def chunk_blocks(spark, sf):
    """Documents in chunks of about a hundred words."""
    return chunks.chunk_rows(table(spark, sf, "documents"), "doc_id", "text", 100)


@query("""WITH l AS (SELECT video_id, idx, nullif(heading, '') AS heading, summary, last_value(nullif(heading, '') IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM
  (SELECT video_id, idx, heading, summary FROM sections UNION ALL SELECT video_id, idx + 1000, CASE WHEN idx % 3 = 0 THEN heading END, summary FROM sections))
SELECT video_id, string_agg(CASE WHEN heading IS NOT NULL AND heading IS DISTINCT FROM before THEN '## ' || heading || chr(10) || chr(10) ELSE '' END || coalesce(summary, ''), chr(10) || chr(10) ORDER BY idx) AS article FROM l GROUP BY video_id""")
def heading_dedupe(spark, sf):
    """Section texts in order, a heading once per run of equal headings; each video's sections come again, most of them without heading."""
    s = table(spark, sf, "sections").select("video_id", F.col("idx").alias("chunk_idx"), "heading", F.coalesce("summary", F.lit("")).alias("summary"))
    again = s.select("video_id", (F.col("chunk_idx") + 1000).alias("chunk_idx"), F.when(F.col("chunk_idx") % 3 == 0, F.col("heading")).alias("heading"), "summary")
    return chunks.assemble(s.unionByName(again), "video_id", text="summary")


_CONTENT = "list_distinct(list_filter(regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9][a-z0-9''\\-]*'), lambda w: len(w) > 3 AND NOT list_contains([{1}], w)))".replace("{1}", ", ".join(f"'{w}'" for w in sorted(set(X.STOPWORDS))))


_PAIRS = """q AS (SELECT id, 'summary' AS kind, coalesce(description, '') AS a, coalesce(summary, '') AS b FROM videos UNION ALL SELECT id, 'same', coalesce(description, ''), coalesce(description, '') FROM videos
    UNION ALL SELECT id, 'longer', coalesce(title, ''), coalesce(title, '') || ' ' || coalesce(title, '') FROM videos UNION ALL SELECT id, 'notes', coalesce(title, ''), coalesce(title, '') || ' ' || coalesce(notes, '') FROM videos)"""
_GUARD = rf"""{_PAIRS}, t AS (SELECT id, kind, a, b, {_CONTENT.replace('{0}', 'a')} AS x, {_CONTENT.replace('{0}', 'b')} AS y FROM q),
  r AS (SELECT id, kind, a, b, CASE WHEN {_N('a')} > 0 THEN {_N('b')} / {_N('a')} ELSE 0.0 END AS ratio, CASE WHEN len(x) = 0 THEN 1.0 ELSE len(list_intersect(x, y)) / len(x) END AS retention FROM t),
  j AS (SELECT id, kind, a, b, ratio, retention, CASE WHEN {_STRIP('b')} = '' THEN 'empty output' WHEN ratio < 0.55 THEN printf('too short (ratio %.2f < 0.55)', ratio)
  WHEN ratio > 1.6 THEN printf('too long (ratio %.2f > 1.6)', ratio) WHEN retention < 0.72 THEN printf('dropped content (retention %.2f < 0.72)', retention) END AS failure FROM r)"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(id, kind, a, b): summaries against descriptions, texts against themselves, against themselves twice, and against more."""
    t = lambda c: F.coalesce(F.col(c), F.lit(""))
    v = table(spark, sf, "videos")
    kinds = {"summary": (t("description"), t("summary")), "same": (t("description"), t("description")), "longer": (t("title"), F.concat_ws(" ", t("title"), t("title"))), "notes": (t("title"), F.concat_ws(" ", t("title"), t("notes")))}
    return v.select("id", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("a"), b.alias("b")) for k, (a, b) in kinds.items()])))


@query(f"WITH {_GUARD} SELECT id, kind, ratio, retention, failure FROM j")
def coverage_pairs(spark, sf):
    """Texts judged as rewrites of others: accepted, empty, too short, too long, and with dropped content."""
    ratio, retention = chunks.coverage(F.col("a"), F.col("b"))
    r = _pairs(spark, sf).select("id", "kind", "b", ratio.alias("ratio"), retention.alias("retention"))
    return r.select("id", "kind", "ratio", "retention", chunks.coverage_failure(F.col("b"), F.col("ratio"), F.col("retention")).alias("failure"))


@query(f"""WITH {_GUARD}, k AS (SELECT id, min(a) FILTER (WHERE kind = 'notes') AS source, min(b) FILTER (WHERE kind = 'longer') AS first, bool_and(failure IS NULL) FILTER (WHERE kind = 'longer') AS ok1,
  min(b) FILTER (WHERE kind = 'notes') AS second, bool_and(failure IS NULL) FILTER (WHERE kind = 'notes') AS ok2 FROM j GROUP BY id), v AS (SELECT id, notes IS NULL AS none FROM videos)
SELECT id, CASE WHEN ok1 THEN first WHEN NOT none AND ok2 THEN second ELSE source END AS text FROM k JOIN v USING (id)""")
def accepted_rewrites(spark, sf):
    """The first of two attempts at a title that passes the guard, else the title itself; a missing second attempt ends the tries."""
    t = lambda c: F.coalesce(F.col(c), F.lit(""))
    second = F.when(F.col("notes").isNotNull(), F.concat_ws(" ", t("title"), F.col("notes")))
    return table(spark, sf, "videos").select("id", chunks.accepted(t("title"), F.concat_ws(" ", t("title"), t("title")), second).alias("text"))


@query(f"SELECT doc_id, len({_CONTENT.replace('{0}', 'text')})::INT AS terms FROM documents")
def content_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.size(X.content_words(F.coalesce("text", F.lit("")))), F.lit(0)).alias("terms"))


@query(f"""WITH c AS (SELECT video_id, {_N('description')} AS a, {_N('summary')} AS b, coalesce(enrichment_status = 'failed', false) AS fell FROM videos)
SELECT video_id, count(*) AS chunks, count(*) FILTER (WHERE fell) AS fallbacks, sum(a)::BIGINT AS words_in, sum(b)::BIGINT AS words_out, CASE WHEN sum(a) > 0 THEN sum(b) / sum(a) ELSE 0.0 END AS ratio FROM c GROUP BY video_id""")
def rewrite_totals(spark, sf):
    v = table(spark, sf, "videos").select("video_id", F.col("description").alias("source"), F.col("summary").alias("output"), F.coalesce(F.col("enrichment_status") == "failed", F.lit(False)).alias("fallback"))
    return chunks.rewrite_totals(v, "video_id")


# --- pasted transcripts ----------------------------------------------------------------------------------------------

_BODY = lambda c: f"""coalesce(array_to_string(list_filter(string_split(regexp_replace({c}, '\\r\\n|\\r', chr(10), 'g'), chr(10)), lambda x: upper({_STRIP('x')}) <> 'WEBVTT'), chr(10)), '')"""
_CLOCK = r"(?:\d{1,3}:)?\d{1,2}:\d{2}(?:[.,]\d{1,3})?"
_SECONDS = lambda c: f"list_reduce(list_transform(string_split(replace({c}, ',', '.'), ':'), lambda x: x::DOUBLE), lambda a, x: a * 60 + x)"


def _pasted(source: str) -> str:
    """CTEs over ``source`` (key, text): lines with their shapes, and each text's style."""
    return rf"""b AS (SELECT key, {_BODY('text')} AS body FROM ({source})),
  l AS (SELECT key, unnest(string_split(body, chr(10))) AS line, unnest(range(len(string_split(body, chr(10))))) AS pos FROM b),
  k AS (SELECT *, regexp_matches(line, '^\s*{_CLOCK}\s*-->\s*{_CLOCK}') AS is_cue, regexp_matches(line, '^\s*\[?\(?{_CLOCK}') AS is_stamp, {_STRIP('line')} = '' AS blank FROM l),
  st AS (SELECT key, CASE WHEN bool_or(is_cue) THEN 'cues' WHEN bool_or(is_stamp) THEN 'stamped' WHEN bool_or(NOT blank) THEN 'prose' ELSE 'empty' END AS style FROM k GROUP BY key)"""


def _stamped(style: str) -> str:
    return rf"""sr AS (SELECT k.key, pos, line, is_stamp, sum(is_stamp::INT) OVER (PARTITION BY k.key ORDER BY pos) AS grp FROM k {style} WHERE NOT blank),
  sp AS (SELECT key, grp, pos, is_stamp, {_STRIP(rf"CASE WHEN is_stamp THEN regexp_replace(line, '^\s*\[?\(?{_CLOCK}\)?\]?\s*', '') ELSE line END")} AS part, regexp_extract(line, '({_CLOCK})', 1) AS stamp FROM sr WHERE grp > 0),
  sh AS (SELECT key, grp, {_SECONDS('stamp')} AS start FROM sp WHERE is_stamp),
  sx AS (SELECT key, grp, string_agg(part, ' ' ORDER BY pos) AS text FROM sp WHERE part <> '' GROUP BY key, grp),
  sj AS (SELECT sx.key, sx.grp, text, start, lead(start) OVER (PARTITION BY sx.key ORDER BY sx.grp) AS nxt FROM sx JOIN sh ON sh.key = sx.key AND sh.grp = sx.grp),
  sd AS (SELECT key, grp::INT AS "at", round(start, 3) AS start, CASE WHEN nxt IS NOT NULL THEN round(greatest(0.1::DOUBLE, nxt - start), 3) ELSE 3.0::DOUBLE END AS duration, text FROM sj)"""


def _cued(style: str) -> str:
    return rf"""cr AS (SELECT k.key, pos, line, is_cue, blank, sum(is_cue::INT) OVER (PARTITION BY k.key ORDER BY pos) AS grp FROM k {style}),
  cs AS (SELECT *, sum(blank::INT) OVER (PARTITION BY key, grp ORDER BY pos) AS shut FROM cr WHERE grp > 0),
  ch AS (SELECT key, grp, {_SECONDS(f"regexp_extract(line, '^[ ]*({_CLOCK})', 1)")} AS start, {_SECONDS(f"regexp_extract(line, '-->[ ]*({_CLOCK})', 1)")} AS till FROM cs WHERE is_cue),
  cx AS (SELECT key, grp, string_agg({_STRIP('line')}, ' ' ORDER BY pos) AS text FROM cs WHERE shut = 0 AND NOT is_cue GROUP BY key, grp),
  cj AS (SELECT cx.key, cx.grp, text, start, till, lead(start) OVER (PARTITION BY cx.key ORDER BY cx.grp) AS nxt FROM cx JOIN ch ON ch.key = cx.key AND ch.grp = cx.grp),
  cd AS (SELECT key, grp::INT AS "at", round(start, 3) AS start, round(CASE WHEN till > start THEN till - start WHEN nxt IS NOT NULL THEN greatest(0.1::DOUBLE, nxt - start) ELSE 3.0::DOUBLE END, 3) AS duration, text FROM cj)"""


def _spoken(style: str) -> str:
    return rf"""pp AS (SELECT key, unnest(ps) AS p, unnest(range(len(ps))) AS para FROM (SELECT b.key, list_filter(regexp_split_to_array(body, '\n[ \t\n\x0B\f\r]*\n'), lambda x: {_STRIP('x')} <> '') AS ps FROM b {style})),
  pf AS (SELECT key, para, list_filter(string_split(regexp_replace(array_to_string(regexp_extract_all(p, '[^{_WHITE}]+'), ' '), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ss FROM pp),
  pe AS (SELECT key, para, unnest(ss) AS sentence, unnest(range(len(ss))) AS i FROM pf),
  pw AS MATERIALIZED (SELECT key, para, i, string_split(sentence, ' ') AS ws, len(string_split(sentence, ' ')) AS n FROM pe),
  pr AS (SELECT key, para, i, ws, n, 0 AS base, CASE WHEN n > 22 THEN (n + 21) // 22 WHEN n = 22 THEN 1 ELSE 0 END AS nxt, CASE WHEN n >= 22 THEN 0 ELSE n END AS opened FROM pw WHERE i = 0
    UNION ALL SELECT pw.key, pw.para, pw.i, pw.ws, pw.n, CASE WHEN pw.n > 22 AND opened > 0 THEN nxt + 1 ELSE nxt END,
      CASE WHEN pw.n > 22 THEN nxt + (opened > 0)::INT + (pw.n + 21) // 22 WHEN opened + pw.n >= 22 THEN nxt + 1 ELSE nxt END, CASE WHEN pw.n > 22 OR opened + pw.n >= 22 THEN 0 ELSE opened + pw.n END
    FROM pr JOIN pw ON pw.key = pr.key AND pw.para = pr.para AND pw.i = pr.i + 1),
  pc AS (SELECT key, para, i, base + c AS chunk, CASE WHEN n > 22 THEN ws[c * 22 + 1 : c * 22 + 22] ELSE ws END AS ws FROM (SELECT *, unnest(range(CASE WHEN n > 22 THEN (n + 21) // 22 ELSE 1 END)) AS c FROM pr)),
  pt AS (SELECT key, para, chunk, string_agg(array_to_string(ws, ' '), ' ' ORDER BY i) AS text, greatest(1.0::DOUBLE, sum(len(ws)) / 2.5::DOUBLE) AS seconds FROM pc GROUP BY key, para, chunk),
  pd AS (SELECT key, (row_number() OVER w)::INT AS "at", round(coalesce(sum(seconds) OVER (PARTITION BY key ORDER BY para, chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) + para * 4.0::DOUBLE, 3) AS start,
    round(seconds, 3) AS duration, text FROM pt WINDOW w AS (PARTITION BY key ORDER BY para, chunk))"""


_DOCS = _pasted("SELECT doc_id AS key, text FROM documents")
_IN = lambda style: f"JOIN st ON st.key = {{0}}.key AND st.style = '{style}'"


@query(f"WITH {_DOCS} SELECT key, style FROM st")
def pasted_styles(spark, sf):
    return pasted.styles(table(spark, sf, "documents"), "doc_id", "text")


@query(f"""WITH {_DOCS}, {_stamped('')} SELECT key, "at", start, duration, text FROM sd""")
def pasted_stamped(spark, sf):
    """Documents read as stamped lines."""
    return pasted.stamped_segments(table(spark, sf, "documents"), "doc_id", "text")


_CUE_TEXT = _STRIP("regexp_replace(" + _ONE_LINE("coalesce(x.text, '')") + ", '\\r\\n|\\n|\\r', ' ', 'g')")


@query(f"""WITH s0 AS (SELECT line_no, unnest(range(len(transcript_segments))) AS pos, unnest(transcript_segments) AS x FROM dataset), s AS (SELECT line_no, pos, round(x.start * 1000) AS ms, {_CUE_TEXT} AS text FROM s0)
SELECT line_no AS key, (pos + 1)::INT AS "at", round(ms / 1000, 3) AS start, 1.5::DOUBLE AS duration, text FROM s WHERE text <> ''""")
def pasted_cues(spark, sf):
    """Segments of each record written as numbered cues of a second and a half, and read back; cues without text are dropped."""
    ms = lambda s: F.round(s["start"] * 1000).cast("long")
    stamp = lambda m: F.format_string("%02d:%02d:%02d,%03d", (m / 3_600_000).cast("long"), (m % 3_600_000 / 60_000).cast("long"), (m % 60_000 / 1000).cast("long"), m % 1000)
    cue = lambda s, i: F.concat_ws("\n", i + 1, F.concat(stamp(ms(s)), F.lit(" --> "), stamp(ms(s) + 1500)), X.line_event(X.one_line(F.coalesce(s["text"], F.lit("")))), F.lit(""))
    d = table(spark, sf, "dataset").select("line_no", F.array_join(F.transform("transcript_segments", cue), "\n").alias("text"))
    return pasted.cue_segments(d, "line_no", "text")


@query(f"""WITH RECURSIVE {_pasted('SELECT id AS key, description AS text FROM videos')}, {_spoken('')} SELECT key, "at", start, duration, text FROM pd""")
def pasted_prose(spark, sf):
    """Descriptions read as prose with a made-up clock."""
    return pasted.prose_segments(table(spark, sf, "videos"), "id", "description")


_PARSED = f"""{_DOCS}, {_stamped(_IN('stamped').format('k'))}, {_cued(_IN('cues').format('k'))}, {_spoken(_IN('prose').format('b'))},
  pa AS (SELECT key, 'stamped' AS style, "at", start, duration, text FROM sd UNION ALL SELECT key, 'cues', "at", start, duration, text FROM cd UNION ALL SELECT key, 'prose', "at", start, duration, text FROM pd)"""


@query(f"""WITH RECURSIVE {_PARSED} SELECT key, style, "at", start, duration, text FROM pa""")
def pasted_parse(spark, sf):
    """Every document in its own style."""
    return pasted.parse_pasted(table(spark, sf, "documents"), "doc_id", "text")


@query(f"""WITH RECURSIVE {_PARSED} SELECT key, count(*) AS segments, sum({_N('text')})::BIGINT AS words FROM pa GROUP BY key""")
def pasted_totals(spark, sf):
    """Segments and words of every parsed document."""
    return pasted.word_totals(pasted.parse_pasted(table(spark, sf, "documents"), "doc_id", "text"))


# --- records, joins --------------------------------------------------------------------------------------------------


@query("""SELECT video_id, arg_max(line_no, line_no) AS line_no, arg_max(title, line_no) AS title, min(line_no) AS first_at FROM dataset WHERE coalesce(video_id, '') <> '' GROUP BY video_id""")
def last_record(spark, sf):
    return records.last_wins(table(spark, sf, "dataset").select("video_id", "line_no", F.col("title")), "video_id", "line_no").select("video_id", "line_no", "title", "first_at")


@query("""SELECT video_id, min(line_no) AS line_no, arg_min(title, line_no) AS title FROM dataset WHERE coalesce(video_id, '') <> '' GROUP BY video_id""")
def first_record(spark, sf):
    return records.first_wins(table(spark, sf, "dataset").select("video_id", "line_no", "title"), "video_id", "line_no").select("video_id", "line_no", "title")


@query("SELECT line_no, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in ("video_id", "url", "title", "channel", "published", "description", "created_at")) + " FROM dataset")
def record_metadata(spark, sf):
    return records.metadata(table(spark, sf, "dataset"))


@query("SELECT line_no, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in ("video_id", "title", "channel", "published", "url")) + ", coalesce(word_count, 0) AS word_count FROM dataset")
def newest_first(spark, sf):
    return records.newest_first(table(spark, sf, "dataset"))


@query("""WITH i AS (SELECT video_id, max(line_no) AS line_no FROM dataset GROUP BY video_id)
SELECT v.video_id, line_no, CASE WHEN line_no IS NULL THEN 'failed' ELSE 'ready' END AS outcome FROM videos v LEFT JOIN i USING (video_id)
WHERE status IN ('cleaned', 'ingested') AND enrichment_status IN ('pending', 'failed')""")
def queue_lookup(spark, sf):
    """The whole enrichment queue with its records."""
    index = records.last_wins(table(spark, sf, "dataset").select("video_id", "line_no"), "video_id", "line_no").select("video_id", "line_no")
    return records.queue_lookup(registry.pending(table(spark, sf, "videos"), "enrichment_status").select("video_id"), index, "video_id")


@query("""SELECT video_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM videos WHERE status IN ('cleaned', 'ingested') AND rewrite_status IN ('pending', 'failed') ORDER BY videos.created_at NULLS LAST, video_id LIMIT 50""")
def fifo_queue(spark, sf):
    """A worker's batch of fifty, the oldest first."""
    return registry.pending(table(spark, sf, "videos"), "rewrite_status", 50).select("video_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query("SELECT line_no, video_id FROM dataset d WHERE NOT EXISTS (SELECT 1 FROM videos v WHERE v.video_id = d.video_id AND v.status IN ('ingested', 'embedded'))")
def unregistered_records(spark, sf):
    """Records whose video isn't among the ingested ones."""
    ingested = table(spark, sf, "videos").where(F.col("status").isin("ingested", "embedded"))
    return records.unseen(table(spark, sf, "dataset").select("line_no", "video_id"), ingested, "video_id")


@query("SELECT id, video_id FROM processing_runs r WHERE NOT EXISTS (SELECT 1 FROM dataset d WHERE d.video_id = r.video_id)")
def orphan_runs(spark, sf):
    """Runs of videos that no record was staged for."""
    return records.orphans(table(spark, sf, "processing_runs").select("id", "video_id"), table(spark, sf, "dataset"), "video_id")


@query("""WITH s AS (SELECT video_id, list(struct_pack(heading := heading, summary := summary) ORDER BY idx) AS s FROM sections GROUP BY video_id),
  c AS (SELECT video_id, arg_max(chapters, line_no) AS c FROM dataset GROUP BY video_id),
  j AS (SELECT video_id, s, c, len(s) = len(c) AND len(s) > 0 AS fits FROM s JOIN c USING (video_id))
SELECT video_id, unnest(generate_series(0, len(s) - 1))::INT AS idx, unnest(list_transform(s, lambda x: x.heading)) AS heading,
  unnest(list_transform(s, lambda x, i: CASE WHEN fits THEN c[i].start_time END)) AS start_ts, unnest(list_transform(s, lambda x, i: CASE WHEN fits THEN c[i].end_time END)) AS end_ts FROM j""")
def timed_sections(spark, sf):
    """Sections with the chapters' times, where there are as many of both."""
    s = table(spark, sf, "sections").groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "heading", "summary"))), lambda x: F.struct(x["heading"].alias("heading"), x["summary"].alias("summary"))).alias("s"))
    c = records.last_wins(table(spark, sf, "dataset").select("video_id", "line_no", "chapters"), "video_id", "line_no").select("video_id", "chapters")
    return records.timed_sections(s.join(c, "video_id"), "s", "chapters").select("video_id", F.explode("s").alias("x")).select("video_id", "x.idx", "x.heading", "x.start_ts", "x.end_ts")


@query("""WITH d AS (SELECT video_id, arg_max(title, line_no) AS title, arg_max(channel, line_no) AS channel, arg_max(description, line_no) AS description FROM dataset GROUP BY video_id)
SELECT v.video_id, coalesce(nullif(regexp_replace(v.title, '^\\s+|\\s+$', '', 'g'), ''), nullif(d.title, ''), v.video_id) AS title,
  coalesce(nullif(regexp_replace(v.channel, '^\\s+|\\s+$', '', 'g'), ''), nullif(d.channel, ''), 'unknown_channel') AS channel FROM videos v LEFT JOIN d USING (video_id)""".replace("\\\\", "\\"))
def merged_metadata(spark, sf):
    """Registry values before staged ones before defaults."""
    v = table(spark, sf, "videos").select("video_id", "title", "channel", F.col("published_date").cast("string").alias("published"), "description")
    staged = records.last_wins(table(spark, sf, "dataset").select("video_id", "line_no", "title", "channel", "published", "description"), "video_id", "line_no")
    return records.merged_metadata(v, staged, "video_id").select("video_id", "title", "channel")


# --- registry --------------------------------------------------------------------------------------------------------

_INCOMING = """i AS (SELECT video_id, arg_max(title, line_no) AS title, arg_max(description, line_no) AS description, arg_max(word_count, line_no) AS word_count, arg_max(md_path, line_no) AS raw_path,
  arg_max(url, line_no) AS url, arg_max(channel, line_no) AS channel FROM dataset GROUP BY video_id)"""


@query(f"""WITH {_INCOMING} SELECT coalesce(v.video_id, i.video_id) AS video_id, CASE WHEN i.video_id IS NULL THEN v.title ELSE i.title END AS title,
  CASE WHEN i.video_id IS NULL THEN v.word_count ELSE i.word_count END AS word_count, CASE WHEN i.video_id IS NULL THEN v.status ELSE 'raw' END AS status,
  CASE WHEN v.video_id IS NULL THEN i.raw_path ELSE coalesce(v.raw_path, i.raw_path) END AS raw_path, CASE WHEN v.video_id IS NULL THEN 'en' ELSE v.language END AS language,
  CASE WHEN v.video_id IS NULL THEN i.channel ELSE v.channel END AS channel FROM videos v FULL JOIN i ON i.video_id = v.video_id""")
def upsert_merge(spark, sf):
    """The staged records merged into the registry; a repeated upsert moves a row back to raw."""
    d = table(spark, sf, "dataset").select("video_id", "line_no", "title", "description", "word_count", "url", "channel", "channel_id", "published", F.col("md_path").alias("raw_path"))
    incoming = records.last_wins(d, "video_id", "line_no").drop("line_no", "first_at").withColumn("status", F.lit("raw"))
    return registry.upsert_videos(table(spark, sf, "videos"), incoming, F.lit(STAMP).cast("timestamp")).select("video_id", "title", "word_count", "status", "raw_path", "language", "channel")


@query(f"""WITH {_INCOMING}, c AS (SELECT v.video_id, v.title AS t0, i.title AS t1, v.word_count AS w0, i.word_count AS w1 FROM videos v JOIN i USING (video_id))
SELECT video_id, 'title' AS field_name, t0 AS old_value, t1 AS new_value FROM c UNION ALL SELECT video_id, 'word_count', w0::VARCHAR, w1::VARCHAR FROM c""")
def audited_update(spark, sf):
    """Audit rows of an update of titles and word counts, unchanged values included."""
    d = table(spark, sf, "dataset").select("video_id", "line_no", "title", "word_count")
    changes = records.last_wins(d, "video_id", "line_no").select("video_id", "title", "word_count")
    return registry.update_videos(table(spark, sf, "videos"), changes, ["title", "word_count"], F.lit(STAMP).cast("timestamp"))[1].select("video_id", "field_name", "old_value", "new_value")


@query(f"""WITH {_INCOMING} SELECT v.video_id, CASE WHEN i.video_id IS NULL THEN v.title ELSE i.title END AS title, CASE WHEN i.video_id IS NULL THEN v.word_count ELSE i.word_count END AS word_count,
  v.status, (i.video_id IS NOT NULL) AS changed FROM videos v LEFT JOIN i USING (video_id)""")
def updated_snapshot(spark, sf):
    """The registry after that update; ``changed`` rows have its time."""
    d = table(spark, sf, "dataset").select("video_id", "line_no", "title", "word_count")
    changes = records.last_wins(d, "video_id", "line_no").select("video_id", "title", "word_count")
    new = registry.update_videos(table(spark, sf, "videos"), changes, ["title", "word_count"], F.lit(STAMP).cast("timestamp"))[0]
    return new.select("video_id", "title", "word_count", "status", F.coalesce(F.col("updated_at") == F.lit(STAMP).cast(new.schema["updated_at"].dataType), F.lit(False)).alias("changed"))


@query("SELECT video_id, title, channel, status FROM videos WHERE video_id = (SELECT min(video_id) FROM videos)")
def video_lookup(spark, sf):
    """One registry row by its id, the least one."""
    v = table(spark, sf, "videos")
    return registry.get_video(v, v.agg(F.min("video_id")).first()[0] or "").select("video_id", "title", "channel", "status")


@query("SELECT idx, heading, summary, start_ts, end_ts FROM sections WHERE video_id = (SELECT min(video_id) FROM sections)")
def section_lookup(spark, sf):
    """One video's sections in order."""
    s = table(spark, sf, "sections")
    return registry.get_sections(s, s.agg(F.min("video_id")).first()[0] or "")


@query(f"""WITH {_INCOMING}, j AS (SELECT i.video_id, v.video_id IS NOT NULL AS there, v.status, v.rewrite_status AS queue, i.word_count IS DISTINCT FROM v.word_count AS again FROM i LEFT JOIN (SELECT * FROM videos WHERE status <> 'embedded') v USING (video_id))
SELECT video_id, NOT there AS inserted, CASE WHEN NOT there OR status = 'raw' THEN 'cleaned' ELSE status END AS new_status, CASE WHEN again OR NOT there OR queue NOT IN ('pending', 'failed', 'done') OR queue IS NULL THEN 'pending' ELSE queue END AS new_queue FROM j""")
def record_transitions(spark, sf):
    """Staged records joined with their registry rows (the embedded ones left out, so that some are new): the rows after cleaning, queued again where the word count changed."""
    d = records.last_wins(table(spark, sf, "dataset").select("video_id", "line_no", F.col("word_count").alias("n")), "video_id", "line_no")
    v = table(spark, sf, "videos").where("status <> 'embedded'").select("video_id", "status", F.col("rewrite_status").alias("queue"), "word_count", F.lit(True).alias("there"))
    j = d.join(v, "video_id", "left")
    t = transitions.clean_row(F.col("status"), F.col("queue"), F.coalesce("there", F.lit(False)), ~F.col("n").eqNullSafe(F.col("word_count")))
    return j.select("video_id", t["inserted"].alias("inserted"), t["status"].alias("new_status"), t["queue"].alias("new_queue"))


@query("""WITH c AS (SELECT video_id, arg_max(chapters, line_no) AS c FROM dataset GROUP BY video_id),
  i AS (SELECT video_id, unnest(generate_series(0, len(c) - 1))::INT AS idx, unnest(c, recursive := true) FROM c WHERE len(c) > 0)
SELECT coalesce(s.video_id, i.video_id) AS video_id, coalesce(s.idx, i.idx) AS idx, CASE WHEN i.video_id IS NULL THEN s.heading ELSE i.title END AS heading,
  CASE WHEN i.video_id IS NULL THEN s.start_ts ELSE i.start_time END AS start_ts FROM sections s FULL JOIN i ON i.video_id = s.video_id AND i.idx = s.idx""")
def upsert_sections(spark, sf):
    """Chapters merged into the sections by place; a longer old list keeps its tail."""
    c = records.last_wins(table(spark, sf, "dataset").select("video_id", "line_no", "chapters"), "video_id", "line_no")
    new = c.select("video_id", F.posexplode("chapters").alias("idx", "c")).select("video_id", "idx", F.col("c.title").alias("heading"), F.lit(None).cast("string").alias("summary"), F.col("c.start_time").alias("start_ts"), F.col("c.end_time").alias("end_ts"))
    return registry.upsert_sections(table(spark, sf, "sections"), new).select("video_id", "idx", "heading", "start_ts")


@query("""SELECT video_id, CASE WHEN EXISTS (SELECT 1 FROM processing_runs r WHERE r.video_id = v.video_id AND r.status = 'failed') THEN 'failed' ELSE enrichment_status END AS enrichment_status FROM videos v""")
def queue_state(spark, sf):
    """Videos with a failed run put back to failed."""
    failed = table(spark, sf, "processing_runs").where("status = 'failed'").select("video_id")
    return registry.set_state(table(spark, sf, "videos"), failed, "enrichment_status", "failed").select("video_id", "enrichment_status")


@query("""SELECT video_id, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM videos WHERE status = 'ingested' AND channel ILIKE '%tal%' ORDER BY videos.scraped_at DESC NULLS LAST, video_id LIMIT 50""")
def search_channel(spark, sf):
    """A search page by channel and status."""
    return searching.search(table(spark, sf, "videos"), channel="tal", status="ingested").select("video_id", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss").alias("scraped_at"))


@query("""SELECT video_id, '[' || array_to_string(tags, ', ') || ']' AS tags FROM videos WHERE list_contains(tags, 'patient') ORDER BY scraped_at DESC NULLS LAST, video_id LIMIT 50""")
def search_tags(spark, sf):
    found = searching.search(table(spark, sf, "videos"), tags=["patient"])
    return found.select("video_id", F.concat(F.lit("["), F.array_join("tags", ", "), F.lit("]")).alias("tags"))


@query()
def search_text(spark, sf):
    """Full text: every stemmed word of the query in title or description, the newest page."""
    return searching.search(table(spark, sf, "videos"), query="measured diagrams").select("video_id", "title")


@query("""SELECT video_id, status, enrichment_status,
  CASE WHEN status = 'raw' OR status IS NULL THEN 'cleaned' ELSE status END AS new_status, coalesce(status = 'raw', true) AS audited,
  CASE WHEN enrichment_status IN ('pending', 'failed', 'done') THEN enrichment_status ELSE 'pending' END AS new_queue, coalesce(enrichment_status IN ('pending', 'failed'), true) AS queued FROM videos""")
def clean_transition(spark, sf):
    """Registry rows after cleaning documents that were there already."""
    t = transitions.clean_row(F.col("status"), F.col("enrichment_status"), F.lit(True), F.lit(False))
    return table(spark, sf, "videos").select("video_id", "status", "enrichment_status", t["status"].alias("new_status"), t["audited"].alias("audited"), t["queue"].alias("new_queue"), t["queued"].alias("queued"))


@query("""WITH x AS (SELECT video_id, status, clean_path, 'markdowns/' || video_id || '.md' AS dst FROM videos)
SELECT video_id, CASE WHEN status IS NULL OR status NOT IN ('raw', 'cleaned', 'ingested', 'embedded') THEN 'error' WHEN status IN ('raw', 'cleaned') OR clean_path IS DISTINCT FROM dst THEN 'updated' ELSE 'unchanged' END AS outcome,
  CASE WHEN status IN ('raw', 'cleaned') THEN 'ingested' ELSE status END AS new_status, CASE WHEN status IN ('raw', 'cleaned', 'ingested', 'embedded') THEN dst ELSE clean_path END AS new_path FROM x""")
def ingest_transition(spark, sf):
    dst = F.concat(F.lit("markdowns/"), F.col("video_id"), F.lit(".md"))
    t = transitions.ingest_row(F.col("status"), F.col("clean_path"), dst, F.lit(False))
    return table(spark, sf, "videos").select("video_id", t["outcome"].alias("outcome"), t["status"].alias("new_status"), t["clean_path"].alias("new_path"))


@query(rf"""WITH d AS (SELECT doc_id, video_id, doc_kind IN ('knowledge', 'article') AS there, {_N('text')} >= 200 AS long_enough, nullif(regexp_extract(text, 'url:\s+"https://tube\.example/watch\?v=([^"]+)"', 1), '') AS owner FROM documents)
SELECT doc_id, CASE WHEN there AND owner IS DISTINCT FROM video_id THEN 'error' WHEN there THEN 'skipped' WHEN NOT long_enough THEN 'filtered' ELSE 'saved' END AS outcome FROM d""")
def identity_gate(spark, sf):
    """Documents held against what is at their path: articles and knowledge documents are there already, the others would be written."""
    d = table(spark, sf, "documents").select("doc_id", "video_id", "doc_kind", F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    kept = F.when(X.word_count(F.col("content")) >= DEFAULTS.min_words, F.col("content"))
    rows = d.select("doc_id", "video_id", "path", kept.alias("cleaned"))
    return transitions.clean_outcomes(rows, d.where(F.col("doc_kind").isin("knowledge", "article")).select("path", "content"), HOST).select("doc_id", "outcome")


@query("SELECT coalesce(status, 'none') AS outcome, count(*) AS n FROM videos GROUP BY ALL")
def outcome_counts(spark, sf):
    return records.outcome_counts(table(spark, sf, "videos").select(F.coalesce("status", F.lit("none")).alias("outcome")))


# --- failures and models ---------------------------------------------------------------------------------------------


@query("""SELECT coalesce(error, 'unknown') AS reason, count(*) AS failures, count(*) FILTER (WHERE error IN ('timeout', 'connection reset')) AS transient FROM processing_runs WHERE status = 'failed' GROUP BY ALL""")
def failure_counts(spark, sf):
    r = table(spark, sf, "processing_runs").where("status = 'failed'").select(F.coalesce("error", F.lit("unknown")).alias("reason"), F.coalesce(F.col("error").isin("timeout", "connection reset"), F.lit(False)).alias("transient"))
    return resilience.failure_counts(r)


@query("""WITH a AS (SELECT model, video_id, count(*) AS n, count(*) FILTER (WHERE status = 'success') AS ok, sum(duration_ms) AS ms, count(duration_ms) AS timed FROM processing_runs GROUP BY ALL)
SELECT model, sum(n)::BIGINT AS runs, sum(ok)::BIGINT AS ok, (sum(n) - sum(ok))::BIGINT AS failed, (sum(ms) / sum(timed) / 1000)::DOUBLE AS avg_seconds, (sum(ms) / 1000)::DOUBLE AS total_seconds, count(*) FILTER (WHERE n > 1) AS retried FROM a GROUP BY model""")
def model_report(spark, sf):
    return resilience.model_report(table(spark, sf, "processing_runs"))


@query(f"""WITH r AS (SELECT model, sum({_N('v.summary')})::BIGINT AS tokens, sum(r.duration_ms::BIGINT * 1000000)::BIGINT AS ns FROM processing_runs r JOIN videos v USING (video_id) WHERE r.status = 'success' GROUP BY model)
SELECT model, tokens, CASE WHEN tokens > 0 AND ns > 0 THEN tokens / (ns / 1e9) END AS per_second FROM r""")
def tokens_per_second(spark, sf):
    v = table(spark, sf, "videos").select("video_id", X.word_count(F.col("summary")).alias("n"))
    # runs of one video and model are one row before the join, so no video is a hot key
    runs = table(spark, sf, "processing_runs").where("status = 'success'").groupBy("video_id", "model").agg(F.count("*").alias("runs"), F.sum(F.col("duration_ms").cast("long") * 1000000).alias("ns"))
    r = runs.join(v, "video_id").groupBy("model").agg(F.sum(F.col("n") * F.col("runs")).alias("tokens"), F.sum("ns").alias("ns"))
    return r.select("model", "tokens", resilience.tokens_per_second(F.col("tokens"), F.col("ns")).alias("per_second"))


@query("""WITH r AS (SELECT id, model || ' ' || strftime(created_at, '%Y-%m') AS run, CASE WHEN error = 'timeout' OR error = 'connection reset' THEN 'blocked' WHEN duration_ms IS NULL THEN 'skipped' ELSE status END AS outcome FROM processing_runs),
  a AS (SELECT *, sum(CASE WHEN outcome IN ('blocked', 'skipped') THEN 0 ELSE 1 END) OVER (PARTITION BY run ORDER BY id) AS island FROM r),
  b AS (SELECT *, sum((outcome = 'blocked')::INT) OVER (PARTITION BY run, island ORDER BY id) AS run_length FROM a),
  c AS (SELECT *, sum((outcome = 'blocked' AND run_length >= 2)::INT) OVER (PARTITION BY run ORDER BY id) AS hits FROM b)
SELECT id, run, outcome, run_length::BIGINT AS run_length, hits = 1 AS aborted FROM c WHERE hits = 0 OR (hits = 1 AND outcome = 'blocked' AND run_length = 2)""")
def circuit_breaker(spark, sf):
    """Runs of each model and month up to the second block in a row, after which a run has no more rows."""
    outcome = F.when(F.col("error").isin("timeout", "connection reset"), "blocked").when(F.col("duration_ms").isNull(), "skipped").otherwise(F.col("status"))
    r = table(spark, sf, "processing_runs").select("id", F.concat_ws(" ", "model", F.date_format("created_at", "yyyy-MM")).alias("run"), outcome.alias("outcome"))
    return resilience.circuit_breaker(r, "run", "id", "outcome", 2).select("id", "run", "outcome", "run_length", "aborted")


@query("SELECT i AS attempt, least(5.0 * power(3.0, i), 300.0)::DOUBLE AS seconds FROM generate_series(0, 5) t(i)")
def backoff(spark, sf):
    return spark.range(6).select(F.col("id").alias("attempt"), resilience.backoff_seconds(F.col("id")).alias("seconds"))


# --- logs and streams ------------------------------------------------------------------------------------------------


@query("""WITH n AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, count(*) OVER (PARTITION BY user_id) AS m FROM events)
SELECT event_id, user_id, event_type, seq FROM n WHERE seq > m - 20""")
def log_tail(spark, sf):
    """Events as numbered log lines, the newest twenty of each user."""
    return records.last_lines(records.numbered(table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts"), "user_id", "ts", "event_id"), "user_id", "seq", 20).drop("ts")


@query("SELECT event_id, user_id FROM events WHERE event_id > 500")
def log_resume(spark, sf):
    return records.resume_after(table(spark, sf, "events").select("event_id", "user_id"), "event_id", X.last_seq(F.lit(" 500 ")))


@query("""WITH d AS (SELECT id, status, created_at, row_number() OVER (ORDER BY created_at DESC, id DESC) AS rn FROM processing_runs WHERE status <> 'failed')
SELECT id AS job_id FROM d WHERE rn <= 20 UNION ALL SELECT id FROM processing_runs WHERE status = 'failed'""")
def retained_jobs(spark, sf):
    """Jobs kept: the open ones (here the failed runs) and the newest twenty of the finished."""
    r = table(spark, sf, "processing_runs").select(F.col("id").alias("job_id"), F.when(F.col("status") == "failed", "running").otherwise(F.col("status")).alias("status"), F.col("created_at").alias("started"))
    return records.retained_jobs(r, DEFAULTS.finished_jobs).select("job_id")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL")
def event_windows(spark, sf):
    """Hourly counts by the plan that also runs as a stream."""
    return jobs.windowed_counts(table(spark, sf, "events"), "ts", "event_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _streamed(spark: SparkSession, df: DataFrame) -> DataFrame:
    folder = own_folder(spark, "stream")
    query_ = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out")
    query_.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query("SELECT event_type, count(*) AS events, sum(value) AS value FROM events GROUP BY ALL")
def stream_totals(spark, sf):
    """Events read as a file stream, drained once, then summed."""
    source = jobs.stream_table(spark, f"{sf}/events.parquet").select("event_type", "value")
    return _streamed(spark, source).groupBy("event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
  s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS started, count(*) AS events FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf):
    return jobs.sessions(table(spark, sf, "events"), "user_id", "ts", "6 hours").withColumn("started", F.col("started").cast("timestamp_ntz"))


# --- documents and models --------------------------------------------------------------------------------------------


def _meta(prefix: str = "") -> dict:
    return {c: F.col(prefix + c) for c in ("title", "channel", "published", "url", "created_at", "description")}


_FRONT = rf"""'---' || chr(10) || 'title: "' || {_ESC("coalesce(title, '')")} || '"' || chr(10) || 'channel: "' || {_ESC("coalesce(channel, '')")} || '"' || chr(10) || 'published: "' || coalesce(published, '') || '"' || chr(10) || 'url: "' || coalesce(url, '') || '"' || chr(10)"""
_CREATED = """CASE WHEN coalesce(created_at, '') <> '' THEN 'created_at: "' || created_at || '"' || chr(10) ELSE '' END"""
_BLOCK = lambda c: rf"""CASE WHEN {_STRIP(f"coalesce({c}, '')")} = '' THEN '""' ELSE '|' || chr(10) || '  ' || regexp_replace({_STRIP(c)}, '\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]', chr(10) || '  ', 'g') END"""


@query(rf"""SELECT line_no, {_FRONT} || {_CREATED} || 'description: ' || {_BLOCK('description')} || chr(10) || '---' || chr(10) || chr(10) || '## Transcript' || chr(10) || chr(10) || coalesce(transcript_text, '') || chr(10) AS document FROM dataset""")
def render_clean(spark, sf):
    return table(spark, sf, "dataset").select("line_no", render.clean_markdown(_meta(), F.coalesce("transcript_text", F.lit(""))).alias("document"))


@query(rf"""WITH {_SEGS}, t AS (SELECT line_no, string_agg(CASE WHEN trunc(start)::BIGINT // 3600 <> 0 THEN printf('[%02d:%02d:%02d]', trunc(start)::BIGINT // 3600, trunc(start)::BIGINT % 3600 // 60, trunc(start)::BIGINT % 60)
    ELSE printf('[%02d:%02d]', trunc(start)::BIGINT // 60, trunc(start)::BIGINT % 60) END || ' ' || {_STRIP("replace(coalesce(text, ''), chr(10), ' ')")}, chr(10) ORDER BY pos) || chr(10) AS body FROM s GROUP BY line_no)
SELECT d.line_no, {_FRONT} || 'description: ' || {_BLOCK('description')} || chr(10) || '---' || chr(10) || chr(10) || '## Transcript' || chr(10) || chr(10) || coalesce(body, '') AS document FROM dataset d LEFT JOIN t USING (line_no)""")
def render_raw(spark, sf):
    """One stamped line per segment."""
    return table(spark, sf, "dataset").select("line_no", render.raw_markdown(_meta(), F.col("transcript_segments")).alias("document"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "videos").withColumn("published", F.date_format("published_date", "yyyy-MM-dd")).withColumn("created_at", X.iso_stamp(F.col("created_at")))
    blank = F.array().cast("array<struct<heading:string,summary:string>>")
    e = F.struct("summary", "key_concepts", "domains", "difficulty", "content_kind", blank.alias("sections"))
    return v.withColumn("e", F.when(F.col("summary").isNotNull(), e))


_FLOW = lambda c: rf"""CASE WHEN len(coalesce({c}, [])) = 0 THEN '[]' ELSE '["' || array_to_string(list_transform({c}, lambda x: {_ESC("x")}), '", "') || '"]' END"""
_V = "v AS (SELECT * REPLACE (strftime(created_at, '%Y-%m-%dT%H:%M:%S+00:00') AS created_at), strftime(published_date, '%Y-%m-%d') AS published FROM videos)"
_E = rf"""CASE WHEN summary IS NULL THEN '' ELSE 'difficulty: "' || coalesce(difficulty, '') || '"' || chr(10) || 'content_kind: "' || coalesce(content_kind, '') || '"' || chr(10) || 'domains: ' || {_FLOW('domains')} || chr(10) || 'key_concepts: ' || {_FLOW('key_concepts')} || chr(10) || 'summary: ' || {_BLOCK('summary')} || chr(10) END"""
_HEAD = rf"""{_FRONT} || {_CREATED} || {_E} || 'description: ' || {_BLOCK('description')} || chr(10) || '---' || chr(10) || chr(10)"""
_PARTS = rf"""CASE WHEN {_STRIP("coalesce(summary, '')")} = '' THEN '' ELSE '## Summary' || chr(10) || chr(10) || {_STRIP('summary')} || chr(10) || chr(10) END || CASE WHEN summary IS NULL OR len(coalesce(key_concepts, [])) = 0 THEN '' ELSE '## Key Concepts' || chr(10) || chr(10) || '- ' || array_to_string(key_concepts, chr(10) || '- ') || chr(10) || chr(10) END"""


@query(rf"""WITH {_V} SELECT id, {_HEAD} || {_PARTS} || '## Transcript' || chr(10) || chr(10) || coalesce(notes, '') || chr(10) AS document FROM v""")
def render_knowledge(spark, sf):
    v = _enriched(spark, sf)
    return v.select("id", render.knowledge_doc(_meta(), F.coalesce("notes", F.lit("")), F.col("e")).alias("document"))


@query(rf"""WITH {_V} SELECT id, {_HEAD} || {_PARTS} || '## Article' || chr(10) || chr(10) || coalesce(title, '') || chr(10) AS document FROM v""")
def render_article(spark, sf):
    v = _enriched(spark, sf)
    return v.select("id", render.article_doc(_meta(), F.coalesce("title", F.lit("")), F.col("e")).alias("document"))


@query(f"SELECT id, {_STRIP('title')} AS body FROM videos WHERE {_STRIP('title')} <> ''")
def article_round_trip(spark, sf):
    """Article bodies read back out of their documents."""
    v = _enriched(spark, sf)
    d = v.select("id", render.article_doc(_meta(), F.coalesce("title", F.lit("")), F.col("e")).alias("document"))
    return d.select("id", X.article_body(F.col("document")).alias("body")).where("body IS NOT NULL")


@query(f"""SELECT line_no, 13 AS keys, coalesce(video_id, '') AS video_id, coalesce(created_at, '') AS created_at, {_N('transcript_text')}::INT AS word_count, len(transcript_segments)::INT AS segments FROM dataset""")
def json_records(spark, sf):
    """Records as JSON lines, read back."""
    meta = {c: F.col(c) for c in ("video_id", "created_at", "url", "title", "channel", "channel_id", "published", "description", "chapters")}
    line = render.json_record(meta, F.col("transcript_segments"), F.col("transcript_text"), F.col("md_path"), F.lit(""))
    d = table(spark, sf, "dataset").select("line_no", line.alias("j"))
    r = d.select("line_no", F.size(F.json_object_keys("j")).alias("keys"), F.from_json("j", "video_id string, created_at string, word_count int, transcript_segments array<struct<text:string,start:double,duration:double>>").alias("r"))
    return r.select("line_no", "keys", "r.video_id", "r.created_at", "r.word_count", F.size("r.transcript_segments").alias("segments"))


@query(rf"""SELECT id, CASE WHEN lower(trim(difficulty)) IN ('beginner', 'intermediate', 'advanced') THEN lower(trim(difficulty)) ELSE 'intermediate' END AS difficulty,
  CASE WHEN lower(trim(content_kind)) IN ('tutorial', 'lecture', 'talk', 'interview', 'explainer', 'news', 'other') THEN lower(trim(content_kind)) ELSE 'other' END AS content_kind,
  array_to_string(list_filter(list_transform(coalesce(key_concepts, []), lambda x: {_STRIP('x')}), lambda x: x <> '')[1:8], '|') AS key_concepts,
  array_to_string(list_transform(list_filter(list_transform(coalesce(domains, []), lambda x: {_STRIP('x')}), lambda x: x <> '')[1:4], lambda x: lower(x)), '|') AS domains FROM videos""")
def enum_normalise(spark, sf):
    e = F.struct("summary", "key_concepts", "domains", "difficulty", "content_kind", F.lit(None).cast("array<struct<heading:string,summary:string>>").alias("sections"))
    v = table(spark, sf, "videos").select("id", enrich.normalised(e).alias("e"))
    return v.select("id", "e.difficulty", "e.content_kind", F.array_join("e.key_concepts", "|").alias("key_concepts"), F.array_join("e.domains", "|").alias("domains"))


@query(f"""WITH RECURSIVE {_FOLD}, kept AS (SELECT line_no FROM bl GROUP BY line_no HAVING coalesce(sum({_N('text')}) FILTER (WHERE NOT starts_with(text, '##')), 0) >= 200),
  rk AS MATERIALIZED (SELECT line_no, row_number() OVER (PARTITION BY line_no ORDER BY block) AS idx, starts_with({_STRIP('text')}, '#') AS head, CASE WHEN starts_with({_STRIP('text')}, '#') THEN {_STRIP("regexp_replace(" + _STRIP('text') + ", '^#+', '')")} ELSE {_STRIP('text')} END AS t, {_N('text')} AS n FROM bl JOIN kept USING (line_no)),
  rc AS (SELECT line_no, idx, head, CASE WHEN head THEN 0 ELSE n END AS words, 0 AS chunk, NOT head AND n >= 900 AS full_now FROM rk WHERE idx = 1
   UNION ALL SELECT rk.line_no, rk.idx, rk.head, CASE WHEN rk.head THEN 0 WHEN rc.full_now THEN rk.n ELSE rc.words + rk.n END, rc.chunk + CASE WHEN rc.full_now OR (rk.head AND NOT rc.head) THEN 1 ELSE 0 END,
     CASE WHEN rk.head THEN false WHEN rc.full_now THEN rk.n >= 900 ELSE rc.words + rk.n >= 900 END FROM rc JOIN rk ON rk.line_no = rc.line_no AND rk.idx = rc.idx + 1),
  rp AS (SELECT rk.line_no, rk.idx, rk.head, rk.t, rk.n, rc.chunk, last_value(CASE WHEN rk.head THEN rk.t END IGNORE NULLS) OVER (PARTITION BY rk.line_no ORDER BY rk.idx) AS heading FROM rk JOIN rc USING (line_no, idx)),
  rq AS (SELECT *, lag(heading) OVER (PARTITION BY line_no ORDER BY idx) AS before FROM rp WHERE NOT head)
SELECT line_no::VARCHAR AS video_id, string_agg(CASE WHEN heading <> '' AND heading IS DISTINCT FROM before THEN '## ' || heading || chr(10) || chr(10) ELSE '' END || t, chr(10) || chr(10) ORDER BY idx) AS article,
  count(DISTINCT chunk)::INT AS chunks, 0 AS fallbacks, sum(n)::INT AS words_in, sum(n)::INT AS words_out, NULL::VARCHAR AS error FROM rq GROUP BY line_no""")
def rewrite_articles(spark, sf):
    """Cleaned transcripts rewritten chunk by chunk by the deterministic model."""
    d = segments.clean(table(spark, sf, "dataset")).where("cleaned IS NOT NULL")
    c = d.select(F.col("line_no").cast("string").alias("video_id"), "title", chunks.chunk_blocks(chunks.split_blocks(F.col("cleaned"))).alias("chunks"))
    return enrich.rewrite(c, enrich.EchoModel())


@query(f"""WITH l AS (SELECT line_no, transcript_text, regexp_extract_all(list_last(string_split(transcript_text, chr(10))), '[^{_WHITE}]+')[1:3] AS head FROM dataset),
  k AS (SELECT *, {_STRIP("coalesce(transcript_text, '')")} = '' AS blank FROM l)
SELECT line_no::VARCHAR AS video_id, CASE WHEN NOT blank THEN array_to_string(head, ' ') END AS summary, CASE WHEN NOT blank THEN array_to_string(head, '|') END AS key_concepts,
  CASE WHEN NOT blank THEN 'beginner' END AS difficulty, CASE WHEN blank THEN 'no prose' END AS error, 'echo' AS model FROM k""")
def enrich_records(spark, sf):
    """Structured metadata by the deterministic model, normalised."""
    d = table(spark, sf, "dataset").select(F.col("line_no").cast("string").alias("video_id"), "title", F.col("transcript_text").alias("body"))
    return enrich.enrich(d, enrich.EchoModel()).select("video_id", "enrichment.summary", F.array_join("enrichment.key_concepts", "|").alias("key_concepts"), "enrichment.difficulty", "error", "model")


# --- further operators over the same tables --------------------------------------------------------------------------


@query("""WITH t AS (SELECT CASE WHEN coalesce(source, '') = '' THEN 'none' ELSE source END AS k, doc_id AS pos, coalesce(lang, '') AS language, doc_kind IN ('captions', 'transcript') AS generated FROM documents),
  r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN language = 'de' THEN 0 WHEN NOT generated THEN 1 ELSE 2 END, pos) AS rn FROM t)
SELECT k, pos, language, generated FROM r WHERE rn = 1""")
def choose_track(spark, sf):
    """One text of each source: German first, else the first written by hand, else the first generated."""
    source = X.first_filled(F.col("source"), default="none")
    d = table(spark, sf, "documents").select(source.alias("k"), F.col("doc_id").alias("pos"), F.coalesce("lang", F.lit("")).alias("language"), F.col("doc_kind").isin("captions", "transcript").alias("generated"))
    return records.choose_track(d, "k", "de").select("k", "pos", "language", "generated")


@query(r"""WITH d AS (SELECT coalesce(video_id, doc_id::VARCHAR) || '.md' AS path, doc_id, doc_kind, nullif(regexp_extract(text, 'url:\s+"https://tube\.example/watch\?v=([^"]+)"', 1), '') AS owner, coalesce(text, '') AS text FROM documents),
  s AS (SELECT path, arg_min(owner, doc_id) FILTER (WHERE owner IS NOT NULL) AS o, min(doc_id) AS doc_id FROM d WHERE doc_kind = 'knowledge' GROUP BY path),
  f AS (SELECT s.path, d.owner FROM s JOIN d USING (doc_id)),
  t AS (SELECT path, min(doc_id) AS doc_id FROM d WHERE doc_kind <> 'knowledge' GROUP BY path), g AS (SELECT t.path, CASE WHEN length(d.text) % 3 = 0 THEN d.owner ELSE f.owner END AS owner FROM t JOIN d USING (doc_id) JOIN f ON f.path = t.path)
SELECT f.path, CASE WHEN f.owner IS NULL OR (g.path IS NOT NULL AND g.owner IS DISTINCT FROM f.owner) THEN 'error' WHEN g.path IS NOT NULL THEN 'keep' ELSE 'copy' END AS action FROM f LEFT JOIN g USING (path)""")
def ingest_files(spark, sf):
    """Knowledge documents held against others at the same paths, two thirds of which (by length) get the identity line of the first."""
    d = table(spark, sf, "documents").select(F.concat(F.coalesce("video_id", F.col("doc_id").cast("string")), F.lit(".md")).alias("path"), "doc_id", "doc_kind", F.coalesce("text", F.lit("")).alias("content"))
    source = records.first_wins(d.where("doc_kind = 'knowledge'").select("path", "doc_id", "content"), "path", "doc_id")
    target = records.first_wins(d.where("doc_kind <> 'knowledge'").select("path", "doc_id", "content"), "path", "doc_id")
    target = target.join(source.select("path", F.col("content").alias("own")), "path").withColumn("content", F.when(F.length("content") % 3 == 0, F.col("content")).otherwise(F.col("own")))
    return transitions.ingest_files(source, target, HOST).select("path", "action")


@query(f"SELECT id, len(list_intersect({_CONTENT.replace('{0}', 'title')}, {_CONTENT.replace('{0}', 'description')}))::INT AS shared, len(list_filter({_CONTENT.replace('{0}', 'title')}, lambda w: NOT list_contains({_CONTENT.replace('{0}', 'description')}, w)))::INT AS missing FROM videos")
def vocabulary_overlap(spark, sf):
    """Content words of a title that its description holds, and those it doesn't."""
    a, b = (X.content_words(F.coalesce(c, F.lit(""))) for c in ("title", "description"))
    return table(spark, sf, "videos").select("id", F.size(F.array_intersect(a, b)).alias("shared"), F.size(F.array_except(a, b)).alias("missing"))


@query("SELECT model, status, count(*) AS n FROM (SELECT model, status FROM processing_runs UNION ALL SELECT 'echo', 'success' FROM videos WHERE enrichment_status = 'pending') GROUP BY ALL")
def run_log_append(spark, sf):
    """Processing runs with the new runs of the pending videos appended."""
    new = table(spark, sf, "videos").where("enrichment_status = 'pending'").select("video_id", F.lit("echo").alias("model"), F.lit("success").alias("status"))
    runs = registry.record_runs(table(spark, sf, "processing_runs"), new)
    return runs.groupBy("model", "status").agg(F.count("*").alias("n"))


@query(r"""WITH r AS (SELECT id, CASE WHEN status = 'failed' THEN 'Qwen ' || model ELSE model END AS model, coalesce(error, status) || chr(13) || chr(10) || model || chr(10) || chr(13) || 'end' AS error FROM processing_runs)
SELECT id, CASE WHEN starts_with(lower(model), 'qwen') THEN '/no_think' ELSE '' END AS prefix, regexp_replace(error, '\r\n|\n|\r', ' ', 'g') AS line FROM r""")
def prompt_prefix(spark, sf):
    """Prompt prefix by model, with the failed runs moved to a model that needs one, and a message of several lines as a one-line log event."""
    r = table(spark, sf, "processing_runs")
    model = F.when(F.col("status") == "failed", F.concat(F.lit("Qwen "), F.col("model"))).otherwise(F.col("model"))
    message = F.concat(F.coalesce("error", "status"), F.lit("\r\n"), F.col("model"), F.lit("\n\rend"))
    return r.select("id", X.strip(enrich.system_prefix(model)).alias("prefix"), X.line_event(message).alias("line"))


@query(f"SELECT doc_id, {_STRIP("coalesce(text, '')")} AS inner_text, coalesce(text, '') AS bare FROM documents")
def strip_fences(spark, sf):
    """Texts wrapped in one code fence and unwrapped again, and texts without a fence, which stay."""
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf, "documents").select("doc_id", X.strip_fences(F.concat(F.lit("```markdown\n"), text, F.lit("\n```"))).alias("inner_text"), X.strip_fences(text).alias("bare"))


@query("""WITH p AS (SELECT id, raw_path AS path FROM videos UNION ALL SELECT -id, regexp_replace(raw_path, '\\.md$', '.transcript.md') FROM videos UNION ALL SELECT id + 1000000000, coalesce(clean_path, 'none.txt') FROM videos)
SELECT id, path, ends_with(path, '.transcript.md') AS companion, CASE WHEN ends_with(path, '.transcript.md') THEN path ELSE regexp_replace(path, '\\.md$', '.transcript.md') END AS companion_path FROM p""".replace("\\\\", "\\"))
def companion_paths(spark, sf):
    """Raw and clean paths of all videos, and the companions of the raw ones, which are their own companions."""
    v = table(spark, sf, "videos")
    raw = v.select("id", F.col("raw_path").alias("path"))
    own = v.select((-F.col("id")).alias("id"), records.companion_path(F.col("raw_path")).alias("path"))
    p = raw.unionByName(own).unionByName(v.select((F.col("id") + 1_000_000_000).alias("id"), F.coalesce("clean_path", F.lit("none.txt")).alias("path")))
    return p.select("id", "path", records.is_companion(F.col("path")).alias("companion"), records.companion_path(F.col("path")).alias("companion_path"))


@query("SELECT line_no, video_id FROM dataset WHERE line_no IN (SELECT min(line_no) FROM dataset GROUP BY video_id)")
def staged_lookup(spark, sf):
    """The first staged line of every registered video: the point lookup, for all ids at once."""
    first = records.first_wins(table(spark, sf, "dataset").select("video_id", "line_no"), "video_id", "line_no")
    return first.join(table(spark, sf, "videos").select("video_id"), "video_id", "left_semi").select("line_no", "video_id")


@query("""SELECT id, video_id, count(*) OVER (PARTITION BY video_id) AS attempts, row_number() OVER (PARTITION BY video_id ORDER BY created_at DESC, id DESC) = 1 AS latest FROM processing_runs""")
def run_attempts(spark, sf):
    """Attempts per video and which run is the latest; a pre-aggregated lookup, so no video's runs meet in one task."""
    r = table(spark, sf, "processing_runs").select("id", "video_id", "created_at")
    last = r.groupBy("video_id").agg(F.max(F.struct("created_at", "id")).alias("top"), F.count("*").alias("attempts"))
    found = weighted_lookup(r, last.select("video_id", "top", "attempts", F.col("attempts").alias("uses")), ["video_id"], "uses")
    return found.select("id", "video_id", "attempts", (F.col("id") == F.col("top")["id"]).alias("latest"))


# --- files, connectors and stages ------------------------------------------------------------------------------------

_RECORD_COLUMNS = ("video_id", "created_at", "url", "title", "channel", "channel_id", "published", "description", "chapters", "transcript_text", "transcript_segments", "word_count", "md_path")


@query("""SELECT video_id, title, created_at, word_count, len(transcript_segments)::INT AS segments, len(chapters)::INT AS chapters, md_path FROM dataset""")
def record_file(spark, sf):
    """The record file appended in two batches, the second of them twice under its name, and scanned with its schema."""
    folder, d = own_folder(spark, "records"), table(spark, sf, "dataset").select(*_RECORD_COLUMNS)
    short = F.coalesce(F.size("transcript_segments") < 50, F.lit(True))
    sinks.append_records(d.where(short), folder, "first")
    for _ in range(2):
        sinks.append_records(d.where(~short), folder, "second")
    r = readers.records(spark, folder)
    return r.select("video_id", "title", "created_at", "word_count", F.size("transcript_segments").alias("segments"), F.size("chapters").alias("chapters"), "md_path")


@query(f"""SELECT line_no, count(*) OVER (PARTITION BY video_id) AS lines, video_id FROM dataset""")
def appended_lines(spark, sf):
    """The record file scanned, with the number of lines of each video."""
    folder, d = own_folder(spark, "lines"), table(spark, sf, "dataset").select("line_no", "video_id")
    d.write.json(folder)
    r = spark.read.schema("line_no long, video_id string").json(folder)
    n = r.groupBy("video_id").agg(F.count("*").alias("lines"))
    return weighted_lookup(r, n.withColumn("uses", F.col("lines")), ["video_id"], "uses").select("line_no", "lines", "video_id")


@query("""SELECT video_id, nullif(channel, '') AS channel, nullif(published, '') AS published, nullif(url, '') AS url, word_count::VARCHAR AS word_count, nullif(md_path, '') AS md_path FROM dataset""")
def manifest_file(spark, sf):
    """The seven-column manifest appended and read back as text; CSV doesn't tell empty values from missing ones."""
    folder = own_folder(spark, "manifest")
    sinks.append_manifest(table(spark, sf, "dataset"), folder)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(folder)
    return back.select("video_id", "channel", "published", "url", "word_count", "md_path")


@query("""SELECT 'd/' || doc_id || '.md' AS path, text AS content FROM documents WHERE text <> ''""")
def document_files(spark, sf):
    """All texts written as files, tried a second time, and read back with their paths; paths that would leave the folder write nothing."""
    folder = own_folder(spark, "documents")
    d = table(spark, sf, "documents").where("text <> ''").select(F.concat(F.lit("d/"), F.col("doc_id"), F.lit(".md")).alias("path"), F.col("text").alias("content"))
    sinks.write_documents(d, folder).count()
    sinks.write_documents(d.withColumn("content", F.lit("again")), folder).count()
    sinks.write_documents(d.withColumn("path", F.concat(F.lit("../out-"), F.col("path"))), folder).count()
    return readers.documents(spark, folder)


@query("""SELECT coalesce(error, 'unknown') AS reason, count(*) AS failures, count(*) FILTER (WHERE error IN ('timeout', 'connection reset')) AS transient FROM processing_runs WHERE status = 'failed' GROUP BY ALL""")
def failure_file(spark, sf):
    """Failed runs appended to the failure file, and its counts by reason read back."""
    folder = own_folder(spark, "failures")
    r = table(spark, sf, "processing_runs").where("status = 'failed'").select("video_id", F.coalesce("error", F.lit("unknown")).alias("reason"), F.coalesce(F.col("error").isin("timeout", "connection reset"), F.lit(False)).alias("transient"))
    sinks.failure_report(r, folder)
    return resilience.failure_counts(spark.read.schema("video_id string, reason string, transient boolean").json(folder))


@query("""SELECT model, count(*) AS runs FROM processing_runs GROUP BY model""")
def report_file(spark, sf):
    """Runs of each model as one JSON report, read back."""
    r = table(spark, sf, "processing_runs").groupBy("model").agg(F.count("*").alias("runs"))
    return sinks.report_json(r).select(F.explode(F.from_json("report", "array<struct<model:string,runs:long>>")).alias("x")).select("x.model", "x.runs")


@query("SELECT url AS source FROM videos WHERE status <> 'raw'")
def source_lines(spark, sf):
    """A source list with blank lines, comments and indented addresses, read back."""
    folder, v = own_folder(spark, "sources"), table(spark, sf, "videos")
    line = F.when(F.col("status") == "raw", F.concat(F.lit("  # "), F.col("url"))).otherwise(F.concat(F.lit("\t"), F.col("url"), F.lit("  ")))
    v.select(F.explode(F.array(line, F.lit(" "))).alias("value")).write.text(folder)
    return readers.source_list(spark, folder).select("source")


@query("""SELECT line_no, i::INT AS place, c.title AS title FROM (SELECT line_no, unnest(chapters) AS c, unnest(range(len(chapters))) AS i FROM dataset) WHERE c.title <> ''
UNION ALL SELECT line_no, -1, title FROM dataset WHERE chapters IS NULL OR len(chapters) = 0""")
def playlist_entries(spark, sf):
    """Chapters as the entries of a playlist: null entries dropped, a row that is no playlist kept as it is."""
    d = table(spark, sf, "dataset")
    entry = F.transform("chapters", lambda c, i: F.when(c["title"] != "", F.struct(c["title"].alias("title"), i.alias("i"))))
    rows = d.select("line_no", "title", F.when(F.size("chapters") > 0, entry).alias("entries"))
    return readers.expanded(rows).select("line_no", F.coalesce("entry.i", F.lit(-1)).alias("place"), F.coalesce("entry.title", "title").alias("title"))


@query(r"""SELECT line_no, CASE WHEN line_no % 2 = 0 THEN video_id ELSE string_split(url, 'v=')[-1] END AS video_id, coalesce(title, '') AS title,
  CASE WHEN len(replace(published, '-', '')) = 8 THEN substr(replace(published, '-', ''), 1, 4) || '-' || substr(replace(published, '-', ''), 5, 2) || '-' || substr(replace(published, '-', ''), 7, 2) ELSE coalesce(replace(published, '-', ''), '') END AS published,
  CASE WHEN line_no % 3 = 0 THEN 'by ' || coalesce(channel, '') ELSE coalesce(nullif(channel, ''), 'by ') END AS channel FROM dataset WHERE line_no % 2 = 0 OR string_split(url, 'v=')[-1] <> ''""")
def normalised_infos(spark, sf):
    """Connector rows as metadata: every other id comes from its address, every third channel from the uploader."""
    d = table(spark, sf, "dataset")
    info = d.select(
        F.when(F.col("line_no") % 2 == 0, F.col("video_id")).alias("id"), "url", F.concat_ws("|", F.col("line_no"), F.coalesce("title", F.lit(""))).alias("title"), F.replace(F.col("published"), F.lit("-"), F.lit("")).alias("upload_date"),
        F.when(F.col("line_no") % 3 != 0, F.col("channel")).alias("channel"), F.concat(F.lit("by "), F.when(F.col("line_no") % 3 == 0, F.coalesce("channel", F.lit(""))).otherwise("")).alias("uploader"), "channel_id", "description",
    )
    n = readers.normalised_info(info)
    return n.select(F.expr("CAST(substring_index(title, '|', 1) AS BIGINT)").alias("line_no"), "video_id", F.expr("substring(title, instr(title, '|') + 1)").alias("title"), "published", "channel")


def _scripted_fetch(video_id: str) -> dict:
    """A stand-in for a caption connector whose answer follows from the id's last character."""
    last = video_id[-1:].lower()
    if last in "abc":
        return {"reason": "blocked", "detail": "refused"}
    if last in "de":
        return {"reason": "no_transcript", "detail": ""}
    if last == "f":
        raise TimeoutError("late")
    return {"segments": [{"text": video_id, "start": 0.0, "duration": 1.0}]}


_ANSWER = """CASE WHEN lower(right(video_id, 1)) IN ('a', 'b', 'c') THEN 'blocked' WHEN lower(right(video_id, 1)) IN ('d', 'e') THEN 'no_transcript' WHEN lower(right(video_id, 1)) = 'f' THEN 'failed' END"""


@query(f"""SELECT video_id, {_ANSWER} AS reason, CASE {_ANSWER} WHEN 'blocked' THEN 'refused' WHEN 'no_transcript' THEN '' WHEN 'failed' THEN 'TimeoutError: late' END AS detail, CASE WHEN {_ANSWER} IS NOT NULL THEN {_ANSWER} = 'blocked' END AS transient, ({_ANSWER} IS NULL)::INT AS segments FROM videos""")
def fetch_outcomes(spark, sf):
    """Connector calls by a scripted client: segments, typed failures, and exceptions."""
    out = readers.fetched(table(spark, sf, "videos").select("video_id"), _scripted_fetch)
    return out.select("video_id", "reason", "detail", "transient", F.coalesce(F.size("segments"), F.lit(0)).alias("segments"))


_SCRAPE = f"""WITH v AS (SELECT id, video_id, coalesce(channel, '') AS run, status, CASE WHEN status = 'raw' THEN 'skipped' WHEN {_ANSWER} = 'blocked' THEN 'blocked' WHEN {_ANSWER} IS NOT NULL THEN 'failed' ELSE 'saved' END AS outcome FROM videos),
  a AS (SELECT *, sum(CASE WHEN outcome IN ('blocked', 'skipped') THEN 0 ELSE 1 END) OVER (PARTITION BY run ORDER BY id) AS island FROM v),
  b AS (SELECT *, sum((outcome = 'blocked')::INT) OVER (PARTITION BY run, island ORDER BY id) AS run_length FROM a),
  c AS (SELECT *, sum((outcome = 'blocked' AND run_length >= 3)::INT) OVER (PARTITION BY run ORDER BY id) AS hits FROM b),
  d AS (SELECT id, run, outcome, hits = 1 AS aborted FROM c WHERE hits = 0 OR (hits = 1 AND outcome = 'blocked' AND run_length = 3))"""


def _scraped(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "videos").select("video_id", F.coalesce("channel", F.lit("")).alias("run"), F.col("id").alias("order"), "status", F.lit("c").alias("channel"), F.col("video_id").alias("title"))
    there = v.where("status = 'raw'").select(records.output_path(F.col("channel"), F.col("title")).alias("path"))
    report = pipeline.run_all([pipeline.scrape_stage(_scripted_fetch)], {"sources": v, "documents": there})
    return report.tables["attempts"]


@query(f"""{_SCRAPE} SELECT id, outcome, aborted FROM d""")
def scrape_attempts(spark, sf):
    """A scrape of every channel as a run of its own: what was there is skipped, three blocks in a row end a run."""
    return _scraped(spark, sf).select(F.col("order").alias("id"), "outcome", "aborted")


@query(f"""{_SCRAPE} SELECT count(*) FILTER (WHERE outcome = 'saved') AS saved, count(*) FILTER (WHERE outcome = 'skipped') AS skipped, count(*) FILTER (WHERE outcome IN ('failed', 'blocked')) AS failed, bool_or(aborted) AS aborted,
  NOT bool_or(aborted) AND count(*) FILTER (WHERE outcome IN ('saved', 'skipped')) > 0 AS ok FROM d""")
def scrape_verdict(spark, sf):
    return resilience.scrape_verdict(_scraped(spark, sf))




@query(rf"""WITH g AS (SELECT v.id, v.video_id, CASE WHEN v.id % 7 = 0 THEN '13 May' WHEN v.id % 11 = 0 THEN '2024-02-30' ELSE '2024-02-28' END AS published, v.status = 'raw' AS staged,
    NOT regexp_matches(coalesce(v.description, ''), '[\p{{L}}\p{{N}}]') AS blank FROM videos v)
SELECT video_id, CASE WHEN staged THEN 'already staged' WHEN blank THEN 'no segment in the transcript' WHEN id % 7 = 0 OR id % 11 = 0 THEN 'published date must be a real date in YYYY-MM-DD format' END AS reason FROM g""")
def manual_pastes(spark, sf):
    """Descriptions pasted as transcripts: refused where the video is staged already, nothing is in them, or the date isn't one."""
    v = table(spark, sf, "videos")
    published = F.when(F.col("id") % 7 == 0, "13 May").when(F.col("id") % 11 == 0, "2024-02-30").otherwise("2024-02-28")
    # a text without a letter or digit is blank here, so that rows without a segment don't depend on how signs are read
    text = F.when(F.coalesce(F.col("description").rlike(r"[\p{L}\p{N}]"), F.lit(False)), F.concat(F.lit("Pasted text. "), F.replace(F.col("description"), F.lit(":"), F.lit(" "))))
    pastes = v.select(F.concat(F.lit("https://tu.example/"), F.col("video_id")).alias("url"), text.alias("transcript"), "title", F.lit(" ").alias("channel"), published.alias("published"), F.lit(None).cast("string").alias("description"))
    fetched = v.select("video_id", "title", "channel", F.lit("").alias("published"), "description")
    staged = v.where("status = 'raw'").select("video_id")
    t = pipeline.run_all([pipeline.manual_stage(HOSTS, SHORT_HOSTS)], {"pastes": pastes, "records": staged, "fetched": fetched}).tables
    return t["manual_records"].select("video_id", F.lit(None).cast("string").alias("reason")).unionByName(t["refused"].select("video_id", "reason"))


@query("""WITH v AS (SELECT video_id, status, clean_path, channel_id FROM videos), o AS (SELECT *, 'k/' || video_id || '.md' AS path FROM v)
SELECT path, CASE WHEN status IN ('ingested', 'embedded') THEN 'keep' ELSE 'copy' END AS action, CASE WHEN status IN ('raw', 'cleaned') OR clean_path IS DISTINCT FROM 'out/' || path THEN 'updated' ELSE 'unchanged' END AS outcome,
  CASE WHEN status IN ('raw', 'cleaned') THEN 'ingested' ELSE status END AS new_status FROM o
UNION ALL SELECT 'k/' || video_id || '.other.md', 'error', 'error', NULL FROM v WHERE status = 'raw'""")
def ingest_stage(spark, sf):
    """Knowledge documents of all videos ingested over those that are there, and documents without an identity, which are errors."""
    v = table(spark, sf, "videos").where("video_id IS NOT NULL")
    named = F.concat(F.lit("url: \"https://tube.example/watch?v="), F.col("video_id"), F.lit("\"\n"))
    path = F.concat(F.lit("k/"), F.col("video_id"), F.lit(".md"))
    documents = v.select(path.alias("path"), named.alias("content")).unionByName(v.where("status = 'raw'").select(F.concat(F.lit("k/"), F.col("video_id"), F.lit(".other.md")).alias("path"), F.lit("no line").alias("content")))
    there = v.where("status IN ('ingested', 'embedded')").select(path.alias("path"), named.alias("content"))
    t = pipeline.run_all([pipeline.ingest_stage("out/", HOST)], {"clean_documents": documents, "ingested_documents": there, "videos": v}).tables
    return t["ingest"].select("path", "action", "outcome", "new_status")


# --- models, requests, pacing ----------------------------------------------------------------------------------------


@query(rf"""WITH k AS (SELECT line_no, regexp_extract_all(list_last(string_split(transcript_text, chr(10))), '[^{_WHITE}]+')[1:3] AS head, {_STRIP("coalesce(transcript_text, '')")} = '' AS blank, chapters FROM dataset),
  h AS (SELECT *, list_filter(coalesce(chapters, []), lambda c: coalesce(c.title, '') <> '') AS c FROM k)
SELECT line_no::VARCHAR AS video_id, CASE WHEN NOT blank THEN array_to_string(head[1:2], '|') END AS key_concepts, CASE WHEN NOT blank THEN array_to_string(list_transform(c, lambda x: {_STRIP('x.title')}), '|') END AS sections, 'Qwen-like' AS model FROM h""")
def concept_fallback(spark, sf):
    """Enrichment by a model that forgets the concepts, so that they are asked for once more; sections follow the chapters of the prompt."""
    d = table(spark, sf, "dataset").select(F.col("line_no").cast("string").alias("video_id"), "title", F.col("transcript_text").alias("body"), "chapters")
    e = enrich.enrich(d, enrich.EchoModel("Qwen-like", forgetful=True))
    return e.select("video_id", F.array_join("enrichment.key_concepts", "|").alias("key_concepts"), F.array_join(F.transform("enrichment.sections", lambda s: s["heading"]), "|").alias("sections"), "model")


@query(rf"""SELECT doc_id::VARCHAR AS video_id, {_STRIP('text')} AS article, 1 AS chunks, 0 AS fallbacks FROM documents WHERE {_STRIP("coalesce(text, '')")} <> ''""")
def fenced_rewrites(spark, sf):
    """Documents of one chunk rewritten by a model that fences its answers."""
    d = table(spark, sf, "documents").where(X.strip(F.coalesce("text", F.lit(""))) != "")
    text = X.strip(F.col("text"))
    chunk = F.struct(F.lit(0).alias("chunk_idx"), F.lit(None).cast("string").alias("heading"), F.array(text).alias("paragraphs"), text.alias("text"), X.word_count(text).alias("words"))
    out = enrich.rewrite(d.select(F.col("doc_id").cast("string").alias("video_id"), "title", F.array(chunk).alias("chunks")), enrich.EchoModel("qwen echo", fenced=True))
    return out.select("video_id", "article", "chunks", "fallbacks")


@query(r"""WITH q AS (SELECT line_no AS id, 'scrape' AS kind, CASE WHEN line_no % 5 = 0 THEN ' ' ELSE url END AS url, NULL AS transcript, NULL::INT AS lim FROM dataset
  UNION ALL SELECT line_no, 'manual', CASE WHEN line_no % 5 = 0 THEN NULL WHEN line_no % 7 = 0 THEN 'https://elsewhere.example/x' ELSE 'https://tu.example/' || video_id END, CASE WHEN line_no % 3 = 0 THEN ' ' ELSE 'text' END, NULL FROM dataset
  UNION ALL SELECT line_no, CASE WHEN line_no % 2 = 0 THEN 'enrich' ELSE 'rewrite' END, NULL, NULL, (line_no % 4 - 1)::INT FROM dataset UNION ALL SELECT line_no, CASE WHEN line_no % 2 = 0 THEN 'clean' ELSE 'other' END, NULL, NULL, NULL FROM dataset)
SELECT id, kind, CASE WHEN kind = 'scrape' AND coalesce(trim(url), '') = '' THEN 'url required' WHEN kind = 'manual' AND coalesce(trim(url), '') = '' THEN 'url or video id required' WHEN kind = 'manual' AND coalesce(trim(transcript), '') = '' THEN 'transcript is required'
  WHEN kind = 'manual' AND url LIKE '%elsewhere%' THEN 'no video id in ' || url WHEN kind IN ('enrich', 'rewrite') AND lim < 0 THEN 'limit must not be negative' WHEN kind = 'other' THEN 'unknown request' END AS error FROM q""")
def request_errors(spark, sf):
    """Requests of every kind, fine and faulty, with the reason each is refused for."""
    d, no = table(spark, sf, "dataset").select("line_no", "url", "video_id"), F.lit(None).cast("string")
    n = F.col("line_no")
    make = lambda kind, url, transcript, limit: d.select(n.alias("id"), kind.alias("kind"), url.alias("url"), transcript.alias("transcript"), limit.cast("int").alias("limit"))
    paste = F.when(n % 5 == 0, no).when(n % 7 == 0, "https://elsewhere.example/x").otherwise(F.concat(F.lit("https://tu.example/"), F.col("video_id")))
    q = make(F.lit("scrape"), F.when(n % 5 == 0, " ").otherwise(F.col("url")), no, F.lit(None)).unionByName(make(F.lit("manual"), paste, F.when(n % 3 == 0, " ").otherwise("text"), F.lit(None)))
    q = q.unionByName(make(F.when(n % 2 == 0, "enrich").otherwise("rewrite"), no, no, n % 4 - 1)).unionByName(make(F.when(n % 2 == 0, "clean").otherwise("other"), no, no, F.lit(None)))
    return requests.checked(q, hosts=HOSTS, short_hosts=SHORT_HOSTS).select("id", "kind", "error")


@query("""SELECT id, round(coalesce(sum(greatest(coalesce(duration_ms, 0) / 1e5::DOUBLE, 2.0::DOUBLE * (1 + 0.6::DOUBLE * ((id * 37 % 101) / 50.0::DOUBLE - 1)))) OVER (PARTITION BY model, strftime(created_at, '%Y-%m') ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS starts FROM processing_runs""")
def request_pacing(spark, sf):
    """When each request of a model's month begins, at a jittered pace; a longer request delays the next."""
    r = table(spark, sf, "processing_runs").select("id", F.concat_ws(" ", "model", F.date_format("created_at", "yyyy-MM")).alias("run"), (F.col("duration_ms") / 1e5).alias("seconds"), (F.col("id") * 37 % 101 / 50.0 - 1).alias("unit"))
    return resilience.paced(r, "run", "id", "seconds", "unit").select("id", F.round("starts", 6).alias("starts"))


@query(f"""WITH a AS (SELECT model, r.video_id, count(*) AS n, sum(duration_ms) FILTER (WHERE r.status = 'success') AS ms, sum({_N('v.title')}) FILTER (WHERE r.status = 'success') AS tokens FROM processing_runs r JOIN videos v USING (video_id) GROUP BY ALL)
SELECT model, sum(n)::BIGINT AS runs, sum(tokens)::BIGINT AS tokens, CASE WHEN sum(tokens) > 0 AND sum(ms) > 0 THEN sum(tokens) / (sum(ms) * 1e6 / 1e9) END AS per_second FROM a GROUP BY model""")
def model_tokens(spark, sf):
    """The model report with tokens, here the words of each run's title."""
    v = table(spark, sf, "videos").select("video_id", X.word_count(F.col("title")).alias("tokens"))
    runs = table(spark, sf, "processing_runs").select("video_id", "model", "status", "duration_ms")
    uses = runs.groupBy("video_id").agg(F.count("*").alias("uses"))
    joined = weighted_lookup(runs, v.join(uses, "video_id"), ["video_id"], "uses")
    return resilience.model_report(joined).select("model", "runs", "tokens", "per_second")


@query("""WITH l AS (SELECT user_id::VARCHAR AS job_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, count(*) OVER (PARTITION BY user_id) AS m, event_type FROM events)
SELECT job_id, seq, CASE WHEN seq = m THEN 'done' ELSE 'line' END AS event, CASE WHEN seq < m THEN event_type END AS data FROM l WHERE seq > 3""")
def log_events(spark, sf):
    """A stream of log events after a resume position; the last event of each user is the terminal one."""
    e = table(spark, sf, "events")
    n = records.numbered(e.select(F.col("user_id").cast("string").alias("job_id"), "event_type", "ts", "event_id"), "job_id", "ts", "event_id")
    ends = n.groupBy("job_id").agg(F.max("seq").alias("m"))
    folder = own_folder(spark, "log")
    n.join(ends, "job_id").select("job_id", "seq", F.when(F.col("seq") == F.col("m"), jobs.DONE).otherwise(F.col("event_type")).alias("line")).write.json(folder)
    return _streamed(spark, jobs.log_events(jobs.follow_log(spark, folder, 3)))


@query("""SELECT user_id::VARCHAR AS job_id, max(event_id) AS seq, arg_max(event_type, event_id) AS line FROM events GROUP BY user_id""")
def drained_queue(spark, sf):
    """Events drained in micro-batches by a worker that keeps the newest line of each user as a snapshot."""
    folder = own_folder(spark, "queue")
    source = jobs.stream_table(spark, f"{sf}/events.parquet").select(F.col("user_id").cast("string").alias("job_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("line"))
    jobs.drain(source, jobs.snapshot_upsert(f"{folder}/out", "job_id", "seq"), f"{folder}/state").awaitTermination()
    return jobs.latest_snapshot(spark, f"{folder}/out")
