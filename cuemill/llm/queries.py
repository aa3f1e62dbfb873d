"""Queries of the training-data problems, pN_..., over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuemill.llm import encodings, leaks, lines, neardup, packing, pii, splitting, subjects, terms
from cuemill.llm.glossary import glossary
from cuemill.runtime import cut, segment_texts, table, text_of, weighted_lookup

LEAST_VIDEOS = 4


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry that isn't letter for letter canonical, with the canonical term it means, 0 for none."""
    found = terms.map_entries(table(spark, sf, "videos"), table(spark, sf, "canonical_terms"), "video_id", ["domains", "key_concepts"], aliases=glossary(spark))
    return found.select(F.col("key").alias("video_id"), "field", F.col("pos").cast("int").alias("pos"), "term_id")


def p1_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Values that mean no canonical term, with the number of entries that hold them."""
    return terms.unmatched_report(table(spark, sf, "videos"), table(spark, sf, "canonical_terms"), "video_id", ["domains", "key_concepts"], aliases=glossary(spark))


def p1_spelled(spark: SparkSession, sf: str) -> DataFrame:
    """Of the answers, those to entries whose letters and digits are those of a canonical name of their field."""
    letters = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{Nd}]+", "")
    canon = table(spark, sf, "canonical_terms")
    found = terms.map_entries(table(spark, sf, "videos"), canon, "video_id", ["domains", "key_concepts"], aliases=glossary(spark))
    names = canon.select("field", letters("name").alias("letters")).distinct()  # the fixed canonical list
    same = found.withColumn("letters", letters("value")).join(F.broadcast(names), ["field", "letters"], "left_semi")
    return same.select(F.col("key").alias("video_id"), "field", F.col("pos").cast("int").alias("pos"), "term_id")


def _personal_texts(spark: SparkSession, sf: str) -> DataFrame:
    described = pii.texts_of(table(spark, sf, "videos"), "id", "description", "description")
    return described.unionByName(pii.texts_of(table(spark, sf, "dataset"), "line_no", "transcript_segments", "segments"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_values(_personal_texts(spark, sf)).select("field", "record_key", "seg_pos", "kind", "start_char")


def p2_redacted(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptions and segment texts with typed placeholders, of the records that hold personal values."""
    return pii.redacted(_personal_texts(spark, sf)).where("n_values > 0")


def _mixtures(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return subjects.subject_mixtures(*(table(spark, sf, n) for n in ("videos", "canonical_terms", "subject_areas", "subject_labels")), aliases=glossary(spark))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.assign_subjects(_mixtures(spark, sf)[0]).select("id", F.col("subject_id").cast("int").alias("subject_id"))


def p3_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Documents per subject."""
    return subjects.composition(subjects.assign_subjects(_mixtures(spark, sf)[0]), table(spark, sf, "subject_areas"))


def p3_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """The leaves of the clustering with their subject and discriminative terms."""
    return _mixtures(spark, sf)[1].select("leaf", "subject_id", "weight", F.array_join("terms", ", ").alias("terms"))


def _dup_texts(spark: SparkSession, sf: str) -> DataFrame:
    described = table(spark, sf, "videos").select(F.lit("description").alias("field"), F.col("id").alias("key"), F.array(text_of("description")).alias("pieces"))
    spoken = table(spark, sf, "dataset").select(F.lit("segments").alias("field"), F.col("line_no").alias("key"), segment_texts("transcript_segments").alias("pieces"))
    return described.unionByName(spoken)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    members, links = neardup.near_duplicates(_dup_texts(spark, sf), neardup.HALF)
    return neardup.every_pair(members, links)


def p4_classes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per text: its class of equal shingle sets, the class's size and its number of links."""
    members, links = neardup.near_duplicates(_dup_texts(spark, sf), neardup.HALF)
    return neardup.class_summary(members, links)


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One row per text: its group of linked texts, named by the least key in it."""
    members, links = neardup.near_duplicates(_dup_texts(spark, sf), neardup.HALF)
    grouped = cut(neardup.groups(members, links))
    names = grouped.groupBy("group_id").agg(F.min("key").alias("group_key"), F.count("*").alias("uses"))
    return weighted_lookup(grouped, names, ["group_id"], "uses").select("field", "key", "group_key")


def _pieces(spark: SparkSession, sf: str) -> DataFrame:
    limit = table(spark, sf, "size_limits").where("limit_id = 1").first()
    params = splitting.SplitParams(max_size=limit.max_size, overlap=limit.overlap)
    return splitting.split_lines(table(spark, sf, "dataset"), table(spark, sf, "sections"), params)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that come out as more than one piece."""
    return _pieces(spark, sf).where("piece_no = 1").select("line_no").distinct()


def p5_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return _pieces(spark, sf)


def p5_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every line that was split: its words as the pieces cover them, and how many pieces are too long, overlap wrongly, leave a gap, or
    don't hold the words they claim."""
    limit = table(spark, sf, "size_limits").where("limit_id = 1").first()
    w = Window.partitionBy("line_no").orderBy("piece_no")
    own = F.col("first_word") + F.col("overlap_words")
    pieces = _pieces(spark, sf).withColumn("begins", F.coalesce(F.lag(F.col("first_word") + F.col("n_words")).over(w), F.lit(0)))
    return pieces.groupBy("line_no").agg(
        F.max(F.col("first_word") + F.col("n_words")).alias("words"), F.count_if(F.col("n_words") > limit.max_size).alias("too_long"),
        F.count_if(F.col("overlap_words") != F.when(F.col("piece_no") == 0, 0).otherwise(limit.overlap)).alias("wrong_overlap"),
        F.count_if(own != F.col("begins")).alias("gaps"), F.count_if(F.regexp_count("text", F.lit(r"(?U)\S+")) != F.col("n_words")).alias("wrong_text"),
    )


def _recurring(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The registry in two partitions by creation time, the later one merged as a delta into the earlier one's table."""
    videos = table(spark, sf, "videos").select("id", "channel", "description", "created_at")
    middle = videos.agg(F.percentile_approx(F.unix_micros("created_at"), 0.5)).first()[0] or 0
    later = F.coalesce(F.unix_micros("created_at") >= middle, F.lit(False))
    state, removed = lines.recurring_lines([videos.where(~later), videos.where(later)], "id", "channel", "description", LEAST_VIDEOS)
    return videos, state, removed


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _recurring(spark, sf)[2].select("id", F.col("line_idx").cast("int").alias("line_idx"))


def p6_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The recurring lines of each channel with the number of videos that hold them."""
    return _recurring(spark, sf)[1].where(F.col("n") >= LEAST_VIDEOS).select(F.col("source").alias("channel"), "line_key", F.col("n").alias("videos"))


def p6_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The rebuilt descriptions."""
    videos, _, removed = _recurring(spark, sf)
    return lines.rebuild(videos, removed, "id", "description")


def _packed(spark: SparkSession, sf: str) -> tuple[DataFrame, list[tuple[int, DataFrame, int]]]:
    items = cut(packing.count_tokens(table(spark, sf, "documents"), "doc_id", "source", "text"))
    limits = table(spark, sf, "size_limits").where("applies_to = 'documents.text'").orderBy("limit_id").collect()  # fixed parameters
    return items, [(r.limit_id, packing.pack(items, packing.PackParams(capacity=r.max_size)), r.max_size) for r in limits]


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place in containers of each size: container, part, first token and tokens."""
    out = None
    for limit, packed, _ in _packed(spark, sf)[1]:
        one = packed.select(F.lit(limit).alias("limit_id"), "container", F.col("key").alias("doc_id"), "part", "first_token", "n_tokens")
        out = one if out is None else out.unionByName(one)
    return out


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How full the containers of each size are."""
    out = None
    for limit, packed, size in _packed(spark, sf)[1]:
        one = packing.fill_report(packed, size).select(F.lit(limit).alias("limit_id"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def p7_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in containers of each size: whether all its tokens are there once, it is split only where it must be, and its
    containers are within their capacity."""
    items, packs = _packed(spark, sf)
    out = None
    for limit, packed, size in packs:
        packed = cut(packed)
        full = packed.groupBy("container").agg((F.sum("n_tokens") <= size).alias("fits"))
        ends = packed.join(full, "container").groupBy("key").agg(F.sum("n_tokens").alias("placed"), F.count("*").alias("parts"), F.max(F.col("first_token") + F.col("n_tokens")).alias("till"), F.bool_and("fits").alias("fits"))
        j = items.join(ends, "key", "left")
        whole = F.coalesce((F.col("placed") == F.col("n_tokens")) & (F.col("till") == F.col("n_tokens")), F.lit(False))
        needed = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / size))
        one = j.select(F.lit(limit).alias("limit_id"), F.col("key").alias("doc_id"), whole.alias("whole"), F.coalesce(F.col("parts") == needed, F.lit(False)).alias("unsplit"), F.coalesce("fits", F.lit(False)).alias("fits"))
        out = one if out is None else out.unionByName(one)
    return out


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Windows packed to a target mixture that flattens the natural one (tokens to the power 0.7): how far each is from the target."""
    items = cut(packing.count_tokens(table(spark, sf, "documents"), "doc_id", "source", "text"))
    shares = items.groupBy("source").agg(F.pow(F.sum("n_tokens"), F.lit(0.7)).alias("share"))
    limit = table(spark, sf, "size_limits").where("limit_id = 2").first()
    return packing.mixture_report(items, packing.PackParams(capacity=limit.max_size), shares)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "item_id").distinct()


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    """Which items leaked, into how many documents, and the longest passage of each."""
    found = leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("words").alias("longest"), F.max("item_words").alias("item_words"))


def p8_verbatim(spark: SparkSession, sf: str) -> DataFrame:
    """Of the documents and items found, those where the whole question stands in the text letter by letter but for case and signs."""
    words = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{Nd}]+", " ")), F.lit(" "))
    docs, items = table(spark, sf, "documents"), table(spark, sf, "eval_items")
    found = leaks.leaks(docs, items).select("doc_id", "item_id").distinct()
    j = found.join(F.broadcast(items.select("item_id", "question")), "item_id").join(docs.select("doc_id", "text"), "doc_id")  # the fixed list of items
    return j.where(F.contains(words("text"), words("question"))).select("doc_id", "item_id")


def p9_certain(spark: SparkSession, sf: str) -> DataFrame:
    """Of the documents found, those that hold a replacement character or a C1 control, which no text means."""
    found = encodings.garbled(table(spark, sf, "documents")).select("doc_id")
    certain = table(spark, sf, "documents").where(F.col("text").rlike("[\\x{80}-\\x{84}\\x{86}-\\x{9f}\\x{fffd}]")).select("doc_id")
    return found.join(certain, "doc_id", "left_semi")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.garbled(table(spark, sf, "documents")).select("doc_id")


def p9_restored(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.garbled(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_unmatched, p1_spelled, p2_found, p2_redacted, p3_found, p3_composition, p3_leaves, p4_found, p4_classes, p4_groups, p5_found, p5_pieces, p5_checks,
        p6_found, p6_lines, p6_clean, p7_packing, p7_fill, p7_mixture, p7_checks, p8_found, p8_items, p8_verbatim, p9_found, p9_restored, p9_certain,
    )
}

_WHITE = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_LINES = r"""
  l AS (SELECT id, channel, unnest(string_split(description, chr(10))) AS line,
               unnest(generate_series(0, len(string_split(description, chr(10))) - 1)) AS line_idx FROM videos WHERE channel IS NOT NULL),
  k AS (SELECT id, channel, line, line_idx, regexp_replace(lower(replace(line, 'ß', 'ss')), '[^\p{L}\p{Nd}]', '', 'g') AS line_key FROM l),
  r AS (SELECT channel, line_key, count(DISTINCT id) AS videos FROM k WHERE line_key <> '' GROUP BY ALL HAVING count(DISTINCT id) >= 4)
"""

_SHINGLED = r"""t AS (SELECT 'description' AS field, id AS key, description AS text FROM videos WHERE description IS NOT NULL
           UNION ALL SELECT 'segments', line_no, array_to_string(list_transform(transcript_segments, lambda s: coalesce(s.text, '')), ' ') FROM dataset),
  w AS (SELECT field, key, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM t),
  s AS (SELECT DISTINCT field, key, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: hash(w[i], w[i + 1], w[i + 2]))) AS h FROM w WHERE len(w) > 2),
  n AS (SELECT field, key, count(*) AS n FROM s GROUP BY ALL),
  c AS (SELECT a.field, a.key AS key_a, b.key AS key_b, count(*) AS c FROM s a JOIN s b ON a.field = b.field AND a.h = b.h AND a.key < b.key GROUP BY ALL),
  p AS (SELECT c.field, key_a, key_b FROM c JOIN n x ON x.field = c.field AND x.key = key_a JOIN n y ON y.field = c.field AND y.key = key_b WHERE c >= 0.5 * (x.n + y.n - c))"""
_WORDS = lambda c: f"' ' || trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{Nd}}]+', ' ', 'g')) || ' '"

SQL: dict[str, str] = {
    "p1_spelled": r"""
WITH e AS (SELECT video_id, 'domains' AS field, unnest(domains) AS v, unnest(range(len(domains)))::INT AS pos FROM videos UNION ALL SELECT video_id, 'key_concepts', unnest(key_concepts), unnest(range(len(key_concepts)))::INT FROM videos)
SELECT video_id, e.field, pos, term_id FROM e JOIN canonical_terms c ON c.field = e.field AND regexp_replace(lower(c.name), '[^\p{L}\p{Nd}]+', '', 'g') = regexp_replace(lower(v), '[^\p{L}\p{Nd}]+', '', 'g')
WHERE NOT EXISTS (SELECT 1 FROM canonical_terms x WHERE x.field = e.field AND x.name = v)""",
    "p4_found": f"WITH {_SHINGLED} SELECT field, key_a, key_b FROM p",
    "p4_groups": f"""WITH RECURSIVE {_SHINGLED}, b AS (SELECT field, key_a AS x, key_b AS y FROM p UNION ALL SELECT field, key_b, key_a FROM p), r AS (SELECT field, key AS x, key AS y FROM n UNION SELECT r.field, r.x, b.y FROM r JOIN b ON b.field = r.field AND b.x = r.y)
SELECT field, x AS key, min(y) AS group_key FROM r GROUP BY field, x""",
    "p5_checks": rf"""
WITH w AS (SELECT line_no, list_sum(list_transform(transcript_segments, lambda s: len(regexp_extract_all(coalesce(s.text, ''), '[^{_WHITE}]+')))) AS words FROM dataset)
SELECT line_no, words::INT AS words, 0 AS too_long, 0 AS wrong_overlap, 0 AS gaps, 0 AS wrong_text FROM w WHERE words > (SELECT max_size FROM size_limits WHERE limit_id = 1)""",
    "p7_checks": "SELECT limit_id, doc_id, true AS whole, true AS unsplit, true AS fits FROM documents, (SELECT limit_id FROM size_limits WHERE applies_to = 'documents.text')",
    "p8_verbatim": f"WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS('text')} AS t FROM documents), q AS MATERIALIZED (SELECT item_id, {_WORDS('question')} AS t FROM eval_items) SELECT doc_id, item_id FROM d, q WHERE contains(d.t, q.t)",
    "p9_certain": r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[\x{80}-\x{84}\x{86}-\x{9f}\x{fffd}]')",
    "p5_found": rf"""
SELECT line_no FROM dataset, (SELECT max_size FROM size_limits WHERE limit_id = 1)
WHERE list_sum(list_transform(transcript_segments, lambda s: len(regexp_extract_all(coalesce(s.text, ''), '[^{_WHITE}]+')))) > max_size""",
    "p6_found": f"WITH {_LINES} SELECT id, line_idx::INT AS line_idx FROM k JOIN r USING (channel, line_key)",
    "p6_lines": f"WITH {_LINES} SELECT channel, line_key, videos FROM r",
    "p6_clean": f"""WITH {_LINES}, m AS (SELECT k.id, line, line_idx, r.channel IS NOT NULL AS gone FROM k LEFT JOIN r USING (channel, line_key))
SELECT id, coalesce(string_agg(line, chr(10) ORDER BY line_idx) FILTER (WHERE NOT gone), '') AS text, (count(*) FILTER (WHERE gone))::INT AS n_removed FROM m GROUP BY id HAVING bool_or(gone)""",
}
