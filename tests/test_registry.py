import datetime as dt

import pytest
from pyspark.sql import functions as F

from cuemill.operators import records, registry, resilience, search, transitions
from cuemill.schema import VIDEOS

def NOW():
    return F.lit("2026-01-01").cast("timestamp")


COLUMNS = [f.name for f in VIDEOS.fields]


def videos(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], VIDEOS)


def incoming(spark, *rows):
    names = ["video_id", "url", "channel", "channel_id", "published", "title", "description", "word_count", "status", "raw_path"]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], ", ".join(f"{c} {'int' if c == 'word_count' else 'string'}" for c in names))


def test_upsert(spark):
    old = videos(spark, {"video_id": "a", "title": "old", "status": "ingested", "raw_path": "p", "topic": "t", "language": "de"}, {"video_id": "b", "title": "keep", "status": "raw"})
    new = incoming(spark, {"video_id": "a", "title": "new", "status": "raw", "raw_path": "q", "channel": "c"}, {"video_id": "n", "title": "x", "published": "", "channel": "c", "url": "u"})
    got = {r.video_id: r for r in registry.upsert_videos(old, new, NOW()).collect()}
    assert (got["a"].title, got["a"].status, got["a"].raw_path, got["a"].topic, got["a"].language) == ("new", "raw", "p", "t", "de")
    assert got["a"].updated_at == dt.datetime(2026, 1, 1)
    assert (got["b"].title, got["b"].updated_at) == ("keep", None)
    assert (got["n"].language, got["n"].status, got["n"].tags, got["n"].published_date, got["n"].enrichment_status) == ("en", "raw", [], None, "pending")


def test_update_is_audited_even_when_unchanged(spark):
    old = videos(spark, {"video_id": "a", "title": "t", "tags": ["x"]})
    changes = spark.createDataFrame([("a", "t", ["y", "z"]), ("missing", "q", None)], "video_id string, title string, tags array<string>")
    snapshot, audit, missing = registry.update_videos(old, changes, ["title", "tags"], NOW())
    assert snapshot.first().tags == ["y", "z"]
    assert {(r.field_name, r.old_value, r.new_value) for r in audit.collect()} == {("title", "t", "t"), ("tags", '["x"]', '["y", "z"]')}
    assert [r.video_id for r in missing.collect()] == ["missing"]
    for bad in (["url"], ["nonsense"], ["enrichment_status"]):
        with pytest.raises(ValueError):
            registry.check_fields(bad)


def test_sections_keep_a_stale_tail(spark):
    s = "video_id string, idx int, heading string, summary string, start_ts double, end_ts double"
    old = spark.createDataFrame([("v", 0, "a", None, None, None), ("v", 1, "b", None, None, None)], s)
    new = spark.createDataFrame([("v", 0, "A", "s", 1.0, 2.0)], s)
    assert sorted((r.idx, r.heading) for r in registry.upsert_sections(old, new).collect()) == [(0, "A"), (1, "b")]
    assert registry.upsert_sections(old, new.limit(0)).count() == 2


def test_queue_order_and_limit(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [
        {"video_id": "late", "status": "cleaned", "rewrite_status": "pending", "created_at": day(3)},
        {"video_id": "tie2", "status": "ingested", "rewrite_status": "failed", "created_at": day(1)},
        {"video_id": "tie1", "status": "ingested", "rewrite_status": "failed", "created_at": day(1)},
        {"video_id": "done", "status": "ingested", "rewrite_status": "done", "created_at": day(1)},
        {"video_id": "raw", "status": "raw", "rewrite_status": "pending", "created_at": day(1)},
    ]
    v = videos(spark, *rows)
    assert [r.video_id for r in registry.pending(v, "rewrite_status").collect()] == ["tie1", "tie2", "late"]
    assert [r.video_id for r in registry.pending(v, "rewrite_status", 1).collect()] == ["tie1"]


def test_search(spark):
    v = videos(
        spark,
        {"video_id": "a", "title": "Measured diagrams", "channel": "Alpha Talks", "tags": ["x", "y"], "status": "ingested"},
        {"video_id": "b", "title": "measuring", "description": "A diagram", "channel": "beta", "tags": ["x"], "status": "raw"},
        {"video_id": "c", "channel": "alphabet"},
    )
    ids = lambda **k: [r.video_id for r in search.search(v, **k).collect()]
    assert ids(query="measure the diagrams") == ["a", "b"]
    assert ids(query="the of") == []
    assert ids(channel="ALPHA") == ["a", "c"]
    assert ids(tags=["x", "y"]) == ["a"]
    assert ids(status="raw", channel="") == ["b"]
    assert ids(limit=1, offset=1) == ["b"]


def test_clean_transition_table(spark):
    cases = [  # status, queue, exists, requeue -> status, queue, queued
        ("ingested", "done", True, False, "ingested", "done", False), ("ingested", "failed", True, False, "ingested", "failed", True),
        ("ingested", None, True, False, "ingested", "pending", True), ("ingested", "done", True, True, "ingested", "pending", True),
        ("raw", "pending", True, False, "cleaned", "pending", True), (None, None, False, True, "cleaned", "pending", True),
    ]
    d = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, status string, queue string, there boolean, requeue boolean")
    t = transitions.clean_row(F.col("status"), F.col("queue"), F.col("there"), F.col("requeue"))
    got = {r.i: (r.s, r.q, r.d) for r in d.select("i", t["status"].alias("s"), t["queue"].alias("q"), t["queued"].alias("d")).collect()}
    assert got == {i: c[4:] for i, c in enumerate(cases)}


def test_ingest_transition_table(spark):
    cases = [("cleaned", None, "updated", "ingested", "d"), ("ingested", "x", "updated", "ingested", "d"), ("ingested", "d", "unchanged", "ingested", "d"), ("archived", None, "error", "archived", None), (None, None, "error", None, None)]
    d = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, status string, path string")
    t = transitions.ingest_row(F.col("status"), F.col("path"), F.lit("d"), F.lit(False))
    got = {r.i: (r.o, r.s, r.p) for r in d.select("i", t["outcome"].alias("o"), t["status"].alias("s"), t["clean_path"].alias("p")).collect()}
    assert got == {i: c[2:] for i, c in enumerate(cases)}


def test_identity_gate(spark):
    doc = lambda v: f'---\nurl: "https://www.youtube.com/watch?v={v}"\n---\n'
    rows = spark.createDataFrame([("a", "p1", "x"), ("b", "p2", "x"), ("c", "p3", None), ("d", "p4", "x"), ("e", "p5", "x")], "video_id string, path string, cleaned string")
    docs = spark.createDataFrame([("p1", doc("a")), ("p2", doc("z")), ("p5", "no id")], "path string, content string")
    assert {r.video_id: r.outcome for r in transitions.clean_outcomes(rows, docs).collect()} == {"a": "skipped", "b": "error", "c": "filtered", "d": "saved", "e": "error"}
    files = transitions.ingest_files(spark.createDataFrame([("p1", doc("a")), ("p2", doc("b")), ("p9", doc("n")), ("p8", "none")], "path string, content string"), docs)
    assert {r.path: r.action for r in files.collect()} == {"p1": "keep", "p2": "error", "p9": "copy", "p8": "error"}


@pytest.mark.parametrize("outcomes,kept,aborted", [("bbb", 3, True), ("bbsbo", 4, True), ("bbobb", 5, False), ("bbfbb", 5, False), ("sss", 3, False), ("obbbbb", 4, True)])
def test_circuit_breaker(spark, outcomes, kept, aborted):
    names = {"b": "blocked", "s": "skipped", "o": "ok", "f": "no_transcript"}
    d = spark.createDataFrame([(1, i, names[c]) for i, c in enumerate(outcomes)], "run int, i int, outcome string")
    got = resilience.circuit_breaker(d, "run", "i", "outcome").orderBy("i").collect()
    assert (len(got), any(r.aborted for r in got)) == (kept, aborted)


def test_backoff_and_rates(spark):
    assert [r[0] for r in spark.range(6).select(resilience.backoff_seconds(F.col("id"))).collect()] == [5.0, 15.0, 45.0, 135.0, 300.0, 300.0]
    assert spark.range(1).select(resilience.tokens_per_second(F.lit(10), F.lit(2e9))).first()[0] == 5.0
    assert spark.range(1).select(resilience.tokens_per_second(F.lit(0), F.lit(2e9))).first()[0] is None


def test_records(spark):
    d = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, None), ("", 4, "q"), (None, 5, "q")], "video_id string, line_no int, title string")
    assert {r.video_id: (r.title, r.first_at) for r in records.last_wins(d, "video_id", "line_no").collect()} == {"a": (None, 1), "b": ("y", 2)}
    assert {r.video_id: r.title for r in records.first_wins(d, "video_id", "line_no").collect()} == {"a": "x", "b": "y"}
    t = spark.createDataFrame([("v", 0, "de", True), ("v", 1, "fr", False), ("v", 2, "en", True), ("w", 0, "de", True), ("w", 1, "it", False)], "k string, pos int, language string, generated boolean")
    assert {r.k: r.language for r in records.choose_track(t, "k", "en").collect()} == {"v": "en", "w": "it"}
    p = spark.range(1).select(records.output_path(F.lit("../.."), F.lit("outside/title")).alias("p")).first().p
    assert p == "..../outsidetitle.md"
    jobs = spark.createDataFrame([(i, "running" if i == 0 else "done", i) for i in range(30)], "job_id int, status string, started int")
    assert sorted(r.job_id for r in records.retained_jobs(jobs, 20).collect()) == [0, *range(10, 30)]
