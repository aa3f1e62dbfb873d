import datetime
import decimal
import json
import os
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cuemill.operators import enrich
from cuemill.params import Params
from cuemill.plans import catalog, pipeline
from cuemill.schema import RECORD
from cuemill.sources import readers, sinks
from cuemill.streaming import jobs


def test_stream_equals_batch(spark, small):
    streamed = {r.event_type: (r.events, round(r.value, 4)) for r in catalog.QUERIES["stream_totals"](spark, small).collect()}
    batch = {r.event_type: (r.n, round(r.v, 4)) for r in spark.read.parquet(f"{small}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v")).collect()}
    assert streamed == batch


def test_windows_run_as_a_stream(spark, small, tmp_path):
    source = jobs.stream_table(spark, f"{small}/events.parquet")
    q = jobs.windowed_counts(source, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    batch = jobs.windowed_counts(spark.read.parquet(f"{small}/events.parquet"), "ts", "event_type")
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, batch.collect()))


def test_worker_drains_and_resumes(spark, tmp_path):
    queue, out, state = tmp_path / "queue", tmp_path / "out", tmp_path / "state"
    queue.mkdir()
    schema = "job_id string, seq long, line string"

    def add(n, rows):
        (queue / f"{n}.json").write_text("".join(json.dumps(dict(zip(("job_id", "seq", "line"), r))) + "\n" for r in rows))

    add(1, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")])
    run = lambda: jobs.drain(spark.readStream.schema(schema).json(str(queue)), jobs.snapshot_upsert(str(out), "job_id", "seq"), str(state)).awaitTermination()
    run()
    assert {(r.job_id, r.line) for r in jobs.latest_snapshot(spark, str(out)).collect()} == {("a", "y"), ("b", "z")}
    add(2, [("b", 2, "done")])
    run()
    assert {(r.job_id, r.line) for r in jobs.latest_snapshot(spark, str(out)).collect()} == {("a", "y"), ("b", "done")}
    run()  # nothing new
    log = spark.read.schema(schema).json(str(queue))
    assert {r.job_id: (r.lines, r.finished) for r in jobs.log_status(log).collect()} == {"a": (2, False), "b": (2, True)}
    follow = jobs.follow_log(spark, str(queue), 1).writeStream.format("memory").queryName("follow").option("checkpointLocation", str(tmp_path / "f")).trigger(availableNow=True).start()
    follow.awaitTermination()
    assert {(r.job_id, r.seq) for r in spark.table("follow").collect()} == {("a", 2), ("b", 2)}


def test_record_file_and_sinks(spark, tmp_path):
    f = tmp_path / "dataset.jsonl"
    f.write_text(json.dumps({"video_id": "a", "title": "T", "transcript_segments": [{"text": "x", "start": 1}]}) + "\n\nnot json\n" + json.dumps({"video_id": "b"}) + "\n")
    r = readers.records(spark, str(f), lenient=True).orderBy("video_id").collect()
    assert [x.video_id for x in r if x.video_id] == ["a", "b"] and r[-2].transcript_segments[0].duration is None
    d = spark.createDataFrame([("a", "T", "C", "2024-01-01", "u", 3, "p", "extra")], "video_id string, title string, channel string, published string, url string, word_count int, md_path string, more string")
    sinks.append_manifest(d, str(tmp_path / "m"))
    sinks.append_manifest(d, str(tmp_path / "m"))
    back = spark.read.option("header", True).csv(str(tmp_path / "m"))
    assert back.count() == 2 and back.columns == list(sinks.MANIFEST)
    sinks.append_records(d.select("video_id"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 1
    fail = spark.createDataFrame([("a", "blocked", True), ("b", "failed", False), ("c", "blocked", True)], "video_id string, reason string, transient boolean")
    assert [tuple(x) for x in sinks.failure_report(fail, str(tmp_path / "f")).collect()] == [("blocked", 2, 2), ("failed", 1, 0)]
    assert json.loads(sinks.report_json(d.select("video_id", "word_count")).first().report) == [{"video_id": "a", "word_count": 3}]


def test_documents_round_trip_and_stay_inside(spark, tmp_path):
    docs = spark.createDataFrame([("c/t.md", "body"), ("../../etc/x.md", "evil")], "path string, content string")
    root = tmp_path / "root"
    assert {r.path: r.written for r in sinks.write_documents(docs, str(root)).collect()} == {"c/t.md": True, "../../etc/x.md": False}
    assert {r.path: r.written for r in sinks.write_documents(docs, str(root)).collect()} == {"c/t.md": False, "../../etc/x.md": False}
    (root / "note.txt").write_text("no")
    assert [(r.path, r.content) for r in readers.documents(spark, str(root)).collect()] == [("c/t.md", "body")]


def test_source_list_and_connector(spark, tmp_path):
    f = tmp_path / "list.txt"
    f.write_text("# note\n\n  one  \ntwo\n")
    assert [r.source for r in readers.source_list(spark, str(f)).orderBy("line_no").collect()] == ["one", "two"]
    info = spark.createDataFrame([("", "https://x?v=abc", "T", "20240131", "", "up", None, None), ("id1", None, None, "2024", "ch", "up", "c", "d")], "id string, url string, title string, upload_date string, channel string, uploader string, channel_id string, description string")
    got = {r.video_id: (r.published, r.channel, r.title) for r in readers.normalised_info(info).collect()}
    assert got == {"abc": ("2024-01-31", "up", "T"), "id1": ("2024", "ch", "")}

    def fetch(v):
        if v == "bad":
            raise ValueError("no")
        return {"reason": "blocked"} if v == "wall" else {"segments": [{"text": "t", "start": 0.0, "duration": 1.0}]}

    out = {r.video_id: r for r in readers.fetched(spark.createDataFrame([("ok",), ("bad",), ("wall",)], "video_id string"), fetch).collect()}
    assert out["ok"].segments[0].text == "t" and out["bad"].reason == "failed" and out["wall"].reason == "blocked"
    lists = spark.createDataFrame([(1, ["a", None, "b"]), (2, None)], "k int, entries array<string>")
    assert sorted((r.k, r.entry or "") for r in readers.expanded(lists).collect()) == [(1, "a"), (1, "b"), (2, "")]


def Scripted(*answers):
    """A model that answers from a list, then with the prompt's source; a local class travels to the workers by value."""

    class Model:
        name = "scripted"

        def __init__(self):
            self.answers = list(answers)

        def ping(self):
            return True

        def complete(self, prompt, temperature, limit):
            return self.answers.pop(0) if self.answers else prompt.rsplit("<source>\n", 1)[-1].removesuffix("\n</source>")

    return Model()


def test_rewrite_guard(spark):
    chunk = Row(chunk_idx=0, heading="H", paragraphs=["p"], text="gradient descent learns weights slowly", words=5)
    other = Row(chunk_idx=1, heading="H", paragraphs=["p"], text="second chunk stays whole here", words=5)
    schema = "video_id string, title string, chunks array<struct<chunk_idx:int,heading:string,paragraphs:array<string>,text:string,words:int>>"
    d = spark.createDataFrame([("v", "T", [chunk, other]), ("e", "T", [])], schema)
    got = {r.video_id: r for r in enrich.rewrite(d, Scripted("short", "totally different words are here now", "second chunk stays whole here!")).collect()}
    assert got["v"].article == "## H\n\ngradient descent learns weights slowly\n\nsecond chunk stays whole here!"
    assert (got["v"].chunks, got["v"].fallbacks) == (2, 1)
    assert got["e"].error == "no_prose_to_rewrite" and got["e"].article is None


def test_enrich_errors_and_normalisation(spark):
    d = spark.createDataFrame([("a", "T", "some words"), ("b", "T", " ")], "video_id string, title string, body string")
    got = {r.video_id: r for r in enrich.enrich(d, enrich.EchoModel()).collect()}
    assert got["a"].enrichment.difficulty == "beginner" and got["a"].enrichment.domains == ["general"] and got["b"].error == "no prose"
    assert enrich.enrich(d.where("video_id = 'a'"), Scripted("not json")).first().error == "invalid answer"


def test_pipeline_stops_at_the_first_failure(spark):
    seg = [Row(text="alpha beta gamma delta epsilon", start=4.0 * i, duration=4.0) for i in range(50)]
    row = {f.name: None for f in RECORD.fields} | {"video_id": "a", "title": "T", "channel": "C", "transcript_segments": seg}
    records = spark.createDataFrame([tuple(row[f.name] for f in RECORD.fields)], RECORD).withColumn("line_no", F.lit(1))
    tables = {"records": records, "documents": spark.createDataFrame([], "path string, content string")}
    model = enrich.EchoModel()
    done = pipeline.run_all([pipeline.clean_stage(), pipeline.rewrite_stage(model), pipeline.enrich_stage(model)], tables)
    assert done.ok and done.done == ["clean", "rewrite", "enrich"]
    assert done.tables["enriched"].first().error is None
    assert done.tables["clean_documents"].first().path == "C/T.md"
    foreign = spark.createDataFrame([("C/T.md", 'url: "https://www.youtube.com/watch?v=zzz"')], "path string, content string")
    stopped = pipeline.run_all([pipeline.clean_stage(), pipeline.rewrite_stage(model)], tables | {"documents": foreign})
    assert stopped.failed == "clean" and not stopped.done


def test_admission():
    gate = pipeline.Admission()
    job = gate.start("heavy")
    assert job and gate.start("heavy") is None and gate.start("light")
    gate.finish(job)
    assert gate.start("heavy")


def test_params_from_env(monkeypatch):
    monkeypatch.setenv("CUEMILL_MIN_WORDS", "7")
    monkeypatch.setenv("CUEMILL_MIN_RATIO", "0.5")
    assert Params.from_env() == Params(min_words=7, min_ratio=0.5)


def test_a_broken_record_fails_the_scan_unless_it_may_be_dropped(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"video_id": "a"}\n{"video_id": \n')
    assert [x.video_id for x in readers.records(spark, str(tmp_path / "r.jsonl"), lenient=True).collect() if x.video_id] == ["a"]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.records(spark, str(tmp_path / "r.jsonl")).collect()


def test_documents_never_leave_their_folder_and_are_written_once(spark, tmp_path):
    rows = [("a/b c+d%.md", "one"), ("../out.md", "two"), ("/etc/three.md", "three"), ("a/../e.md", "four"), ("n.md", None)]
    d = spark.createDataFrame(rows, "path string, content string")
    first = {r.path: r.written for r in sinks.write_documents(d, f"file:{tmp_path}/docs").collect()}
    assert first == {"a/b c+d%.md": True, "../out.md": False, "/etc/three.md": False, "a/../e.md": True, "n.md": True}
    assert not any(r.written for r in sinks.write_documents(d.where("path LIKE 'a/%'"), f"{tmp_path}/docs").collect())
    assert {(r.path, r.content) for r in readers.documents(spark, f"{tmp_path}/docs").where("content <> ''").collect()} == {("a/b c+d%.md", "one"), ("e.md", "four")}
    assert not (tmp_path / "out.md").exists()


def test_concepts_are_asked_for_once_more(spark):
    d = spark.createDataFrame([("a", "T", "some words here", [Row(title=" One ", start_time=0.0, end_time=1.0), Row(title=None, start_time=0.0, end_time=1.0)])], "video_id string, title string, body string, chapters array<struct<title:string,start_time:double,end_time:double>>")
    e = enrich.enrich(d, enrich.EchoModel(forgetful=True)).first().enrichment
    assert list(e.key_concepts) == ["some", "words"] and [s.heading for s in e.sections] == ["One"]
    summary = json.dumps({"summary": "s", "key_concepts": [], "domains": [], "difficulty": "x", "content_kind": "y", "sections": []})
    assert list(enrich.enrich(d, Scripted(summary, "no json")).first().enrichment.key_concepts) == []


def test_rewrites_lose_their_fences_and_models_get_their_prefix(spark):
    assert enrich.unfenced("```md\nx\n```") == "x" and enrich.unfenced("a ```b```") == "a ```b```"
    assert enrich.prefix_of("Qwen3:4b") == "/no_think\n" and enrich.prefix_of("gemma") == ""
    chunk = Row(chunk_idx=0, heading=None, paragraphs=["p"], text="every word of this chunk stays", words=6)
    d = spark.createDataFrame([("v", "T", [chunk])], "video_id string, title string, chunks array<struct<chunk_idx:int,heading:string,paragraphs:array<string>,text:string,words:int>>")
    r = enrich.rewrite(d, enrich.EchoModel(fenced=True)).first()
    assert (r.article, r.fallbacks) == ("every word of this chunk stays", 0)


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(f"{float(v):.9g}")
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_every_query_equals_its_sql(spark, small, name):
    df = catalog.QUERIES[name](spark, small)
    assert df.columns == list(dict.fromkeys(df.columns))
    rows, columns = df.collect(), sorted(df.columns)
    if name not in catalog.SQL:
        return
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for f in os.listdir(small):
        db.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{small}/{f}'")
    found = db.execute(catalog.SQL[name])
    named = [c[0] for c in found.description]
    assert sorted(named) == columns
    expected = Counter(tuple(_plain(r[named.index(c)]) for c in columns) for r in found.fetchall())
    assert Counter(tuple(_plain(r[c]) for c in columns) for r in rows) == expected
