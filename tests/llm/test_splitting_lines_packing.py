import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cuemill.llm import lines, packing, splitting

SEG = "array<struct<text:string,start:double,duration:double>>"
LINES = f"line_no long, video_id string, transcript_segments {SEG}, text string, sections int"


def talk(n, words=7, seed=0):
    rnd = random.Random(seed)
    topics = [["stone", "river", "delta", "sediment"], ["guitar", "chorus", "melody", "tempo"], ["flour", "yeast", "oven", "dough"]]
    at, out = 0.0, []
    for i in range(n):
        pool = topics[i * 3 // n]
        out.append(Row(text=" ".join(rnd.choice(pool) for _ in range(words)) + ("." if i % 4 == 3 else ""), start=at, duration=2.0 if i % 5 else None))
        at += 2.0 + (6.0 if i % 40 == 39 else 0.0)
    return out


@pytest.fixture(scope="module")
def long_lines(spark):
    rows = [
        (1, "v1", talk(300), "x", 1), (2, "v1", talk(20), "x", 1), (3, None, talk(300, seed=2), "x", 1), (4, "v2", None, "x", 1), (5, "v2", [None, Row(text=None, start=None, duration=None)], "x", 1),
        (6, "v2", [Row(text="w " * 1000, start=None, duration=None)], "x", 1), (7, "v2", [Row(text="one two.  Three " * 400, start=0.0, duration=9.0)], "x", 1),
    ]
    return spark.createDataFrame(rows, LINES)


@pytest.fixture(scope="module")
def pieces(spark, long_lines):
    sections = spark.createDataFrame([("v1", 0, 0.0), ("v1", 1, 300.0), ("v1", 2, None), (None, 0, 5.0)], "video_id string, idx int, start_ts double")
    return splitting.split_lines(long_lines, sections).orderBy("line_no", "piece_no").collect()


def test_split_covers_every_word_once(long_lines, pieces):
    words = {r.line_no: " ".join((s.text if s and s.text else "") for s in r.transcript_segments or []).split() for r in long_lines.collect()}
    assert {p.line_no for p in pieces} == {k for k, w in words.items() if len(w) > 900} == {1, 3, 6, 7}
    for k in (1, 3, 6, 7):
        own = [p for p in pieces if p.line_no == k]
        assert [p.piece_no for p in own] == list(range(len(own)))
        back = []
        for p in own:
            w = p.text.split()
            assert len(w) == p.n_words <= 900
            assert p.overlap_words == (40 if p.piece_no else 0)
            assert w == words[k][p.first_word : p.first_word + p.n_words]
            back += w[p.overlap_words :]
        assert back == words[k]


def test_cuts_are_natural(pieces):
    first = [p for p in pieces if p.line_no == 1]
    assert any(p.cut in ("section", "pause", "sentence") for p in first) and first[-1].cut == "end"
    assert {p.cut for p in pieces if p.line_no == 6} == {"word", "end"}


def test_cut_falls_on_the_topic_change():
    words = ["stone", "river"] * 120 + ["guitar", "melody"] * 120
    marks = {i: (0.0, "segment") for i in range(10, 480, 10)}
    cuts = splitting.choose_cuts(words, marks, splitting.SplitParams(max_size=300, overlap=10))
    assert cuts[0] == (240, "segment")


def test_sections_with_fractional_times_open_their_own_segment(spark):
    # all words are the same, so that only the section tells where to cut
    said = [Row(text="w w w w w w w", start=2.3 * i, duration=2.3) for i in range(200)]
    for at in (90, 97, 102, 111):  # 207.0, 223.1, 234.6 and 255.3 seconds
        sections = spark.createDataFrame([("v", 2.3 * at)], "video_id string, start_ts double")
        first = splitting.split_lines(spark.createDataFrame([(1, "v", said, "x", 1)], LINES), sections).where("piece_no = 0").first()
        assert (first.cut, first.n_words) == ("section", 7 * at)


def test_split_parameters_and_empty(spark, long_lines):
    none = spark.createDataFrame([], "video_id string, start_ts double")
    assert splitting.split_lines(long_lines.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        splitting.split_lines(long_lines, none, splitting.SplitParams(max_size=10, overlap=10))


DOCS = "id long, channel string, description string, line_idx string, n int"


@pytest.fixture(scope="module")
def described(spark):
    rows = [(i, "c", f"own line {i}\n– Subscribe to C!\n\n***\nGrüße", "x", 1) for i in range(3)]
    rows += [(3, "c", "SUBSCRIBE, to c\nGRÜSSE", "x", 1), (4, "d", "Subscribe to C", "x", 1), (5, None, "Subscribe to C", "x", 1), (6, "c", None, "x", 1), (7, "c", "", "x", 1), (8, "c", "twice\ntwice\ntwice\ntwice", "x", 1), (0, "c", "own line 0\n– Subscribe to C!\n\n***\nGrüße", "x", 1)]
    return spark.createDataFrame(rows, DOCS)


def test_recurring_lines(described):
    state, removed = lines.recurring_lines([described], "id", "channel", "description", 4)
    assert {(r.id, r.line_idx) for r in removed.collect()} == {(0, 1), (1, 1), (2, 1), (3, 0), (0, 4), (1, 4), (2, 4), (3, 1)}
    assert {r.line_key: r.n for r in state.where("n >= 4").collect()} == {"subscribetoc": 4, "grüsse": 4}
    texts = {r.id: (r.text, r.n_removed) for r in lines.rebuild(described.dropDuplicates(["id"]), removed, "id", "description").collect()}
    assert texts[0] == ("own line 0\n\n***", 2) and texts[3] == ("", 2) and 4 not in texts


def test_deltas_give_what_one_pass_gives(described):
    once = {tuple(r) for r in lines.recurring_lines([described], "id", "channel", "description", 4)[1].collect()}
    parts = [described.where("id % 3 = 0"), described.where("id % 3 = 1"), described.where("id % 3 = 2 OR id IS NULL")]
    state, removed = lines.recurring_lines(parts, "id", "channel", "description", 4)
    assert {tuple(r) for r in removed.collect()} == once
    assert {(r.source, r.line_key, r.n) for r in state.collect()} == {(r.source, r.line_key, r.n) for r in lines.recurring_lines([described], "id", "channel", "description", 4)[0].collect()}


def test_only_newly_crossed_documents_are_touched(described):
    old = lines.line_rows(described.where("id < 3"), "id", "channel", "description")
    state, hits = lines.advance(described.sparkSession.createDataFrame([], lines.STATE), old, 4)
    assert hits.count() == 0 and max(len(r.places) for r in state.collect()) == 3
    state, hits = lines.advance(state, lines.line_rows(described.where("id = 3"), "id", "channel", "description"), 4)
    assert {r.id for r in hits.collect()} == {0, 1, 2, 3}
    assert all((r.places is None) == (r.n >= 4) for r in state.collect())
    assert lines.advance(state, old.limit(0), 4)[1].count() == 0


def test_a_stored_state_goes_on_where_it_was_and_counts_no_partition_twice(spark, described, tmp_path):
    args = ("id", "channel", "description")
    lines.LineStore(spark, str(tmp_path), 4).merge("a", described.where("id < 3"), *args)
    again = lines.LineStore(spark, str(tmp_path), 4)
    again.merge("a", described.where("id < 3"), *args)
    assert len(again.versions()) == 1 and again.removed().count() == 0
    again.merge("b", described.where("id >= 3"), *args)
    assert {(r.id, r.line_idx) for r in again.removed().collect()} == {(0, 1), (1, 1), (2, 1), (3, 0), (0, 4), (1, 4), (2, 4), (3, 1)}


def test_a_hot_line_of_a_hot_source(spark):
    """A third of all documents share one source and one line."""
    docs = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('s', id % 50)) AS channel", "concat('always the same', '\n', 'own ', id) AS description")
    state, removed = lines.recurring_lines([docs.where("id < 1500"), docs.where("id >= 1500")], "id", "channel", "description", 4)
    assert removed.count() == 3000 and state.where("source = 'hot' AND n = 1000 AND places IS NULL").count() == 1
    assert removed.where("line_idx <> 0").count() == 0


def test_lines_of_an_empty_table(described):
    state, removed = lines.recurring_lines([described.limit(0)], "id", "channel", "description", 4)
    assert state.count() == 0 and removed.count() == 0


ITEMS = "key long, source string, n_tokens long"


@pytest.mark.parametrize("shard", [10**9, 20_000])
def test_packing(spark, shard):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["hot"] * 5 + [f"s{j}" for j in range(8)]), rnd.choice([0, 1, 10, 50, 100, 300, 700, 999, 1000, 1001, 2500])) for i in range(600)]
    p = packing.PackParams(capacity=1000, window=4, shard_tokens=shard)
    out = packing.pack(spark.createDataFrame(rows, ITEMS), p).collect()
    boxes, parts = {}, {}
    for r in out:
        boxes[r.container] = boxes.get(r.container, 0) + r.n_tokens
        parts.setdefault(r.key, []).append((r.part, r.first_token, r.n_tokens))
    assert max(boxes.values()) <= 1000
    for k, _, n in rows:
        own = sorted(parts[k])
        assert [x[0] for x in own] == list(range(len(own))) and sum(x[2] for x in own) == n
        assert len(own) == max(1, -(-n // 1000)) and all(f == 1000 * q for q, f, _ in own)
    assert sum(boxes.values()) / (1000 * len(boxes)) > 0.95


def test_windows_keep_the_mixture():
    sizes = [100] * 4000
    sources = ["a" if i < 3000 else "b" for i in range(4000)]
    boxes, windows = packing.pack_shard(list(range(4000)), [0] * 4000, sources, sizes, {"a": 0.75, "b": 0.25}, {}, packing.PackParams(capacity=1000, window=10))
    for lo in range(0, 390, 10):
        mine = [s for s, b in zip(sources, boxes) if lo <= b < lo + 10]
        assert abs(mine.count("a") / len(mine) - 0.75) < 0.03
    assert all(d < 0.03 for _, d in windows[:-1]) and sum(n for n, _ in windows) == 400_000


def test_a_deficit_is_paid_back_first():
    sources = ["a"] * 100 + ["b"] * 100
    boxes, _ = packing.pack_shard(list(range(200)), [0] * 200, sources, [100] * 200, {"a": 0.5, "b": 0.5}, {"a": 1000.0, "b": -1000.0}, packing.PackParams(capacity=1000, window=2))
    first = [s for s, b in zip(sources, boxes) if b < 2]
    assert first.count("a") > first.count("b")


def test_a_large_deficit_is_carried_whole():
    """A deficit of four windows is paid back in equal parts over all windows of the partition, none of it is cut."""
    sources = ["a"] * 1000 + ["b"] * 1000
    boxes, windows = packing.pack_shard(list(range(2000)), [0] * 2000, sources, [100] * 2000, {"a": 0.5, "b": 0.5}, {"a": 80_000.0, "b": -80_000.0}, packing.PackParams(capacity=1000, window=20))
    first = [s for s, b in zip(sources, boxes) if b < 20]
    assert len(windows) == 10 and first.count("a") / len(first) == pytest.approx(0.9, abs=0.02)
    early = [s for s, b in zip(sources, boxes) if b < 100]
    assert early.count("a") - early.count("b") == pytest.approx(800, abs=30)


def test_a_target_other_than_the_natural_mixture(spark):
    """Source b has a tenth of the tokens and a target of a third: windows keep the target until b ends, then a goes on alone."""
    rows = [(i, "b" if i % 10 == 0 else "a", 90 + i % 21) for i in range(20_000)]
    items = spark.createDataFrame(rows, ITEMS)
    shares = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("gone", 5.0)], "source string, share double").where("source <> 'gone'")
    p = packing.PackParams(capacity=1000, window=20, shard_tokens=200_000)
    report = packing.mixture_report(items, p, shares).collect()
    assert sum(r.tokens for r in report) == sum(n for _, _, n in rows)
    full = [r for r in report if r.tokens >= 18_000]
    assert sum(r.deviation for r in full) / len(full) < 0.05
    out = packing.pack(items, p, shares)
    assert out.count() == len(rows) and len({r.container.split("-")[0] for r in out.collect()}) > 5


def test_packing_edges(spark):
    empty = spark.createDataFrame([], ITEMS)
    assert packing.pack(empty, packing.PackParams(capacity=10)).count() == 0
    zeros = packing.pack(spark.createDataFrame([(1, "", 0), (1, "", 0)], ITEMS), packing.PackParams(capacity=10)).collect()
    assert [(r.key, r.n_tokens) for r in zeros] == [(1, 0), (1, 0)]


def test_token_counts(spark):
    import tiktoken  # noqa: F401

    d = spark.createDataFrame([(1, "s", "hello world", 9), (2, None, None, 9), (3, "s", "", 9), (4, "s", "x " * 50_000, 9)], "doc_id long, source string, text string, n_tokens int")
    got = {r.key: (r.source, r.n_tokens) for r in packing.count_tokens(d, "doc_id", "source", "text").collect()}
    assert got[1] == ("s", 2) and got[2] == ("", 0) and got[3] == ("s", 0) and got[4][1] > 40_000
