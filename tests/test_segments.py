"""The ordered operators against a plain statement of their rules."""

import html
import math
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cuemill.operators import chunks, segments
from cuemill.params import Params
from cuemill.schema import CHAPTER, SEGMENT

SCHEMA = f"key int, transcript_segments array<{SEGMENT.simpleString()}>, chapters array<{CHAPTER.simpleString()}>"
P = Params(min_words=5, paragraph_min_words=6)


def tidy(t):
    t = html.unescape(t or "").replace("\n", " ").strip()
    t = re.sub(r"\b(um+|uh+|hmm+|hm+|mhm|uh-huh|err+)\b,?", "", t, flags=re.I)
    return re.sub(r"\s{2,}", " ", t).strip()


def expected_threshold(segs, p):
    ends = [s + (d or 0) for _, s, d in segs]
    pos = sorted(g for g in (segs[i][1] - ends[i - 1] for i in range(1, len(segs))) if g > 0)
    if len(segs) < p.gap_min_segments or not pos:
        return p.gap_default
    return max(p.gap_low, min(p.gap_high, pos[math.floor(len(pos) * 0.8)]))


def expected_items(segs, chaps):
    marks = sorted(((s, i, t) for i, (t, s) in enumerate(chaps) if t and s is not None), key=lambda m: m[:2])
    at = {}
    for s, _, t in marks:
        place = next((k for k, seg in enumerate(segs) if seg[1] >= s), len(segs))
        at.setdefault(place, []).append(("## " + t.strip(), s, 0.0, True))
    out = []
    for k in range(len(segs) + 1):
        out += at.get(k, [])
        if k < len(segs):
            out.append((segs[k][0], segs[k][1], segs[k][2] or 0.0, False))
    return out


def expected_blocks(items, threshold, p):
    """Rules 1 to 7, by marking for each text whether a block begins there."""
    blocks, open_, n = [], [], 0
    for i, (raw, start, _, heading) in enumerate(items):
        gap = start - (items[i - 1][1] + items[i - 1][2]) if i else 0.0
        text = raw if heading else tidy(raw)
        if not text:
            continue
        title = i > 0 and 1 <= len(text.split()) <= 7 and text[-1] not in ".!?,;:" and text[0].isupper() and gap >= 2 * threshold
        if heading or title:
            if open_:
                blocks.append(" ".join(open_))
            open_, n = [], 0
            blocks.append(text if heading else "## " + text)
            continue
        over = open_ and re.search(r"[.!?]['\"]?\s*$", open_[-1])
        if i > 0 and n >= p.paragraph_min_words and (gap >= threshold or over) and open_:
            blocks.append(" ".join(open_))
            open_, n = [], 0
        open_.append(text)
        n += len(text.split())
    return blocks + ([" ".join(open_)] if open_ else [])


def cases():
    rnd = random.Random(4)
    words = ["alpha", "Beta", "um", "gamma.", "delta", "Uh-huh", "x&amp;y", "Zeta?", "", "\n", "eta,", "[Music]"]
    out = []
    for k in range(60):
        at, segs = 0.0, []
        for _ in range(rnd.choice([0, 1, 2, 8, 9, 10, 11, 15, 20, 40])):
            d = rnd.choice([None, 0.0, 1.0, 2.5])
            segs.append((" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6))), at, d))
            at += (d or 0) + rnd.choice([-1.0, 0.0, 0.0, 0.5, 1.0, 3.0, 9.0, 20.0])
        chaps = [(rnd.choice(["Intro", " Part two ", "", None]), rnd.choice([None, 0.0, 3.0, 3.0, 12.0, at, at + 5])) for _ in range(rnd.randint(0, 5))]
        out.append((k, segs, chaps))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(k, [Row(text=t, start=s, duration=d) for t, s, d in segs], [Row(title=t, start_time=s, end_time=None) for t, s in chaps]) for k, segs, chaps in cases()]
    return spark.createDataFrame([*rows, (900, None, None)], SCHEMA)


def test_threshold(frame):
    got = {r.key: r.t for r in frame.where("transcript_segments IS NOT NULL").select("key", segments.gap_threshold(F.col("transcript_segments")).alias("t")).collect()}
    assert got == {k: pytest.approx(expected_threshold(s, Params())) for k, s, _ in cases()}


def test_threshold_of_rows_agrees(frame):
    nested = {r.key: r.t for r in frame.where("size(transcript_segments) > 0").select("key", segments.gap_threshold(F.col("transcript_segments")).alias("t")).collect()}
    rows = segments.gap_rows(segments.long_form(frame, "key"), "key", "pos", "start", "duration")
    assert {r.key: r.threshold for r in rows.collect()} == nested


def test_injection(frame):
    got = {r.key: [(x.text, x.start, x.duration, x.is_heading) for x in r.e] for r in frame.where("key < 900").select("key", segments.inject_chapters(F.col("transcript_segments"), F.col("chapters")).alias("e")).collect()}
    assert got == {k: expected_items(s, c) for k, s, c in cases()}


def test_clean(frame):
    got = {r.key: r for r in segments.clean(frame, P).collect()}
    headings = 0
    for k, segs, chaps in cases():
        blocks = [b for b in expected_blocks(expected_items(segs, chaps), expected_threshold(segs, P), P) if b.strip()]
        prose = sum(len(b.split()) for b in blocks if not b.startswith("##"))
        headings += sum(b.startswith("##") for b in blocks)
        assert got[k].blocks == blocks, k
        assert got[k].cleaned == ("\n\n".join(blocks) if segs and prose >= P.min_words else None), k
    assert headings > 20
    assert got[900].cleaned is None


def test_uniform_speech_is_one_paragraph(spark):
    greek = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    d = spark.createDataFrame([(1, [Row(text=greek, start=4.0 * i, duration=4.0) for i in range(30)], [])], SCHEMA)
    r = segments.clean(d).first()
    assert (r.threshold, len(r.blocks), r.prose_words) == (2.0, 1, 300) and r.cleaned


def para(word, n):
    return " ".join(f"{word}{i}" for i in range(n))


@pytest.mark.parametrize(
    "text,target,expected",
    [
        (f"## One\n\n{para('a', 5)}\n\n## Two\n\n{para('b', 5)}", 1000, [("One", 5), ("Two", 5)]),
        ("## Long\n\n" + "\n\n".join(para("p", 40) for _ in range(4)), 50, [("Long", 80), ("Long", 80)]),
        (para("x", 500), 50, [(None, 500)]),
        ("   ", 50, []),
        ("# A\n\n## B\n\nword", 50, [("B", 1)]),
        ("a b\n\n# H", 1, [(None, 2)]),
    ],
)
def test_chunks(spark, text, target, expected):
    d = spark.createDataFrame([(1, text)], "key int, body string")
    got = chunks.chunk_rows(d, "key", "body", target).orderBy("chunk_idx").collect()
    assert [(r.heading, r.words) for r in got] == expected
    assert [r.chunk_idx for r in got] == list(range(len(expected)))


def test_coverage(spark):
    def run(a, b):
        ratio, retention = chunks.coverage(F.lit(a), F.lit(b))
        d = spark.range(1).select(ratio.alias("r"), retention.alias("k"))
        return d.withColumn("f", chunks.coverage_failure(F.lit(b), F.col("r"), F.col("k"))).first()

    same = run(para("word", 100), para("word", 100))
    assert (same.r, same.k, same.f) == (1.0, 1.0, None)
    assert run(para("word", 100), " ").f == "empty output"
    assert run(para("word", 100), para("word", 10)).f == "too short (ratio 0.10 < 0.55)"
    assert run(para("word", 100), para("word", 400)).f.startswith("too long (ratio 4.00")
    assert run(para("word", 100), para("other", 100)).f.startswith("dropped content (retention 0.00")
    assert run("", "x").r == 0.0


def test_accepted_takes_the_first_good_try(spark):
    src = para("word", 20)
    pick = lambda *a: spark.range(1).select(chunks.accepted(F.lit(src), *[F.lit(x).cast("string") for x in a]).alias("x")).first().x
    assert pick("bad", src + " end") == src + " end"
    assert pick(None, src) == src
    assert pick("bad", "worse", src + " late") == src


def test_assemble_writes_a_heading_once_per_run(spark):
    d = spark.createDataFrame([("v", 0, "A", "1"), ("v", 1, "A", "2"), ("v", 2, None, "3"), ("v", 3, "B", "4"), ("v", 4, "A", "5")], "key string, chunk_idx int, heading string, text string")
    assert chunks.assemble(d, "key").first().article == "## A\n\n1\n\n2\n\n3\n\n## B\n\n4\n\n## A\n\n5"
