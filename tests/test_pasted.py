import pytest

from cuemill.operators import pasted


def parse(spark, text):
    d = spark.createDataFrame([(1, text)], "doc int, body string")
    return [(r.text, r.start, r.duration) for r in pasted.parse_pasted(d, "doc", "body").orderBy("at").collect()]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("0:10 red kettle\n0:25 blue kettle", [("red kettle", 10.0, 15.0), ("blue kettle", 25.0, 3.0)]),
        ("(1:02)\nnorth gate\n[1:09]\nsouth gate", [("north gate", 62.0, 7.0), ("south gate", 69.0, 3.0)]),
        ("7\n00:10:00,250 --> 00:10:01,000\n42\n\n8\n00:10:05,000 --> 00:10:04,000\nback to the mill\n", [("42", 600.25, 0.75), ("back to the mill", 605.0, 3.0)]),
        ("WEBVTT\n\n02:00.500 --> 02:03.000\nhay\nand oats\n\nnot a cue\n", [("hay and oats", 120.5, 2.5)]),
        ("Cut it. Sand it.\n \nThen oil.", [("Cut it. Sand it.", 0.0, 1.6), ("Then oil.", 5.6, 1.0)]),
        ("", []),
        (" \n\t", []),
        ("WEBVTT\n\n", []),
        ("intro\r\n0:05 a\r\nb\r\n0:05 c", [("a b", 5.0, 0.1), ("c", 5.0, 3.0)]),
    ],
)
def test_parse(spark, text, expected):
    assert parse(spark, text) == [(t, pytest.approx(s), pytest.approx(d)) for t, s, d in expected]


def test_prose_chunks(spark):
    long = " ".join(f"w{i}" for i in range(50)) + "."
    got = parse(spark, "Short one. " + long + " Tail here.")
    assert [len(t.split()) for t, _, _ in got] == [2, 22, 22, 6, 2]
    assert got[1][1] == pytest.approx(1.0) and got[1][2] == pytest.approx(8.8)


def test_null_documents_have_no_rows(spark):
    assert parse(spark, None) == []


def test_documents_of_all_styles_in_one_table(spark):
    rows = [(1, "0:01 a\n\nb"), (2, "1\n00:01 --> 00:02\nc"), (3, "Just words."), (4, None), (5, "WEBVTT"), (6, "text 0:01 inside\nand --> an arrow")]
    d = spark.createDataFrame(rows, "doc int, body string")
    got = {(r.key, r.style, r.text) for r in pasted.parse_pasted(d, "doc", "body").collect()}
    assert got == {(1, "stamped", "a b"), (2, "cues", "c"), (3, "prose", "Just words."), (6, "prose", "text 0:01 inside and --> an arrow")}
    assert {r.key: r.style for r in pasted.styles(d, "doc", "body").collect()} == {1: "stamped", 2: "cues", 3: "prose", 4: "empty", 5: "empty", 6: "prose"}
    assert {(r.key, r.segments, r.words) for r in pasted.word_totals(pasted.parse_pasted(d, "doc", "body")).collect()} == {(1, 1, 2), (2, 1, 1), (3, 1, 2), (6, 1, 7)}
