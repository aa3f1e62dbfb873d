import pytest
from pyspark.sql import functions as F

from cuemill.functions import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text,expected",
    [("Uh-huh so um, yes", "-huh so yes"), ("ummm", ""), ("Album hums", "Album hums"), ("é um, b", "é b"), ("", ""), ("a  b", "a b"), ("no  um x", "no x")],
)
def test_fillers(spark, text, expected):
    assert one(spark, X.strip_fillers(F.lit(text))) == expected


@pytest.mark.parametrize("text,n", [("", 0), (" ", 0), ("a b", 2), ("a b c", 3), ("​", 1), (None, 0)])
def test_word_count(spark, text, n):
    assert one(spark, X.word_count(F.lit(text).cast("string"))) == n


@pytest.mark.parametrize("s,expected", [(0.0, "[00:00]"), (59.9, "[00:59]"), (3599.0, "[59:59]"), (3600.0, "[01:00:00]"), (360000.0, "[100:00:00]")])
def test_format_timestamp(spark, s, expected):
    assert one(spark, X.format_timestamp(F.lit(s))) == expected


@pytest.mark.parametrize("t,s", [("1:23", 83.0), ("01:00:00", 3600.0), ("00:00:01,500", 1.5), ("x:1", 0.0), ("7", 7.0)])
def test_to_seconds(spark, t, s):
    assert one(spark, X.to_seconds(F.lit(t))) == s


@pytest.mark.parametrize(
    "name,expected",
    [("a/b:c", "abc"), ("  a \t b ", "a_b"), ("..", "untitled"), ("../..", "...."), ("", "untitled"), ("x" * 120, "x" * 100), ("a\x00b", "ab"), ("<>", "untitled"), ("a\\b", "ab")],
)
def test_sanitize(spark, name, expected):
    assert one(spark, X.sanitize_filename(F.lit(name))) == expected


ID = "dQw4w9WgXcQ"


@pytest.mark.parametrize(
    "source,expected",
    [
        (ID, ID), (f"https://youtu.be/{ID}?t=4", ID), (f"youtube.com/watch?v={ID}", ID), (f"https://m.youtube.com/watch?x=1&v={ID}", ID),
        (f"https://www.youtube.com/shorts/{ID}", ID), (f"https://www.youtube.com/embed/{ID}/", ID), (f"https://www.youtube.com/live/{ID}/x", None),
        (f"https://evil.example/watch?v={ID}", None), ("https://youtu.be/short", None), ("", None), (f"https://youtube.com.evil.example/watch?v={ID}", None),
    ],
)
def test_video_id(spark, source, expected):
    assert one(spark, X.video_id_of(F.lit(source))) == expected


@pytest.mark.parametrize("d,ok", [("2024-02-29", True), ("2023-02-29", False), ("02/29/2024", False), ("2024-2-9", False), ("", False)])
def test_dates(spark, d, ok):
    assert one(spark, X.is_date(F.lit(d))) is ok


def test_upload_date_and_first_filled(spark):
    assert one(spark, X.upload_date(F.lit("20240131"))) == "2024-01-31"
    assert one(spark, X.upload_date(F.lit("2024"))) == "2024"
    assert one(spark, X.upload_date(F.lit(None).cast("string"))) == ""
    assert one(spark, X.first_filled(F.lit(""), F.lit("b"))) == "b"


@pytest.mark.parametrize("v,n", [("5", 5), ("-3", 0), ("x", 0), (None, 0), (" 7 ", 7)])
def test_last_seq(spark, v, n):
    assert one(spark, X.last_seq(F.lit(v).cast("string"))) == n


def test_output_ceiling_is_binary(spark):
    assert one(spark, X.output_ceiling(F.lit(900))) == int(900 * 1.60 * 1.4) + 128 == 2143


def test_fences_and_article(spark):
    assert one(spark, X.strip_fences(F.lit("```markdown\nhello\n```"))) == "hello"
    assert one(spark, X.strip_fences(F.lit("a ```b```"))) == "a ```b```"
    assert one(spark, X.article_body(F.lit("---\n## Article\n\nbody\nmore\n"))) == "body\nmore"
    assert one(spark, X.article_body(F.lit("## Articles\nbody"))) is None
    assert one(spark, X.article_body(F.lit("x\n## Article\n  \n"))) is None


def test_yaml(spark):
    assert one(spark, X.escape_yaml(F.lit('a"b\\c'))) == 'a\\"b\\\\c'
    assert one(spark, X.flow_list(F.array(F.lit("a"), F.lit('b"')))) == '["a", "b\\""]'
    assert one(spark, X.flow_list(F.array().cast("array<string>"))) == "[]"
    assert one(spark, X.block_scalar(F.lit("a\nb"))) == "|\n  a\n  b"


def test_unescape_and_caps(spark):
    assert one(spark, X.unescape(F.lit("a &amp;amp; &hearts; &#39;"))) == "a &amp; ♥ '"
    assert one(spark, X.cap_words(F.lit("a  b c"), 2)) == "a b"
    assert one(spark, X.cap_words(F.lit("a  b"), 2)) == "a  b"


def test_content_words(spark):
    got = one(spark, X.content_words(F.lit("Their gradient gradient descent isn't like a tree-like thing")))
    assert sorted(got) == ["descent", "gradient", "isn't", "tree-like"]


def test_audit_text(spark):
    from pyspark.sql import types as T

    strings = T.ArrayType(T.StringType())
    assert one(spark, X.audit_text(F.array(F.lit("a"), F.lit('b"')), strings)) == '["a", "b\\""]'
    assert one(spark, X.audit_text(F.lit(None).cast("array<string>"), strings)) is None
    assert one(spark, X.audit_text(F.lit(3), T.IntegerType())) == "3"
