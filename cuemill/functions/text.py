"""Scalar text functions as column expressions; Python is used only where the JVM has no such function."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuemill.params import DEFAULTS

# (?U): \s is the Unicode property White_Space; far faster than a class that lists its characters
WORDS = r"(?U)\S+"

# fixed values: words that carry no content
STOPWORDS = """
about above after again against all also and any are because been before being
below between both but can did does doing down during each few for from further
had has have having here how into its itself just more most not now off once
only other our out over own same should some such than that the their them then
there these they this those through too under until very was were what when
where which while who whom why will with would you your yours are our
like really actually basically thing things going get got make makes made say
says said know think see look kind sort lot want need use used using way ways
""".split()
# fixed values: filler words, hosts and identifier shape
FILLERS = r"\b(um+|uh+|hmm+|hm+|mhm|uh-huh|err+)\b[,]?"
VIDEO_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com", "music.youtube.com", "youtube-nocookie.com", "www.youtube-nocookie.com")
ID = r"[A-Za-z0-9_-]{11}"
DOCUMENT_HOST = "www.youtube.com"


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_all(texts: pd.Series) -> pd.Series:
    """HTML5 entities decoded in every element."""
    return texts.map(lambda xs: None if xs is None else [None if x is None else html.unescape(x) if "&" in x else x for x in xs])


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML5 entities decoded."""
    return texts.map(lambda x: None if x is None else html.unescape(x) if "&" in x else x)


def one_line(c: Column) -> Column:
    """Line feeds to spaces, ends stripped."""
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def strip_fillers(c: Column) -> Column:
    """Filler words removed with a comma after them, runs of white space collapsed, ends stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, "(?iU)" + FILLERS, ""), r"(?U)\s{2,}", " "))


def word_count(c: Column) -> Column:
    """Runs free of white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORDS)), F.lit(0))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORDS), 0)


def content_words(c: Column) -> Column:
    """Distinct lower-case words of more than three characters that aren't stop words."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9][a-z0-9'\-]*"), 0))
    return F.filter(F.array_except(found, F.array(*map(F.lit, sorted(set(STOPWORDS))))), lambda w: F.length(w) > 3)


def format_timestamp(seconds: Column) -> Column:
    """[MM:SS], or [HH:MM:SS] from one hour on; fractions are cut."""
    s = seconds.cast("long")
    h, m, r = (s / 3600).cast("long"), (s % 3600 / 60).cast("long"), s % 60
    return F.when(h != 0, F.format_string("[%02d:%02d:%02d]", h, m, r)).otherwise(F.format_string("[%02d:%02d]", m, r))


def to_seconds(stamp: Column) -> Column:
    """h:m:s in base 60 with a decimal point or comma; anything else is 0."""
    parts = F.transform(F.split(F.replace(strip(stamp), F.lit(","), F.lit(".")), ":"), lambda p: p.try_cast("double"))
    return F.when(F.exists(parts, lambda p: p.isNull()), F.lit(0.0)).otherwise(F.aggregate(parts, F.lit(0.0), lambda a, p: a * 60 + p))


def sanitize_filename(name: Column, limit: int = 100) -> Column:
    """A safe path part: reserved and control characters dropped, white space to underscores, then cut; never empty or dots."""
    s = strip(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', ""))
    s = F.substring(F.regexp_replace(s, r"(?U)\s+", "_"), 1, limit)
    return F.when(s.isin("", ".", ".."), F.lit("untitled")).otherwise(s)


def escape_yaml(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def block_scalar(c: Column) -> Column:
    """YAML literal block: every line indented by two."""
    lines = F.split(F.regexp_replace(c, r"(\r\n|\n|\r|\x0b|\f|\x1c|\x1d|\x1e|\x85| | )$", ""), r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x85  ]")
    return F.concat(F.lit("|\n"), F.array_join(F.transform(lines, lambda x: F.concat(F.lit("  "), x)), "\n"))


def flow_list(items: Column) -> Column:
    """YAML flow sequence of quoted strings."""
    quoted = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.concat(F.lit('"'), escape_yaml(x), F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def cap_words(c: Column, limit: int) -> Column:
    """Unchanged up to the limit, else the first words joined by single spaces."""
    return F.when(word_count(c) <= limit, c).otherwise(F.array_join(F.slice(words(c), 1, limit), " "))


def output_ceiling(n: Column, max_ratio: float = DEFAULTS.max_ratio) -> Column:
    """Tokens a rewrite of n words may take, in binary floating point."""
    return (n.cast("double") * F.lit(float(max_ratio)) * F.lit(1.4)).cast("long") + 128


def two_decimals(x: Column) -> Column:
    """A number with two decimals, rounded from its exact binary value, ties to even.

    The error of x * 1000 is recovered by splitting x, which tells on which side of a tie the exact value lies.
    """
    p = x * F.lit(1000.0)
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    error = (high * F.lit(1000.0) - p) + (x - high) * F.lit(1000.0)
    q = F.floor(p / 10)
    tie = (p == F.floor(p)) & (p % 10 == 5)
    up = F.when(tie, F.when(error > 0, 1).when(error < 0, 0).otherwise((q % 2).cast("int"))).otherwise((p - q * 10 >= 5).cast("int"))
    return F.format_string("%.2f", (q + up) / F.lit(100.0))


def strip_fences(c: Column) -> Column:
    """Without one outer code fence around the whole answer."""
    fence = r"(?s)^```(?:markdown|md)?\s*\n(.*)\n```$"
    return F.when(strip(c).rlike(fence), strip(F.regexp_extract(strip(c), fence, 1))).otherwise(c)


def article_body(document: Column) -> Column:
    """Text after the first line that is exactly the article marker; null if none or blank."""
    found = document.rlike(r"(?m)^## Article\s*$")
    body = strip(F.regexp_extract(document, r"(?s)(?:^|.*?\n)## Article[ \t\r]*(?:\n(.*)|$)", 1))
    return F.when(found & (body != ""), body)


def document_video_id(document: Column, host: str = DOCUMENT_HOST) -> Column:
    """Identity of a document: the id in its url line."""
    line = r'url:\s+"https://' + host.replace(".", r"\.") + r'/watch\?v=([^"]+)"'
    return F.nullif(F.regexp_extract(document, line, 1), F.lit(""))


def video_id_of(source: Column, hosts: tuple[str, ...] = VIDEO_HOSTS, short_hosts: tuple[str, ...] = ("youtu.be",), id_pattern: str = ID) -> Column:
    """Id of a bare identifier or an address on a known host; null where there is none."""
    s = strip(source)
    url = F.when(s.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), s).otherwise(F.concat(F.lit("https://"), s))
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    path = F.try_parse_url(url, F.lit("PATH"))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    short = F.when(host.isin(*short_hosts) & (F.size(parts) >= 1), parts[0])
    watch = F.when(host.isin(*hosts) & F.rtrim(path, F.lit("/")).isin("/watch"), F.try_parse_url(url, F.lit("QUERY"), F.lit("v")))
    shown = F.when(host.isin(*hosts) & (F.size(parts) == 2) & parts[0].isin("shorts", "embed", "live"), parts[1])
    found = F.coalesce(F.when(s.rlike(f"^{id_pattern}$"), s), short, watch, shown)
    return F.when(found.rlike(f"^{id_pattern}$"), found)


def is_date(c: Column) -> Column:
    """yyyy-mm-dd that exists in the calendar."""
    return c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.coalesce(F.try_to_date(c, "yyyy-MM-dd").isNotNull(), F.lit(False))


def upload_date(c: Column) -> Column:
    """Eight digits become yyyy-mm-dd; everything else stays, null is empty."""
    return F.coalesce(F.when(F.length(c) == 8, F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))).otherwise(c), F.lit(""))


def first_filled(*columns: Column, default: str = "") -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(default))


def last_seq(c: Column) -> Column:
    """A resume position: a whole number, otherwise 0, never negative."""
    return F.greatest(F.coalesce(strip(c).try_cast("long"), F.lit(0)), F.lit(0))


def line_event(c: Column) -> Column:
    """A log line without line breaks."""
    return F.regexp_replace(c, r"\r\n|\n|\r", " ")


def iso_stamp(c: Column) -> Column:
    """ISO 8601 to the second with a numeric offset."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")


def audit_text(c: Column, kind: T.DataType) -> Column:
    """Text of a value in the audit log: null stays, arrays and structs are JSON with spaced separators."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        items = F.transform(c, lambda x: F.coalesce(F.to_json(F.array(x)), F.lit("[null]")))
        trimmed = F.transform(items, lambda j: F.substring(j, F.lit(2), F.length(j) - 2))  # without the brackets
        return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(trimmed, ", "), F.lit("]")))
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
