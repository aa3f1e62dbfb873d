"""Problem 1: map freely written values to a canonical list.

Method: deduplicate the values, normalise them, retrieve candidates through an inverted index of character n-grams,
score them by weighted cosine, accept above a threshold and a margin. An edit-distance check follows the cosine, so
that values which merely share a word with an entry ("contract bridge", "hash browns") stay unmatched.

Defined results: a null or blank value has no row; a value that means no entry has ``term_id`` 0; ties between two
entries are refused by the margin (0); repeated values get the same answer; an empty list maps everything to 0; very
long values are compared as a whole (none can be near a short entry, which the length test states exactly).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuemill.runtime import WHITE, cut, weighted_lookup

#: Words around a value that don't change what it means.
FILLER_WORDS = frozenset("the a an about intro introduction to basics explained advanced beginners 101".split())
LOOKALIKES = str.maketrans("аеорсухіјѕԁһӏкмтвнАЕОРСУХІКМТВН", "aeopcyxijsdhlkmtbhAEOPCYXIKMTBH")
LEET = str.maketrans("013457@$", "oieastas")
PLAIN = str.maketrans({"ß": "ss", "ø": "o", "ł": "l", "æ": "ae", "œ": "oe", "đ": "d", "ı": "i"})


@dataclass(frozen=True)
class TermParams:
    #: Least weighted cosine, least lead over the next entry, most edits per character of the longer string.
    threshold: float = 0.40
    #: Least cosine of a value made of an entry's own letters (swapped neighbours break many n-grams), and how many may differ.
    slip_threshold: float = 0.15
    slip_letters: int = 2
    margin: float = 0.03
    max_edits: float = 0.34
    gram: int = 3


def normalise(value: str | None) -> str:
    """Fold width, case, accents, look-alike letters, digits for letters, decoration and inversion ("finance, personal")."""
    s = unicodedata.normalize("NFKC", value or "")
    s = "".join(c for c in s if unicodedata.category(c) not in ("Cf", "Cc") or c.isspace())
    if re.search(r"[A-Za-z]", s) and re.search(r"[Ѐ-ӿ]", s):
        s = s.translate(LOOKALIKES)
    s = re.sub(r"(?<=[a-zß-ÿ])(?=[A-Z])", " ", s)
    s = re.sub(r"\([^()]*\)\s*$", " ", s) if re.search(r"\w", re.sub(r"\([^()]*\)\s*$", "", s)) else s
    before, comma, after = s.partition(",")
    if comma and "," not in after and re.search(r"\w", before) and re.search(r"\w", after):
        s = f"{after} {before}"
    s = unicodedata.normalize("NFD", s.lower().translate(PLAIN))
    s = "".join(c for c in s if not unicodedata.combining(c))
    words = re.sub(r"[^\w']+|_", " ", s).replace("'", " ").split()
    words = [w.translate(LEET) if re.search(r"[a-z]", w) and not re.search(r"\d{3}", w) else w for w in words]
    kept = [w for w in words if w not in FILLER_WORDS]
    return " ".join(kept)


def grams(text: str, n: int) -> list[str]:
    """n-grams of every word with its edges, and of the words run together, so that a lost space costs little."""
    out = [f"^{w}$"[i : i + n] for w in text.split() for i in range(max(1, len(w) + 3 - n))]
    solid = text.replace(" ", "")
    return out + ["+" + solid[i : i + n] for i in range(max(1, len(solid) + 1 - n))] if solid else []


def edit_distance(a: str, b: str) -> int:
    """Edits with swaps of neighbours counted once (optimal string alignment)."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


def _slips(letters: int):
    @F.pandas_udf(T.DoubleType())
    def slip(values: pd.Series, forms: pd.Series) -> pd.Series:
        """Edits per character where at most ``letters`` letters differ, else 1."""
        out = []
        for a, b in zip(values, forms):
            a, b = a.replace(" ", ""), b.replace(" ", "")
            x, y = Counter(a), Counter(b)
            out.append(edit_distance(a, b) / max(len(a), len(b)) if sum((x - y).values()) + sum((y - x).values()) <= letters else 1.0)
        return pd.Series(out)

    return slip


def _folded(n: int):
    """Normal form, distinct n-grams and how often each stands in it."""
    schema = T.StructType([T.StructField("norm", T.StringType()), T.StructField("grams", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    @F.pandas_udf(schema)
    def fold(values: pd.Series) -> pd.DataFrame:
        norms = [normalise(v) for v in values]
        found = [Counter(grams(x, n)) for x in norms]
        return pd.DataFrame({"norm": norms, "grams": [list(c) for c in found], "counts": [list(c.values()) for c in found]})

    return fold


ALIASES = "name string, form string"
#: In place of a form: the value itself.
_SELF = -1


def term_forms(terms: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(field, form, term_id): names, their other names in ``aliases`` (name, form), and the dotted short forms that follow from a
    name by rule ("prog. over.")."""
    base = terms.where("name IS NOT NULL AND term_id IS NOT NULL").select("term_id", "field", F.col("name").alias("form"))
    short = base.where(F.instr("form", " ") > 0).select("term_id", "field", F.regexp_replace("form", r"(\p{L}{4})\p{L}{2,}", "$1").alias("form"))
    out = base.unionByName(short)
    if aliases is not None:
        other = aliases.where("name IS NOT NULL AND form IS NOT NULL").select(F.lower("name").alias("_name"), F.col("form").alias("_form")).distinct()
        named = base.join(other, F.lower("form") == F.col("_name"))
        out = out.unionByName(named.select("term_id", "field", F.col("_form").alias("form")))
    return out.distinct()


def map_terms(values: DataFrame, terms: DataFrame, params: TermParams = TermParams(), aliases: DataFrame | None = None) -> DataFrame:
    """Answer every distinct value of ``values`` (field, value).

    ``aliases`` (name, form), none by default, gives canonical names further forms, as translations, which no n-gram can find.

    Returns (field, value, n, term_id, score, margin): ``n`` is how many rows hold the value, ``term_id`` is 0 for none.
    ``terms`` holds (term_id, field, name); further columns of either input are ignored.
    """
    fold = _folded(params.gram)
    counted = F.inline(F.arrays_zip(F.col("grams").alias("gram"), F.col("counts").alias("tf")))
    distinct = values.select(F.col("field").cast("string"), F.col("value").cast("string")).groupBy("field", "value").agg(F.count("*").alias("n"))
    distinct = cut(distinct.withColumn("folded", fold("value")).select("field", "value", "n", "folded.*"))
    forms = term_forms(terms.select("term_id", F.col("field").cast("string"), F.col("name").cast("string")), aliases)
    forms = forms.withColumn("folded", fold("form")).select("field", "term_id", "folded.*").where("norm <> ''").dropDuplicates(["field", "term_id", "norm"])
    forms = cut(forms.withColumn("form_id", F.monotonically_increasing_id()))
    sizes = forms.groupBy("field").agg(F.count("*").alias("forms"), F.max(F.length("norm")).alias("longest"))
    posts = forms.select("field", "form_id", counted)
    weights = posts.groupBy("field", "gram").agg(F.count("*").alias("df")).join(F.broadcast(sizes), "field")
    weights = weights.select("field", "gram", F.log(1 + F.col("forms") / F.col("df")).alias("w"))
    # an entry _SELF for every n-gram, so that a value's own length comes from the join that scores it; cut, since the driver plans
    # every exchange again after each stage and its memory follows the largest plan
    posts = posts.join(weights, ["field", "gram"]).select("field", "gram", "w", "form_id", (F.col("tf") * F.col("w")).alias("fw"))
    posts = cut(posts.unionByName(weights.select("field", "gram", "w", F.lit(_SELF).alias("form_id"), F.lit(0.0).alias("fw"))))
    norms = posts.where(F.col("form_id") != _SELF).groupBy("form_id").agg(F.sqrt(F.sum(F.col("fw") * F.col("fw"))).alias("form_norm"))

    words = distinct.join(F.broadcast(sizes), "field").where(F.length("norm") * (1 - params.max_edits) <= F.col("longest") + 1)
    words = words.where("norm <> ''").dropDuplicates(["field", "norm"]).select("field", "norm", "forms", counted)
    words = words.join(posts, ["field", "gram"], "left").withColumn("form_id", F.coalesce("form_id", F.lit(_SELF)))
    vw = F.col("tf") * F.coalesce("w", F.log(1 + F.col("forms")))
    dots = words.groupBy("field", "norm", "form_id").agg(F.sum(vw * F.when(F.col("form_id") == _SELF, vw).otherwise(F.col("fw"))).alias("dot"))
    own = F.max(F.when(F.col("form_id") == _SELF, F.sqrt("dot"))).over(Window.partitionBy("field", "norm"))
    scored = dots.withColumn("value_norm", own).where(F.col("form_id") != _SELF).join(norms, "form_id")
    scored = scored.withColumn("score", F.col("dot") / (F.col("form_norm") * F.col("value_norm")))
    scored = scored.where(F.col("score") >= params.slip_threshold).join(forms.select("form_id", "term_id", F.col("norm").alias("form")), "form_id")

    solid = lambda c: F.regexp_replace(c, " ", "")
    in_order = lambda c: F.array_join(F.array_sort(F.split(c, " ")), "")
    longer = F.greatest(F.length(solid("norm")), F.length(solid("form")))
    edits = F.least(F.levenshtein(solid("norm"), solid("form")), F.levenshtein(in_order("norm"), in_order("form")))
    near = scored.withColumn("plain_edits", edits / longer)
    sure = (F.col("score") >= params.threshold) & (F.col("plain_edits") <= params.max_edits)
    near = near.where(sure | (F.abs(F.length(solid("norm")) - F.length(solid("form"))) <= params.slip_letters))
    near = near.withColumn("slip", _slips(params.slip_letters)("norm", "form")).withColumn("edits", F.least("plain_edits", "slip"))
    near = near.where(sure | (F.col("slip") <= params.max_edits))
    # the score that ranks: cosine and closeness, equally
    near = cut(near.groupBy("field", "norm", "term_id").agg(F.max((F.col("score") + 1 - F.col("edits")) / 2).alias("score")))
    order = Window.partitionBy("field", "norm").orderBy(F.desc("score"), "term_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).withColumn("next", F.coalesce(F.lead("score").over(order), F.lit(0.0)))
    best = ranked.where("rank = 1").withColumn("margin", F.col("score") - F.col("next")).where(F.col("margin") >= params.margin)
    answers = distinct.drop("grams", "counts").join(best.select("field", "norm", "term_id", "score", "margin"), ["field", "norm"], "left")
    return answers.select("field", "value", "n", F.coalesce("term_id", F.lit(0)).cast("long").alias("term_id"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("margin", F.lit(0.0)).alias("margin"))


def entries(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, pos, value): every non-blank entry of the array columns ``fields``; null arrays and entries have none."""
    parts = [rows.select(F.col(key).alias("key"), F.lit(f).alias("field"), F.posexplode(F.col(f)).alias("pos", "value")) for f in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.regexp_replace("value", f"[{WHITE}]+", "") != "")


def map_entries(rows: DataFrame, terms: DataFrame, key: str, fields: Sequence[str], params: TermParams = TermParams(), aliases: DataFrame | None = None) -> DataFrame:
    """(key, field, pos, value, term_id) for every non-blank entry that isn't letter for letter a canonical name of its field."""
    names = terms.where("name IS NOT NULL").select("field", F.col("name").alias("value")).distinct()
    loose = entries(rows, key, fields).join(names, ["field", "value"], "left_anti")
    answers = cut(map_terms(loose.select("field", "value"), terms, params, aliases))
    return weighted_lookup(loose, answers.select("field", "value", "n", "term_id"), ["field", "value"], "n").select("key", "field", "pos", "value", "term_id")


def unmatched_report(rows: DataFrame, terms: DataFrame, key: str, fields: Sequence[str], params: TermParams = TermParams(), aliases: DataFrame | None = None) -> DataFrame:
    """(field, value, n) of the values that mean no entry, the most frequent first by ``n``."""
    names = terms.where("name IS NOT NULL").select("field", F.col("name").alias("value")).distinct()
    loose = entries(rows, key, fields).join(names, ["field", "value"], "left_anti")
    return map_terms(loose.select("field", "value"), terms, params, aliases).where("term_id = 0").select("field", "value", "n")
