import pytest

from cuemill.llm import terms as T

SCHEMA = "video_id string, domains array<string>, key_concepts array<string>, term_id string, field int"  # the last two clash


@pytest.fixture(scope="module")
def canon(spark):
    rows = [(101, "domains", "machine learning"), (102, "domains", "contract law"), (103, "domains", "personal finance"), (104, "domains", "astronomy"), (201, "key_concepts", "hash table"), (202, "key_concepts", "progressive overload"), (999, "domains", None)]
    more = "geology, gastronomy, web development, database systems, criminal procedure, labour law, rock climbing, cardiology, mental health, stock markets, tax planning, archaeology, music theory, economic history, typography, robotics"
    rows += [(300 + i, "domains", n) for i, n in enumerate(more.split(", "))]
    return spark.createDataFrame(rows, "term_id long, field string, name string")


def run(spark, canon, values, field="domains", aliases=None):
    d = spark.createDataFrame([("v", values if field == "domains" else None, values if field != "domains" else None, "x", 1)], SCHEMA)
    return {r.pos: r.term_id for r in T.map_entries(d, canon, "video_id", ["domains", "key_concepts"], aliases=aliases).collect()}


VALUES = [
    ("Machine Learning", 101), ("machine learnign", 101), ("learning, machine", 101), ("#MachineLearning", 101), ("machinelearning", 101), ("ML", 0),
    ("m4ch1ne l3arning", 101), ("mаchine leаrning", 101), ("ｍａｃｈｉｎｅ learning", 101), ("intro to machine learning", 101), ("machine learning (advanced)", 101),
    ("Vertragsrecht", 0), ("cont. law", 102), ("contract bridge", 0), ("finance", 0), ("Parenting", 0), ("-", 0), ("x" * 100_000, 0),
]


def test_values(spark, canon):
    assert run(spark, canon, [v for v, _ in VALUES]) == {i: t for i, (_, t) in enumerate(VALUES)}


def test_aliases_are_an_input(spark, canon):
    own = spark.createDataFrame([("Machine Learning", "ML"), ("contract law", "Vertragsrecht"), (None, "x"), ("gone", "y"), ("astronomy", None)], "name string, form string")
    assert run(spark, canon, ["ML", "vertragsreht", "Astronomie", "y"], aliases=own) == {0: 101, 1: 102, 2: 104, 3: 0}


def test_fields_have_their_own_lists(spark, canon):
    assert run(spark, canon, ["machine learning", "prog. over.", "hash browns", "hahs table"], "key_concepts") == {0: 0, 1: 202, 2: 0, 3: 201}


def test_blank_null_and_canonical_entries_have_no_row(spark, canon):
    assert run(spark, canon, ["astronomy", "", "  ", None, "astronmy", "astronmy"]) == {4: 104, 5: 104}


def test_empty_tables(spark, canon):
    d = spark.createDataFrame([], SCHEMA)
    assert T.map_entries(d, canon, "video_id", ["domains"]).count() == 0
    one = spark.createDataFrame([("v", ["astronomy"], None, "x", 1)], SCHEMA)
    assert [r.term_id for r in T.map_entries(one, canon.limit(0), "video_id", ["domains"]).collect()] == [0]
    assert T.unmatched_report(one, canon.limit(0), "video_id", ["domains"]).first().n == 1


def test_ties_are_refused(spark):
    two = spark.createDataFrame([(1, "domains", "alpha beta"), (2, "domains", "Alpha Beta")], "term_id long, field string, name string")
    d = spark.createDataFrame([("v", ["alpha  beta!"], None, "x", 1)], SCHEMA)
    assert [r.term_id for r in T.map_entries(d, two, "video_id", ["domains"]).collect()] == [0]


def test_edit_distance_counts_a_swap_once():
    assert T.edit_distance("robtoics", "robotics") == 1 and T.edit_distance("", "ab") == 2 and T.edit_distance("abc", "abc") == 0
