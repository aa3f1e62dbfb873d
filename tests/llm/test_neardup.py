import random
import re

import pytest
from pyspark.sql import functions as F

from cuemill.llm import neardup as N

SCHEMA = "field string, key long, pieces array<string>, id string, a int"


def jaccard(x, y, width):
    def shingles(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}

    a, b = shingles(x), shingles(y)
    return len(a & b) / len(a | b) if a and b else 0.0


def corpus():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(40, 120))) for _ in range(40)]
    out = list(texts)
    for t in texts[:25]:
        w = t.split()
        for _ in range(rnd.randint(1, 8)):
            i = rnd.randrange(len(w))
            w[i : i + 1] = rnd.choice([[], [rnd.choice(vocab)], [w[i], "new"]])
        out.append(" ".join(w))
    return out + texts[:3] + texts[:3] + [t.upper() + "!" for t in texts[3:5]]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [("t", i, t.split(" ", 1), "x", 1) for i, t in enumerate(corpus())]
    rows += [("t", 900, None, "x", 1), ("t", 901, [], "x", 1), ("t", 902, ["two words"], "x", 1), ("u", 0, corpus()[0].split(" ", 1), "x", 1), ("t", 903, [None, ""], "x", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("params", [N.HALF, N.NearDupParams(part=2), N.NearDupParams(width=3, similarity=0.5, blocks=90, rows=4, part=2, cells=4, salts=3, broadcast_rows=0)])
def test_pairs_against_brute_force(texts, params):
    members, links = N.near_duplicates(texts, params)
    got = {(r.field, r.key_a, r.key_b) for r in N.every_pair(members, links, params.part).collect()}
    all_texts = corpus()
    true = {("t", i, j) for i in range(len(all_texts)) for j in range(i + 1, len(all_texts)) if jaccard(all_texts[i], all_texts[j], params.width) >= params.similarity}
    assert got == true and len(true) > 10


def test_large_block_is_paired_in_parts(spark):
    base = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([("t", i, [f"{base} end{i}"], "x", 1) for i in range(30)], SCHEMA)
    members, links = N.near_duplicates(d, N.NearDupParams(part=4))
    assert links.count() == 30 * 29 // 2
    assert N.groups(members, links).select("group_id").distinct().count() == 1


def test_classes_and_groups(texts):
    members, links = N.near_duplicates(texts, N.HALF)
    summary = {(r.field, r.key): r for r in N.class_summary(members, links).collect()}
    assert summary[("t", 0)].copies == 3 and ("t", 902) not in summary and ("t", 900) not in summary
    assert summary[("u", 0)].class_id != summary[("t", 0)].class_id
    parent = {k: k for k in summary}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for r in N.every_pair(members, links).collect():
        parent[top((r.field, r.key_a))] = top((r.field, r.key_b))
    got = {}
    for r in N.groups(members, links).collect():
        got.setdefault(r.group_id, set()).add(top((r.field, r.key)))
    assert all(len(v) == 1 for v in got.values()) and len(got) == len({top(k) for k in summary})


def test_crowded_blocks_and_copies_are_spread(spark):
    """A third of all texts hold one passage of boilerplate and as many are one text: no task of any stage holds a group of them whole."""
    base = " ".join(f"b{i}" for i in range(300))
    rows = [("t", i, [f"{base} {i} x{i} y{i}" if i % 3 == 0 else "one text copied word for word again and again" if i % 3 == 1 else " ".join(f"u{i}x{j}" for j in range(30))], "x", 1) for i in range(360)]
    params = N.NearDupParams(part=10, cells=64, salts=8)
    members, links = N.near_duplicates(spark.createDataFrame(rows, SCHEMA), params)
    assert links.count() == 120 * 119 // 2
    classes = N.class_summary(members, links)
    assert {(r.copies, r.links, r.n) for r in classes.groupBy("copies", "links").agg(F.count("*").alias("n")).collect()} == {(1, 119, 120), (120, 0, 120), (1, 0, 120)}
    assert N.every_pair(members, links, 10).distinct().count() == 2 * 120 * 119 // 2 == N.every_pair(members, links, 10).count()


def test_parts_bound_every_row_of_work(spark):
    keys = spark.range(5000).selectExpr("'g' AS g", "50 AS parts", "pmod(xxhash64(id), 50) AS part", "id")
    sizes = keys.groupBy("g", "part").count()
    assert sizes.agg(F.max("count")).first()[0] < 200
    assert N._paired(keys.where("id < 300"), "g", "id").where("x < y").distinct().count() == 300 * 299 // 2


def test_long_chains_come_out_as_one_group(spark):
    rnd = random.Random(4)
    ids = rnd.sample(range(-(2**61), 2**61), 151)
    rising = sorted(rnd.sample(range(2**61, 2**62), 12))
    star = rnd.sample(range(-(2**62), -(2**61)), 10)
    linked = [*zip(ids[:150], ids[1:150]), *zip(rising, rising[1:]), *((max(star), x) for x in star if x != max(star))]
    members = spark.createDataFrame([("t", k, i) for k, i in enumerate(ids + rising + star)], "field string, key long, id long")
    links = spark.createDataFrame([(min(p), max(p), 0.9) for p in linked], "a long, b long, similarity double")
    got = {r.key: r.group_id for r in N.groups(members, links).collect()}
    assert [got[k] for k in range(173)] == [min(ids[:150])] * 150 + [ids[150]] + [min(rising)] * 12 + [min(star)] * 10


def test_empty(spark):
    members, links = N.near_duplicates(spark.createDataFrame([], SCHEMA), N.HALF)
    assert members.count() == 0 and links.count() == 0 and N.every_pair(members, links).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    d = spark.createDataFrame([("t", 1, [long], "x", 1), ("t", 2, [long + " more"], "x", 1)], SCHEMA)
    members, links = N.near_duplicates(d, N.HALF)
    assert links.select(F.round("similarity", 2)).first()[0] == 1.0
