import random
import re

import pytest

from cuemill.llm import subjects as S

WORDS = {
    1: (["particle physics", "geology"], ["quark", "photon", "proton", "basalt", "isotope"]),
    2: (["web development", "database systems"], ["browser", "script", "server", "cookie", "index"]),
    3: (["contract law", "labour law"], ["clause", "tribunal", "verdict", "plaintiff", "appeal"]),
    4: (["rock climbing", "football tactics"], ["harness", "goalkeeper", "sprint", "referee", "belay"]),
    5: (["cardiology", "mental health"], ["artery", "symptom", "fever", "ward", "nurse"]),
    6: (["tax planning", "stock markets"], ["ledger", "dividend", "audit", "broker", "invoice"]),
}
NAMES = {1: "science", 2: "software", 3: "law", 4: "sport", 5: "medicine", 6: "finance"}
VIDEOS = "id long, video_id string, summary string, domains array<string>, subject_id string"


def rows():
    rnd = random.Random(6)
    out, truth = [], {}
    for i in range(600):
        own = rnd.sample(sorted(WORDS), rnd.choice([1, 1, 2]))
        parts = []
        for s in own:
            a, b = rnd.sample(WORDS[s][1], 2)
            parts.append(f"The video explains how a {a} and a {b} work together in case {rnd.randrange(10**6)} of Name{rnd.randrange(500)}.".replace("of Name", "of " + "".join(rnd.choice("abcdefgh") for _ in range(6)) + " "))
        if i % 3 == 0:
            parts.append("The host calls it a verdict and not a photon.")
        out.append((i, f"v{i}", " ".join(parts), [rnd.choice(WORDS[s][0]) for s in own] if i % 2 else [], "x"))
        truth[i] = set(own)
    out += [(1000, "n", None, None, "x"), (1001, "b", " ", ["", None], "x"), (1002, "d", None, ["  Particle-Physics"], "x"), (1003, None, "Nothing known here at all.", None, "x"), (0, "v0", out[0][2], out[0][3], "x")]
    truth[1002] = {1}
    return out, truth


@pytest.fixture(scope="module")
def inputs(spark):
    data, truth = rows()
    terms = spark.createDataFrame([(100 * k + s, "domains", n) for s, (names, _) in WORDS.items() for k, n in enumerate(names, 1)] + [(500, "key_concepts", "x"), (501, "domains", None)], "term_id long, field string, name string")
    areas = spark.createDataFrame([(i, n, "") for i, n in NAMES.items()], "subject_id int, name string, scope_note string")
    labels = spark.createDataFrame([(f"v{i}", s) for i in range(0, 90) for s in truth[i]] + [(None, 1), ("gone", 2)], "video_id string, subject_id int")
    return spark.createDataFrame(data, VIDEOS), terms, areas, labels, truth


def test_accuracy(inputs):
    videos, terms, areas, labels, truth = inputs
    mixtures, leaves = S.subject_mixtures(videos, terms, areas, labels, S.SubjectParams(leaves=18))
    got = {}
    for r in S.assign_subjects(mixtures).collect():
        got.setdefault(r.id, set()).add(r.subject_id)
    held = [i for i in truth if i >= 90]  # no label of these was used
    assert sum(got.get(i) == truth[i] for i in held) / len(held) > 0.95
    assert not {1000, 1001, 1003} & set(got)
    assert {r.subject_id for r in leaves.collect()} == set(NAMES)
    counts = {r.subject_id: r.documents for r in S.composition(S.assign_subjects(mixtures), areas).collect()}
    assert sum(counts.values()) == sum(len(v) for v in got.values())


def test_without_labels_seeds_decide(inputs):
    videos, terms, areas, labels, truth = inputs
    seeds = {NAMES[s]: tuple(n.split()[0] for n in names) for s, (names, _) in WORDS.items()}
    mixtures, _ = S.subject_mixtures(videos, terms, areas, labels.limit(0), S.SubjectParams(leaves=18, seeds=seeds))
    got = {}
    for r in S.assign_subjects(mixtures).collect():
        got.setdefault(r.id, set()).add(r.subject_id)
    assert sum(got.get(i) == t for i, t in truth.items()) / len(truth) > 0.9


def test_empty(inputs):
    videos, terms, areas, labels, _ = inputs
    mixtures, leaves = S.subject_mixtures(videos.limit(0), terms, areas, labels)
    assert S.assign_subjects(mixtures).count() == 0 and leaves.count() == 0


def test_no_plan_is_wide(inputs, spark):
    """The driver's memory follows the largest plan: all exchanges are planned again after each stage."""
    videos, terms, areas, labels, _ = inputs
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    aliases = spark.createDataFrame([("Geology", "rocks")], "name string, form string")
    mixtures, _ = S.subject_mixtures(videos, terms, areas, labels, S.SubjectParams(leaves=18), aliases)
    S.assign_subjects(mixtures).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ran = store.executionsList()
    plans = [ran.apply(i).physicalPlanDescription() for i in range(before, ran.size())]
    wide = [len(re.findall(r"Exchange \(\d+\)", p.partition("== Initial Plan ==")[2] or p)) for p in plans]
    assert len(wide) > 10 and max(wide) <= 16
