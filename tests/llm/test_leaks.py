import random

import pytest

from cuemill.llm import leaks as L

RND = random.Random(9)
VOCAB = [f"word{i}" for i in range(900)] + ["the", "of", "and", "a", "that"] * 60
END = "which of the following statements best explains this result".split()
QUESTIONS = [(i, [RND.choice(VOCAB) for _ in range(RND.randint(44, 58))] + END) for i in range(30)]
INDEX = L.LeakIndex([(i, " ".join(w)) for i, w in QUESTIONS], L.LeakParams())


def held(words):
    return {INDEX.ids[k] for _, k, _ in INDEX.search([" ".join(words)])}


def noise(n):
    return [RND.choice(VOCAB) for _ in range(n)]


def test_run_rule():
    assert L.unchanged_run(25, 8) == 6 and L.unchanged_run(8, 8) == 4 and [x.run for x in INDEX.blocks] == [6]


@pytest.mark.parametrize("case", range(12))
def test_whole_half_and_changed(case):
    i, w = QUESTIONS[case]
    half = -(-len(w) // 2)
    assert held(noise(50) + w + noise(20)) == {i}
    assert held(noise(20) + w[:half] + noise(20)) == {i}
    assert held(noise(20) + w[: half - 4] + noise(20)) == set()
    changed = list(w)
    for k in range(4, len(w) - 4, 9):
        changed[k] = "different"
    assert held(noise(9) + changed + noise(9)) == {i}
    many = [x if k % 4 else "different" for k, x in enumerate(w)]
    assert held(noise(9) + many + noise(9)) == set()
    lost = [x for k, x in enumerate(w) if k % 10 != 5]
    assert held(lost) == {i}


def test_shared_endings_and_order():
    assert held(noise(40) + END + noise(40)) == set()
    w = QUESTIONS[0][1]
    assert held([x for k in range(0, len(w), 2) for x in reversed(w[k : k + 2])]) == set()


def test_a_shared_ending_weighs_little():
    ending = INDEX._codes(INDEX.words[0][-len(END) :])
    for s, w in zip(INDEX.shingles, INDEX.weights):
        import numpy as np

        assert w[np.isin(s, ending)].sum() < 0.08 * w.sum()


def test_a_long_shared_ending_is_no_leak_of_the_others():
    """Items of 24 words whose last 11 are the same: an ending is under a half and below the weight asked."""
    end = [f"tail{i}" for i in range(11)]
    index = L.LeakIndex([(i, " ".join([f"own{i}x{j}" for j in range(13)] + end)) for i in range(20)], L.LeakParams())
    assert index.search([" ".join(noise(30) + end + noise(30))]) == []
    whole = [f"own4x{j}" for j in range(13)] + end
    assert {index.ids[k] for _, k, _ in index.search([" ".join(noise(30) + whole)])} == {4}


def test_a_short_item_shortens_its_own_blocks_only():
    index = L.LeakIndex([(i, " ".join(w)) for i, w in QUESTIONS] + [(77, "seven odd words make up this one")], L.LeakParams())
    assert sorted(x.run for x in index.blocks) == [4, 6] or len(index.blocks) == 2
    assert {index.ids[k] for _, k, _ in index.search(["so seven odd words make up this one here"])} == {77}
    assert {index.ids[k] for _, k, _ in index.search([" ".join(QUESTIONS[2][1])])} == {2}


def test_the_longest_passage_is_reported():
    i, w = QUESTIONS[6]
    half = -(-len(w) // 2)
    assert [n for _, _, n in INDEX.search([" ".join(noise(9) + w[:half] + noise(40) + w + noise(9))])] == [len(w)]


def test_long_tags_are_markup():
    w = QUESTIONS[8][1]
    tag = '<a href="' + "x" * 400 + '">'
    assert held(noise(5) + [t for k in range(0, len(w), 4) for t in [tag, *w[k : k + 4]]]) == {8}


def test_markup_stamps_and_case():
    w = QUESTIONS[3][1]
    text = "\n".join(f"[00:{k:02d}] <b>{' '.join(w[k : k + 7]).upper()}</b>, **" for k in range(0, len(w), 7))
    assert {INDEX.ids[k] for _, k, _ in INDEX.search([text, ""])} == {3}


def test_near_finds_every_fingerprint_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        blocks = INDEX.blocks[0]
        k = rng.integers(len(blocks.prints))
        flips = rng.choice(64, 3, replace=False)
        probe = blocks.prints[k] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        assert k in set(blocks.near(np.array([probe]), 3)[1].tolist())


def test_operator(spark):
    items = spark.createDataFrame([(i, " ".join(w), 1) for i, w in QUESTIONS] + [(99, None, 1), (98, "", 1)], "item_id long, question string, doc_id int")
    w = " ".join(QUESTIONS[5][1])
    docs = spark.createDataFrame([(1, "x " * 100_000 + w, 2), (2, None, 2), (3, "", 2), (4, "nothing here", 2), (1, w, 2)], "doc_id long, text string, item_id int")
    for params in (L.LeakParams(), L.LeakParams(block_items=7)):
        out = L.leaks(docs, items, params).collect()
        assert [(r.doc_id, r.item_id) for r in out] == [(1, 5), (1, 5)] and all(r.words >= r.item_words / 2 for r in out)
    assert L.leaks(docs.limit(0), items).count() == 0
    assert L.leaks(docs, items.limit(0)).count() == 0
