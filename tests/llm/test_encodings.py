import random

import pytest

from cuemill.llm import encodings as E

FRENCH = "le modèle a été réparé près du marché même si la bactérie manquait déjà et le résumé reste léger après l'été pour une idée très précise".split()
GERMAN = "das schöne Gerät heißt müde und enthält größere Stücke natürlich später geöffnet während der Führung über dem Fluss am Fuß der Brücke".split()
RUSSIAN = "если пример не изменён начните сначала утром потом рисунок снова готов и это странный результат сегодня мы смотрим как вопрос меняется".split()
ENGLISH = "the quick brown fox isn’t here — “said” the narrator and the plain window was counted twice before lunch".split()


def sentences(rnd, words, n):
    return [" ".join(rnd.choice(words) for _ in range(9)).capitalize() + "." for _ in range(n)]


def swap(text, written, read):
    return E._read(text.encode(written), read)


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(2)
    rows, bad = [], {}
    for i in range(240):
        words = (FRENCH, GERMAN, RUSSIAN, ENGLISH)[i % 4]
        lines = sentences(rnd, words, 6)
        clean = "\n".join(lines)
        text = clean
        if i % 12 == 0:
            written, read = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("cp1252", "cp437"), ("cp1252", "mac_roman")][i // 12 % 5]
            text = "\n".join([swap(lines[0], written, read), *lines[1:]])
        elif i % 24 == 2:
            text = swap(clean, "utf-8", "cp1251" if i % 48 == 2 else "latin-1")
        elif i % 24 == 14:
            text = swap(clean, "cp1251", "koi8-r")
        elif i % 24 == 5:
            text = swap(swap(clean, "utf-8", "cp1252"), "utf-8", "cp1252")
        if text != clean:
            bad[i] = clean
        rows.append((i, f"source {i % 7}" if i % 10 else None, text, 3))
    decoys = ["┌─Box─┐ box sketch └───┘", "10 °C ± 2, µ = Ohm Ω — ok ✓", "名前 テスト", "NÃO PERCA A SESSÃO: AS LIÇÕES SÃO 3", "«Тест» прошёл", "½ cup, £3 × ³", "", None, "ascii only"]
    rows += [(1000 + k, "source 1", t, 3) for k, t in enumerate(decoys)]
    rows += [(2000, "source 1", "Le mod�le a �t� r�par�", 3), (2001, "source 2", "The dog isn\x92t here", 3)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, n_garbled int"), bad


def test_found_and_restored(table):
    df, bad = table
    out = {r.doc_id: r.restored for r in E.garbled(df).collect()}
    assert set(out) == set(bad) | {2000, 2001}
    same = sum(out[i] == clean for i, clean in bad.items())
    assert same >= 0.9 * len(bad)
    assert out[2000] == "Le modèle a été réparé" and out[2001] == "The dog isn’t here"


def test_empty_and_clean_tables(table):
    df, _ = table
    assert E.garbled(df.limit(0)).count() == 0
    assert E.garbled(df.where("doc_id = 1008")).count() == 0


def test_symbols_come_from_code_pages():
    s = E.symbols()
    assert "é" in s["Ã©"] and "é" in s["√©"] and "é" in s["├⌐"] and "’" in s["â€™"] and "Ç" in s["Ãƒâ€¡"]
    assert all(not k.isascii() for k in s)


def test_repeated_and_long_texts(spark):
    long = "plain words " * 40_000 + "dÃ©jÃ  vu et Ã©tÃ©"
    rows = [(1, "s", long), (1, "s", long)] + [(10 + i, "s", "déjà l'été a été réparé " * 5) for i in range(5)]
    out = E.garbled(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert [r.doc_id for r in out] == [1, 1] and out[0].restored.endswith("et été")


@pytest.mark.parametrize("page", ["cp1257", "cp737", "cp852"])
def test_pages_that_are_not_listed_are_found_beside_letters(page):
    """UTF-8 read under a page that the lists don't name; the same signs between spaces, or in their own script, are meant."""
    from collections import Counter

    import numpy as np

    assert page not in E.UTF8_READ_AS
    rnd = random.Random(8)
    clean = ["\n".join(sentences(rnd, (FRENCH, GERMAN)[i % 2], 6)) for i in range(80)]
    meant = ["Ć © ą ± è ½", "ένα μικρό κείμενο στα ελληνικά", "шла Саша по шоссе", "plain ├─┤ box"]
    texts = [swap(t, "utf-8", page) if i < 20 else t for i, t in enumerate(clean)] + meant
    size = E.alphabet().size
    pairs, contexts = np.zeros((size, size)), Counter()
    for t in texts:
        classes, found = E.occurrences(t)
        np.add.at(pairs, (np.append(E.Alphabet.SPACE, classes), np.append(classes, E.Alphabet.SPACE)), 1)
        contexts.update((s, l, r) for _, _, s, l, r in found)
    model = E.Cipher(pairs, E.GarbleParams())
    model.learn([(*k, n) for k, n in contexts.items()])
    got = [E.decide(t, model, model.shares, {}) for t in texts]
    assert sum(n > 0 for _, n in got[:20]) >= 19 and [n for _, n in got[20:]] == [0] * 64
    right = sum(a == b for (x, _), y in zip(got[:20], clean) for a, b in zip(x.split(), y.split()))
    assert right / sum(len(t.split()) for t in clean[:20]) > 0.9
