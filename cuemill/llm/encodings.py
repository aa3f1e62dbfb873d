"""Problem 9: text decoded with the wrong character encoding.

Method: a swap of code pages is read as a substitution cipher. Its symbols are the images of letters under pairs of code
pages (one to six characters each) and the replacement character; images of UTF-8 under pages that are rarely met, by rule all
that Python knows, are symbols beside a plain letter only. Which letter a symbol stands for, or whether it is meant as it
stands, is learned by expectation-maximisation against letter bigrams of the corpus: first for the whole corpus, then for
each source, whose own counts move the mapping away from the corpus's. The bigrams are re-estimated with the garbled
symbols taken out. Every occurrence is then decided from the source's mapping and the letters around it, and the
text is restored by substituting the garbled symbols.

Only sufficient statistics leave the tasks: bigram counts and counts of (left letter, symbol, right letter) per source,
whose number is bounded by the alphabet, not by the rows.

Defined results: null and empty texts are never garbled; a text is read whole; a null source is the source ""; U+FFFD and C1
control characters are always garbled, U+FFFD being restored as the likeliest letter; signs and scripts that are no image
of a letter are left alone; repeated rows are repeated.
"""

from __future__ import annotations

import codecs
import encodings
import math
import pkgutil
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuemill.runtime import cut, weighted_lookup

#: Letters and signs that ordinary text holds beyond ASCII, by rule: Latin-1 and the European part of Latin Extended-A, Cyrillic, typography.
LATIN = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
EXTENDED = [chr(c) for c in range(0x100, 0x180)]
CYRILLIC = [chr(c) for c in range(0x400, 0x460)] + ["Ґ", "ґ"]
TYPOGRAPHY = list("‘’‚“”„–—…•€™«»¿¡§©®°·£ªº №")
#: Wrong readings of UTF-8, and (written, read) pairs of single-byte code pages.
UTF8_READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "koi8-r", "cp866", "iso8859-15")
SINGLE_BYTE = (
    ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1250"), ("cp1252", "cp1251"),
    ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"),
)
#: Swaps that turn whole Cyrillic words into other words: every letter is a symbol, so they are judged word by word.
WHOLE_WORD = (("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp1252"), ("koi8-r", "cp1252"), ("cp866", "cp1251"), ("cp1251", "cp866"))
COMMON = [c for c in LATIN if c not in "ÐÞðþ"] + list("‘’“”–—…œŒ€")
LOST = "�"


@dataclass(frozen=True)
class GarbleParams:
    iterations: int = 8
    #: Pseudo-counts with which the corpus's mapping enters a source's own.
    prior: float = 8.0
    smoothing: float = 0.5
    #: Posterior from which a symbol of several characters, one of a rarer page, one of a single character, and a quote, dash or
    #: dot counts as garbled.
    several: float = 0.5
    rare: float = 0.9
    single: float = 0.9
    sign: float = 0.9995
    #: Lead in log-likelihood that a run of six letters needs to count as a swapped word; shorter runs need less in proportion.
    word_lead: float = 6.0
    #: Pseudo-count of letters that stand clean nowhere in the corpus, so that they remain possible readings.
    unseen: float = 0.02


def _read(data: bytes, page: str) -> str:
    """Bytes in a code page; a byte without a meaning there becomes the C1 character of its number."""
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(page))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@lru_cache(maxsize=1)
def symbols() -> dict[str, tuple[str, ...]]:
    """symbol -> letters it may stand for."""
    out: dict[str, set[str]] = defaultdict(set)
    for c in LATIN + EXTENDED + CYRILLIC + TYPOGRAPHY:
        for page in UTF8_READ_AS:
            once = _read(c.encode(), page)
            out[once].add(c)
            if page in ("cp1252", "latin-1"):
                out[_read(once.encode(), page)].add(c)
    for written, read in SINGLE_BYTE:
        for c in COMMON:
            try:
                image = _read(c.encode(written), read)
            except UnicodeEncodeError:
                continue
            if not image.isascii() and image != c:
                out[image].add(c)
    for b in range(0x80, 0xA0):
        meant = {bytes([b]).decode(p, "ignore") for p in ("cp1252", "cp437", "mac_roman")} - {"", chr(b)}
        out[chr(b)] |= {c for c in meant if c in COMMON or c in TYPOGRAPHY}
    for s in [s for s in out if s.isascii() or len(s) == 1 and s.isspace()]:
        del out[s]
    out[LOST] = set(COMMON)
    return {s: tuple(sorted(c)) for s, c in out.items()}


@lru_cache(maxsize=1)
def _pages() -> tuple[str, ...]:
    """All single-byte code pages that extend ASCII and that Python knows, by rule, without those of UTF8_READ_AS."""
    out, ascii_part = [], bytes(range(0x20, 0x7F))
    for name in sorted(m.name for m in pkgutil.iter_modules(encodings.__path__) if not m.name.endswith("escape")):
        try:
            table = "".join(bytes([b]).decode(name, "ignore") for b in range(0x80, 0x100))
            fits = ascii_part.decode(name) == ascii_part.decode("ascii") and all(len(bytes(x).decode(name, "replace")) == 2 for x in ((0xC3, 0xA9), (0x83, 0x41)))
        except (LookupError, ValueError, TypeError, AssertionError):  # no code page for text
            continue
        if fits and 96 <= len(table) <= 128:
            out.append(name)
    known = {codecs.lookup(p).name for p in UTF8_READ_AS}
    return tuple(p for p in out if codecs.lookup(p).name not in known)


@lru_cache(maxsize=1)
def rare_symbols() -> dict[str, tuple[str, ...]]:
    """Images of letters under all further pages: pairs of characters -> letters. As they are many and may be meant, they count only
    beside a plain letter, and from a higher posterior on."""
    out: dict[str, set[str]] = defaultdict(set)
    for page in _pages():
        for c in LATIN + EXTENDED:
            image = _read(c.encode(), page)
            if len(image) == 2 and not any(x.isascii() or x.isspace() for x in image) and image not in symbols():
                out[image].add(c)
    return {s: tuple(sorted(c)) for s, c in out.items()}


def readings_of(symbol: str) -> tuple[str, ...]:
    return symbols().get(symbol) or rare_symbols()[symbol]


def _trie(words: Iterable[str]) -> str:
    """A regular expression for a set of words that tries the longest first and shares prefixes."""
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def build(node: dict) -> str:
        singles = [k for k, v in node.items() if k and set(v) == {""}]
        longer = [re.escape(k) + build(v) for k, v in node.items() if k and set(v) != {""}]
        options = longer + (["[" + "".join(map(re.escape, singles)) + "]"] if singles else [])
        body = "(?:" + "|".join(options) + ")"
        return body + "?" if "" in node else body

    return build(root)


class Alphabet:
    """Character classes of the bigram model: letters one by one, digits, spaces and other signs as one class each."""

    OTHER, SPACE, DIGIT, SIGN, UNKNOWN = range(5)

    def __init__(self):
        single = {s for s in symbols() if len(s) == 1}
        letters = [chr(c) for c in (*range(65, 91), *range(97, 123))] + sorted({*LATIN, *EXTENDED, *CYRILLIC, *TYPOGRAPHY, *single} - {" ", LOST})
        self.table = np.zeros(0x110000, np.uint16)
        self.table[:128] = self.SIGN
        for c in (*b" \t\n\r\x0b\x0c", 0xA0, 0x2028, 0x2029):
            self.table[c] = self.SPACE
        self.table[48:58] = self.DIGIT
        self.of = {c: 5 + i for i, c in enumerate(letters)}
        for c, k in self.of.items():
            self.table[ord(c)] = k
        self.table[0xFFFD] = self.UNKNOWN
        self.size = 5 + len(letters)
        self.single = np.zeros(0x110000, bool)
        self.foreign = np.zeros(0x110000, bool)  # symbols that are no letter of the texts' scripts, inside words
        self.cyrillic = np.zeros(0x110000, bool)
        self.cyrillic[0x400:0x530] = True
        self.latin = np.zeros(0x110000, bool)
        for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(LATIN):
            self.latin[ord(c)] = True
        for c in single:
            self.single[ord(c)] = True
            self.foreign[ord(c)] = c not in LATIN and c not in EXTENDED and c not in CYRILLIC and c not in TYPOGRAPHY
        self.several = re.compile(_trie(s for s in symbols() if len(s) > 1))
        rare = rare_symbols()
        self.rare = re.compile("[" + "".join(sorted(map(re.escape, {s[0] for s in rare}))) + "][" + "".join(sorted(map(re.escape, {s[1] for s in rare}))) + "]")

    def classes(self, text: str) -> np.ndarray:
        return np.array([self.of.get(c, int(self.table[ord(c)])) for c in text])


@lru_cache(maxsize=1)
def alphabet() -> Alphabet:
    return Alphabet()


def _images(text: str, box: np.ndarray, several: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``several`` without the symbols that are part of a drawing: those of box-drawing characters alone that touch no letter, or
    in whose line a box-drawing character stands that belongs to no symbol."""
    covered = np.zeros(len(box), bool)
    for s, e in several:
        covered[s:e] = True
    stray = np.flatnonzero(box & ~covered)

    def meant(s: int, e: int) -> bool:
        if not box[s:e].all():
            return False
        begin, end = text.rfind("\n", 0, s) + 1, text.find("\n", e)
        k = np.searchsorted(stray, begin)
        return k < len(stray) and (end < 0 or stray[k] < end) or not text[max(0, s - 1) : s].isalpha() and not text[e : e + 1].isalpha()

    return [x for x in several if not meant(*x)]


def _rare(text: str, several: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Rare symbols that touch a plain letter and no other symbol's characters."""
    known, out, taken = rare_symbols(), [], None
    for m in alphabet().rare.finditer(text):
        s, e = m.span()
        beside = text[s - 1 : s] + text[e : e + 1]
        if m[0] in known and any(c.isascii() and c.isalpha() for c in beside):
            taken = {i for x in several for i in range(*x)} if taken is None else taken
            if s not in taken and e - 1 not in taken:
                out.append((s, e))
    return out


def occurrences(text: str) -> tuple[np.ndarray, list[tuple[int, int, str, int, int]]]:
    """Classes of all characters, and (start, end, symbol, left class, right class) of every symbol, in order.

    A neighbour that is itself part of a symbol is unknown, so that runs of garbled letters don't vouch for each other.
    """
    a = alphabet()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = a.table[points].astype(np.int64)
    several = [(m.start(), m.end()) for m in a.several.finditer(text)]
    several += _rare(text, several)
    box = (points >= 0x2500) & (points < 0x2580)
    if box.any():
        several = _images(text, box, several)
    single = a.single[points]
    cyrillic = single & a.cyrillic[points]
    if cyrillic.any():
        # Cyrillic letters are symbols of a Latin text only where they touch its letters
        latin = np.concatenate([[False], a.latin[points], [False]])
        single &= ~cyrillic | latin[:-2] | latin[2:]
    if box.any():
        # box-drawing characters in a row are a drawing
        beside = np.concatenate([[False], box, [False]])
        single &= ~box | ~(beside[:-2] | beside[2:])
    for s, e in several:
        single[s:e] = False
        classes[s:e] = a.UNKNOWN
    alone = np.flatnonzero(single)
    around = classes.copy()
    around[a.foreign[points]] = a.UNKNOWN
    edge = np.concatenate([[a.SPACE], around, [a.SPACE]])
    out = [(s, e, text[s:e], int(edge[s]), int(edge[e + 1])) for s, e in several]
    out += [(i, i + 1, text[i], int(edge[i]), int(edge[i + 2])) for i in alone.tolist()]
    out.sort()
    return classes, out


def _statistics(docs: DataFrame) -> DataFrame:
    """(source, symbol, l, r, n): counts of symbols in context per source, and with the empty symbol the corpus's bigrams."""
    names = ["source", "symbol", "l", "r", "n"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = alphabet().size
        pairs, contexts, codes, waiting = np.zeros(size * size, np.int64), Counter(), [], 0
        for b in batches:
            for source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                classes, found = occurrences(text)
                codes.append(np.append(Alphabet.SPACE, classes) * size + np.append(classes, Alphabet.SPACE))
                waiting += len(codes[-1])
                if waiting > 1_000_000:
                    pairs += np.bincount(np.concatenate(codes), minlength=size * size)
                    codes, waiting = [], 0
                contexts.update((source, s, l, r) for _, _, s, l, r in found)
            if len(contexts) > 200_000:
                yield _rows(contexts, names)
                contexts = Counter()
        yield _rows(contexts, names)
        if codes:
            pairs += np.bincount(np.concatenate(codes), minlength=size * size)
        seen = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([""] * len(seen), pa.string()), pa.array([""] * len(seen), pa.string()), pa.array(seen // size, pa.int32()), pa.array(seen % size, pa.int32()), pa.array(pairs[seen], pa.int64())], names
        )

    return docs.mapInArrow(scan, "source string, symbol string, l int, r int, n long")


def _rows(contexts: Counter, names: list[str]) -> pa.RecordBatch:
    keys = list(contexts)
    columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int32()), pa.array([k[3] for k in keys], pa.int32()), pa.array([contexts[k] for k in keys], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names)


def unswapped(pairs: np.ndarray, rounds: int = 20, meant_weight: float = 0.7) -> np.ndarray:
    """Bigram counts without those of words whose letters were swapped as a whole.

    Expectation-maximisation: each count is shared between "meant" and, for every swap, "written as its image", in proportion
    to how often the image is meant and how common the swap is. "Meant" explains anything, so it weighs a little less:
    counts that a swap explains as well leave, others stay.
    """
    a = alphabet()
    maps = []
    for table in _word_swaps()[1]:
        m = np.full(len(pairs), -1)
        m[: a.UNKNOWN] = np.arange(a.UNKNOWN)  # spaces, digits and signs stay
        for read, written in table.items():
            k = a.of.get(chr(read))
            if k is not None and written in a.of:
                m[k] = a.of[written]
        maps.append(m)
    counts = pairs.astype(float)
    rows = np.flatnonzero(np.any([m >= 5 for m in maps], axis=0) | (np.arange(len(pairs)) < a.UNKNOWN))
    at = np.ix_(rows, rows)
    letters = np.add.outer(rows >= 5, rows >= 5) > 0
    meant, rate = counts.copy(), [0.3] * len(maps)
    for _ in range(rounds):
        shares = []
        for m, r in zip(maps, rate):
            x = m[rows]
            image = meant[np.ix_(np.maximum(x, 0), np.maximum(x, 0))]
            shares.append(np.where(letters & (x >= 0)[:, None] & (x >= 0)[None, :], r * image, 0.0))
        whole = meant_weight * meant[at] + sum(shares)
        part = np.divide(counts[at], whole, out=np.zeros_like(whole), where=whole > 0)
        # garbled mass over the mass of what it is an image of
        rate = [min(1.0, r * float((part * x).sum()) / max(float(x.sum()), 1e-9)) for r, x in zip(rate, shares)]
        meant[at] = meant_weight * meant[at] * part
    return meant


class Cipher:
    """The learned mapping: log-probabilities of letters by bigrams, and shares of each symbol's readings."""

    def __init__(self, pairs: np.ndarray, params: GarbleParams):
        self.params = params
        self.base = unswapped(pairs)
        self.seen = self.base.sum(0)
        self.logs = self._model(self.base)
        self.shares: dict[str, dict[str, float]] = {}
        self.known: dict[tuple[str, int, int], dict[str, float]] = {}
        self.first: dict[str, dict[str, float]] = {}

    def _model(self, counts: np.ndarray) -> np.ndarray:
        counts = np.maximum(counts, 0)
        k = self.params.smoothing
        freq = counts.sum(0) + 0.01
        logs = np.log((counts + k * len(counts) * freq / freq.sum() * 0.02 + 1e-3) / (counts.sum(1, keepdims=True) + k * len(counts) * 0.02 + 1e-3 * len(counts)))
        logs[Alphabet.UNKNOWN, :] = 0.0
        logs[:, Alphabet.UNKNOWN] = 0.0
        return logs

    def start(self, symbol: str) -> dict[str, float]:
        """Shares before any evidence."""
        if symbol not in self.first:
            self.first[symbol] = self._start(symbol)
        return self.first[symbol]

    def _start(self, symbol: str) -> dict[str, float]:
        letters = readings_of(symbol)
        if symbol == LOST or "\x80" <= symbol <= "\x9f":
            return {c: 1 / len(letters) for c in letters} or {LOST: 1.0}
        # a single letter that no text of the corpus holds is no reading; the image of several bytes is its own evidence, so
        # that letters which stand garbled only are found too
        weight = {c: 1.0 if self.seen[_classes(c)[0]] > 0 else self.params.unseen * (len(symbol) > 1) for c in letters}
        whole = sum(weight.values())
        if not whole:
            return {symbol: 1.0}
        meant = 0.7 if len(symbol) == 1 else 0.5 if symbol in rare_symbols() else 0.02
        return {symbol: meant} | {c: (1 - meant) * w / whole for c, w in weight.items() if w}

    def likelihood(self, symbol: str, l: int, r: int) -> dict[str, float]:
        """Likelihood of the neighbours under every reading, relative to the best; kept, as it doesn't depend on the source."""
        key = (symbol, l, r)
        if key not in self.known:
            scores = {}
            for c in self.start(symbol):
                k = _classes(c)
                scores[c] = float(self.logs[l, k[0]] + self.logs[k[-1], r] + sum(self.logs[x, y] for x, y in zip(k, k[1:])))
            top = max(scores.values())
            self.known[key] = {c: math.exp(s - top) for c, s in scores.items()}
        return self.known[key]

    def readings(self, symbol: str, l: int, r: int, shares: dict[str, float] | None = None) -> dict[str, float]:
        """Posterior of every reading of one occurrence; the symbol itself stands for "meant as it is"."""
        shares = shares or self.shares.get(symbol) or self.start(symbol)
        odds = {c: max(shares.get(c, 0.0), 1e-9) * x for c, x in self.likelihood(symbol, l, r).items()}
        whole = sum(odds.values())
        return {c: o / whole for c, o in odds.items()}

    def learn(self, contexts: list[tuple[str, int, int, int]], prior: dict[str, dict[str, float]] | None = None, iterations: int | None = None) -> dict[str, dict[str, float]]:
        """Expectation-maximisation over (symbol, l, r, n). With a prior the bigrams stay and only the shares are learned."""
        shares = {s: dict((prior or {}).get(s) or self.start(s)) for s in {c[0] for c in contexts}}
        for _ in range(iterations or self.params.iterations):
            counts = defaultdict(lambda: defaultdict(float))
            moved = None if prior else self.base.copy()
            for s, l, r, n in contexts:
                for c, p in self.readings(s, l, r, shares[s]).items():
                    counts[s][c] += n * p
                    if moved is not None and c != s and c != LOST:
                        k = self_class(c)
                        moved[l, k] += n * p
                        moved[k, r] += n * p
                        if len(s) == 1 and s != LOST:
                            q = self_class(s)
                            moved[l, q] -= n * p
                            moved[q, r] -= n * p
            if moved is not None:
                self.logs, self.known = self._model(moved), {}
            for s, own in counts.items():
                before = (prior or {}).get(s) or self.start(s)
                weight = self.params.prior if prior else 1.0
                whole = sum(own.values()) + weight
                shares[s] = {c: (own.get(c, 0.0) + weight * p) / whole for c, p in before.items()}
        if prior is None:
            self.shares = shares
        return shares


@lru_cache(maxsize=100_000)
def _classes(text: str) -> tuple[int, ...]:
    a = alphabet()
    return tuple(a.of.get(c, int(a.table[ord(c)])) for c in text)


def self_class(c: str) -> int:
    return _classes(c)[0]


@lru_cache(maxsize=1)
def _word_swaps() -> tuple[re.Pattern, list[dict[int, str]]]:
    """Runs of letters that may be Cyrillic words under a swap, and per swap the table from read to written letters."""
    tables, images = [], set()
    for written, read in WHOLE_WORD:
        pairs = {}
        for c in CYRILLIC:
            try:
                pairs[ord(_read(c.encode(written), read))] = c
            except UnicodeEncodeError:
                continue
        tables.append(pairs)
        images |= {chr(c) for c in pairs}
    return re.compile("[" + "".join(sorted(map(re.escape, images))) + "]+"), tables


def swapped_word(word: str, cipher: Cipher, memory: dict) -> tuple[str, float]:
    """The likeliest reading of a run of letters and its lead in log-likelihood over the run as it stands."""
    if word not in memory:
        def score(w: str) -> float:
            k = (Alphabet.SPACE, *_classes(w), Alphabet.SPACE)
            return float(sum(cipher.logs[x, y] for x, y in zip(k, k[1:])))

        own, best = score(word), (word, 0.0)
        for table in _word_swaps()[1]:
            if all(ord(c) in table for c in word):
                other = word.translate(table)
                lead = score(other) - own
                if lead > best[1]:
                    best = (other, lead)
        if len(memory) > 200_000:
            memory.clear()
        memory[word] = best
    return memory[word]


def whole_words(text: str, cipher: Cipher, memory: dict) -> tuple[str, int]:
    """Undo swaps of whole words: one long word with a clear lead, or a line most of whose words lead, make a text suspect;
    its other words then follow."""
    pattern, need = _word_swaps()[0], cipher.params.word_lead
    runs = [(m.start(), m.end(), *swapped_word(m[0], cipher, memory)) for m in pattern.finditer(text)]
    suspect = any(e - s >= 3 and lead >= 2 * need * min(1.0, (e - s) / 6) for s, e, _, lead in runs)
    if not suspect and any(lead > 1.0 for _, _, _, lead in runs):
        lines: dict[int, list[float]] = defaultdict(list)
        for s, e, _, lead in runs:
            if e - s >= 3:
                lines[text.count("\n", 0, s)].append(lead)
        suspect = any(sum(x) >= 2 * need and sum(v > 0.5 for v in x) >= 0.6 * len(x) for x in lines.values())
    if not suspect:
        return text, 0
    out, at, n = [], 0, 0
    for s, e, word, lead in runs:
        if lead > 1.0:
            out += [text[at:s], word]
            at, n = e, n + 1
    return "".join(out) + text[at:], n


def decide(text: str, cipher: Cipher, shares: dict[str, dict[str, float]], memory: dict) -> tuple[str, int]:
    """The restored text and the number of garbled symbols."""
    out, at, n = [], 0, 0
    p = cipher.params
    for s, e, symbol, l, r in occurrences(text)[1]:
        key = (symbol, l, r)
        if key not in memory:
            odds = cipher.readings(symbol, l, r, shares.get(symbol))
            best = max((c for c in odds if c != symbol), key=lambda c: (odds[c], c), default=None)
            certain = symbol == LOST or len(symbol) == 1 and "\x80" <= symbol <= "\x9f"
            least = p.rare if symbol in rare_symbols() else p.several if len(symbol) > 1 else p.sign if symbol in TYPOGRAPHY else p.single
            wrong = certain or 1 - odds.get(symbol, 0.0) >= least
            memory[key] = (best or symbol) if wrong else None
        if memory[key] is not None:
            out += [text[at:s], memory[key]]
            at, n = e, n + 1
    restored = "".join(out) + text[at:]
    restored, words = whole_words(restored, cipher, memory.setdefault("words", {}))
    return restored, n + words


def garbled(docs: DataFrame, params: GarbleParams = GarbleParams(), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, n_garbled, restored) of every document with at least one garbled symbol."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text")).where("text IS NOT NULL AND text <> ''")
    counts = cut(_statistics(rows.select("source", "text")).groupBy("source", "symbol", "l", "r").agg(F.sum("n").alias("n")))
    # bounded by the alphabet: bigrams, and symbols in context over the whole corpus
    size = alphabet().size
    pairs = np.zeros((size, size))
    for r in counts.where("symbol = ''").groupBy("l", "r").agg(F.sum("n").alias("n")).toLocalIterator():
        pairs[r.l, r.r] = r.n
    corpus = [tuple(r) for r in counts.where("symbol <> ''").groupBy("symbol", "l", "r").agg(F.sum("n").alias("n")).toLocalIterator()]
    model = Cipher(pairs, params)
    model.learn(corpus)
    shared = spark.sparkContext.broadcast(model)

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        contexts = list(zip(pdf["symbol"], pdf["l"], pdf["r"], pdf["n"]))
        shares = m.learn(contexts, prior=m.shares, iterations=3)
        flat = [(s, c, p) for s, x in shares.items() for c, p in x.items() if p > 1e-4]
        return pd.DataFrame({"source": [pdf["source"].iloc[0]], "mapping": [[{"s": s, "c": c, "p": p} for s, c, p in flat]]})

    # every symbol is learned source by source; a source's contexts are bounded by the alphabet, whatever share of the rows it has
    mapping = counts.where("symbol <> ''").groupBy("source").applyInPandas(own, "source string, mapping array<struct<s:string,c:string,p:double>>")
    suspects = rows.where(F.col("text").rlike(r"[^\x00-\x7f]"))
    uses = suspects.groupBy("source").agg(F.count("*").alias("uses"))
    mapping = cut(uses.join(mapping, "source", "left"))
    suspects = weighted_lookup(suspects, mapping, ["source"], "uses")

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        known: dict[str, tuple[dict, dict]] = {}
        for b in batches:
            out: list[list] = [[], [], []]
            maps = b.column(3)
            for i, (doc, src, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())):
                if src not in known:
                    shares = dict(m.shares)
                    for x in maps[i].as_py() or []:
                        if x["s"] not in shares or shares[x["s"]] is m.shares.get(x["s"]):
                            shares[x["s"]] = {}
                        shares[x["s"]][x["c"]] = x["p"]
                    if len(known) > 5_000:
                        known.clear()
                    known[src] = (shares, {})
                restored, n = decide(t, m, *known[src])
                if n:
                    for column, value in zip(out, (doc, n, restored)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.string()))], ["doc_id", "n_garbled", "restored"])

    return suspects.select(F.col("doc_id").cast("long"), "source", "text", "mapping").mapInArrow(apply, "doc_id long, n_garbled int, restored string")
