"""Problem 8: evaluation texts leaking into training text.

Method: SimHash windows with multi-index Hamming blocks, then exact verification. A document holds an item when it holds
at least half of the item's words as one passage, in order, with at most one word in eight changed. A passage of n words with
n // 8 changes has an unchanged run of 6 words for every n from 22 on, so an item-sized passage is fingerprinted as the
sequence of SimHashes of its blocks of so many words: some block of every such passage is within the radius of the item's.
The 64-bit block fingerprints are indexed in four tables of 16 bits, which finds every fingerprint within Hamming
distance 3. Candidates are verified by the similarity of their weighted shingles, word pairs that count the less the more items
hold them, so that an ending shared by many items counts for little; then they are aligned word by word.

An item with fewer than 22 words in half gets shorter blocks by the same rule, in an index of its own. Case, punctuation, line breaks, mark-up and time
stamps are removed from both sides first. Defined results: null and empty texts and questions hold nothing; a document is
read whole; repeated documents and items repeat their rows; ties in alignment don't matter, as only existence is reported.
"""

from __future__ import annotations

import difflib
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
STAMP = re.compile(r"(?<![\d:.])\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?(?![\d:])")
MARKUP = re.compile(r"<[^<>\s][^<>\n]*>|\]\([^()\s]*\)|&(?:#\d+|#x[\da-f]+|[a-z]+);|[­​-‍⁠﻿]", re.I)


@dataclass(frozen=True)
class LeakParams:
    radius: int = 3
    #: Share of the item's words that a passage must span, and one changed word in so many.
    share: float = 0.5
    changed: int = 8
    #: Items indexed at once; more are searched for in further passes over the corpus.
    block_items: int = 20_000
    #: Words of a shingle, and the least share of an item's shingle weight that a candidate passage must hold.
    shingle: int = 2
    similarity: float = 0.2


def plain_words(text: str) -> list[str]:
    if ":" in text:
        text = STAMP.sub(" ", text)
    if "<" in text or "&" in text or "](" in text or not text.isascii():
        text = MARKUP.sub(lambda m: html.unescape(m[0]) if m[0][0] == "&" else "" if len(m[0]) == 1 else " ", text)
    return WORD.findall(text.lower())


def unchanged_run(words: int, changed: int) -> int:
    """Longest run that every passage of at least ``words`` words, one in ``changed`` of them changed, must leave whole."""
    return max(1, min(math.ceil((n - n // changed) / (n // changed + 1)) for n in range(words, words + 8 * changed)))


class _Blocks:
    """Multi-index Hamming tables over the SimHashes of all blocks of ``run`` words of some items."""

    def __init__(self, run: int, items: list[tuple[int, np.ndarray]], planes: np.ndarray):
        self.run = run
        places = [np.arange(len(w) - run + 1) for _, w in items]
        self.prints = np.concatenate([simhashes(w, at, run, planes) for (_, w), at in zip(items, places)])
        self.owner = np.concatenate([np.full(len(at), k, np.int32) for (k, _), at in zip(items, places)])
        self.place = np.concatenate(places).astype(np.int32)
        self.tables = []
        for b in range(4):
            slots = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            order = np.argsort(slots, kind="stable")
            self.tables.append((order.astype(np.int32), np.searchsorted(slots[order], np.arange(65537)).astype(np.int32)))

    def near(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``prints``, row of the index) of all pairs within the radius, which four tables guarantee up to 3."""
        rows, hits = [], []
        for b, (order, start) in enumerate(self.tables):
            slots = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            n = start[slots + 1] - start[slots]
            some = np.flatnonzero(n)
            n = n[some]
            row = np.repeat(some, n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            hit = order[np.repeat(start[slots[some]], n) + step]
            close = np.bitwise_count(prints[row] ^ self.prints[hit]) <= radius
            rows.append(row[close])
            hits.append(hit[close])
        return np.concatenate(rows), np.concatenate(hits)


def simhashes(ids: np.ndarray, at: np.ndarray, run: int, planes: np.ndarray) -> np.ndarray:
    """64-bit SimHashes of the blocks of ``run`` words that begin at ``at``."""
    total = planes[ids[at]].copy()
    for k in range(1, run):
        total += planes[ids[at + k]]
    return np.packbits(total > 0, axis=1).view(np.uint64).ravel()


class LeakIndex:
    """SimHash index of the items, small enough to be sent to every task: its size is bounded by ``block_items``."""

    def __init__(self, items: list[tuple[int, str]], params: LeakParams):
        self.params = params
        texts = [(i, plain_words(q or "")) for i, q in items if i is not None]
        texts = [(i, w) for i, w in texts if w]
        df = Counter(x for _, w in texts for x in set(w))
        self.vocab = {w: k + 1 for k, w in enumerate(sorted(df))}
        weight = np.ones(len(self.vocab) + 1)
        for w, n in df.items():
            weight[self.vocab[w]] = math.log(1 + len(texts) / n)
        self.ids = [i for i, _ in texts]
        self.words = [np.array([self.vocab[x] for x in w], np.int32) for _, w in texts]
        self.shingles = [np.unique(self._codes(w)) for w in self.words]
        held = Counter(x for s in self.shingles for x in s.tolist())
        self.weights = [np.log(1 + len(texts) / np.array([held[x] for x in s.tolist()] or [1.0]))[: len(s)] for s in self.shingles]
        rng = np.random.default_rng(7)
        scale = np.clip(np.round(weight / max(weight.max(), 1e-9) * 4), 1, 4).astype(np.int8)
        self.planes = np.where(rng.integers(0, 2, (len(self.vocab) + 1, 64)), 1, -1).astype(np.int8) * scale[:, None]
        runs: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for k, w in enumerate(self.words):
            runs[min(6, unchanged_run(max(1, math.ceil(len(w) * params.share)), params.changed))].append((k, w))
        self.blocks = [_Blocks(run, own, self.planes) for run, own in sorted(runs.items())]

    def _codes(self, ids: np.ndarray) -> np.ndarray:
        """A code for every run of ``shingle`` words; runs with an unknown word have a code that no item has."""
        code = np.zeros(max(0, len(ids) - self.params.shingle + 1), np.int64)
        for k in range(self.params.shingle):
            code = code * (len(self.vocab) + 1) + ids[k : k + len(code)]
        return code

    def _passage(self, pairs: list[tuple[int, int]], length: int) -> int:
        """Words of the longest passage over aligned (item place, document place) pairs, 0 if none is long enough."""
        if len(pairs) < 2:
            return 0
        a, b = np.array(pairs).T
        # a passage begins and ends with two words in a row that agree, so that a stray match doesn't lengthen it
        tied = (np.diff(a) == 1) & (np.diff(b) == 1)
        starts = np.append(tied, False)
        ends = np.append(False, tied)
        cost = np.append(0, np.cumsum(np.maximum(np.diff(a), np.diff(b)) - 1))
        span = a[None, :] - a[:, None] + 1
        fits = (span >= length * self.params.share) & (self.params.changed * (cost[None, :] - cost[:, None]) <= span) & starts[:, None] & ends[None, :]
        return int(span[fits].max()) if fits.any() else 0

    def similar(self, k: int, codes: np.ndarray) -> bool:
        """Whether the codes hold enough of item k's shingle weight."""
        own, weights = self.shingles[k], self.weights[k]
        if not len(own):
            return True
        at = np.minimum(np.searchsorted(own, codes), len(own) - 1)
        held = np.zeros(len(own), bool)
        held[at[own[at] == codes]] = True
        return weights[held].sum() >= self.params.similarity * weights.sum()

    def verify(self, k: int, doc: np.ndarray, codes: np.ndarray, shifts: np.ndarray) -> int:
        """Words of item k in the longest passage that the document holds near the shifts (document place minus item place)."""
        item = self.words[k]
        best = 0
        groups = [shifts] if len(shifts) == 1 else np.split(shifts, np.flatnonzero(np.diff(shifts) > 12) + 1)
        for group in groups:
            lo, hi = max(0, int(group[0]) - 8), min(len(doc), int(group[-1]) + len(item) + 8)
            if not self.similar(k, codes[lo : max(lo, hi - self.params.shingle + 1)]):
                continue
            part = doc[lo:hi]
            for shift in group:
                at = np.arange(max(0, -shift), min(len(item), len(doc) - shift))
                same = at[item[at] == doc[at + shift]]
                best = max(best, self._passage([(i, i + shift) for i in same], len(item)))
            if best < len(item):
                blocks = difflib.SequenceMatcher(None, item.tolist(), part.tolist(), autojunk=False).get_matching_blocks()
                best = max(best, self._passage([(m.a + j, m.b + j) for m in blocks for j in range(m.size)], len(item)))
        return best

    def search(self, texts: list[str]) -> list[tuple[int, int, int]]:
        """(text, item, words) of every held item."""
        get = self.vocab.get
        gap = np.zeros(max((x.run for x in self.blocks), default=1), np.int32)
        parts, starts, at = [], [], 0
        for t in texts:
            ids = np.array([get(w, 0) for w in plain_words(t)], np.int32)
            starts.append(at)
            parts += [ids, gap]
            at += len(ids) + len(gap)
        if not parts or not self.blocks:
            return []
        ids = np.concatenate(parts)
        known = np.append(0, np.cumsum(ids > 0))
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        begin = np.array(starts)
        for x in self.blocks:
            windows = np.flatnonzero(known[x.run :] - known[: -x.run] == x.run)
            for c in range(0, len(windows), 100_000):
                w = windows[c : c + 100_000]
                rows, hits = x.near(simhashes(ids, w, x.run, self.planes), self.params.radius)
                doc = np.searchsorted(begin, w[rows], side="right") - 1
                shift = w[rows] - begin[doc] - x.place[hits]
                for key in set(zip(doc.tolist(), x.owner[hits].tolist(), shift.tolist())):
                    found[key[:2]].add(key[2])
        out, last, codes = [], -1, None
        for (d, k), shifts in sorted(found.items()):
            if d != last:
                last, codes = d, self._codes(parts[2 * d])
            n = self.verify(k, parts[2 * d], codes, np.array(sorted(shifts)))
            if n:
                out.append((d, k, n))
        return out


def leaks(docs: DataFrame, items: DataFrame, params: LeakParams = LeakParams(), key: str = "doc_id", text: str = "text", item: str = "item_id", question: str = "question") -> DataFrame:
    """(doc_id, item_id, words, item_words): every document that holds an item, and how many words long the passage is.

    The items are the stated query set; they are searched for in blocks of ``block_items``, each one pass over ``docs``.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item).cast("long").alias("i"), F.col(question).alias("q")).distinct()
    blocks = max(1, -(-asked.count() // params.block_items))
    corpus = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL AND text <> ''")
    schema = "doc_id long, item_id long, words int, item_words int"
    out = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("i", "q"), F.lit(blocks)) == b).orderBy("i", "q").collect()
        index = spark.sparkContext.broadcast(LeakIndex([(r.i, r.q) for r in rows], params))

        def scan(batches: Iterable[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index.value
            for batch in batches:
                ids = batch.column(0)
                for c in range(0, batch.num_rows, 256):
                    part = x.search(batch.column(1).slice(c, 256).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[c + d].as_py() for d, _, _ in part], pa.int64()),
                            pa.array([x.ids[k] for _, k, _ in part], pa.int64()),
                            pa.array([n for _, _, n in part], pa.int32()),
                            pa.array([len(x.words[k]) for _, k, _ in part], pa.int32()),
                        ],
                        ["doc_id", "item_id", "words", "item_words"],
                    )

        found = corpus.mapInArrow(scan, schema)
        out = found if out is None else out.unionByName(found)
    return out
