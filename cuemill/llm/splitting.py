"""Problem 5: split oversized transcripts at natural boundaries.

Method: lexical-cohesion segmentation. At every place where a piece may end, the words of the block before and of the
block after are compared as weighted bags; the valleys of that similarity are topic boundaries. Within each size window
the deepest valley is cut, where a section start, a pause or a sentence end deepens a valley; every following piece
repeats the stated number of words of the one before.

Words are maximal runs free of Unicode white space. Segments are read as one text joined by single spaces.

Defined results: lines at or under the limit, with null, empty or blank segments have no pieces; null starts and
durations have no pause; section times are optional; a line without any boundary in a window is cut between two words; repeated
rows give repeated pieces; texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuemill.runtime import WHITE, cut, weighted_lookup

WORD = re.compile(f"[^{WHITE}]+")
SEGMENTS = "array<struct<text:string,start:double,duration:double>>"


@dataclass(frozen=True)
class SplitParams:
    max_size: int = 900
    overlap: int = 40
    #: A piece is cut no earlier than at this share of the limit.
    least_fill: float = 0.5
    #: Words of a block on either side of a boundary.
    block: int = 70
    section_bonus: float = 0.6
    pause_bonus: float = 0.3
    sentence_bonus: float = 0.2
    #: Seconds of silence that count as a full pause.
    pause: float = 3.0


def count_words(text: str) -> int:
    """Runs free of white space. str.split agrees with the Unicode property but for four separators."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return len(WORD.findall(text))
    return len(text.split())


def oversized(lines: DataFrame, max_size: int) -> DataFrame:
    """(line_no, video_id, texts, starts, durations) of the lines with more words than the limit."""
    names = ["line_no", "video_id", "texts", "starts", "durations"]
    kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.list_(pa.float64())]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            segments = b.column(2)
            inside, at = segments.values, segments.offsets.to_pylist()
            gone = inside.is_null().to_pylist()
            texts = ["" if t is None or n else t for t, n in zip(inside.field("text").to_pylist(), gone)]
            long_ones = [i for i in range(b.num_rows) if sum(map(count_words, texts[at[i] : at[i + 1]])) > max_size]
            starts, durations = (inside.field(f).to_pylist() if long_ones else [] for f in ("start", "duration"))
            spans = [slice(at[i], at[i + 1]) for i in long_ones]
            chosen = pa.array(long_ones, pa.int64())
            columns = [b.column(0).take(chosen), b.column(1).take(chosen), *(pa.array([x[s] for s in spans], t) for x, t in zip((texts, starts, durations), kinds[2:]))]
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = lines.select(F.col("line_no").cast("long"), F.coalesce("video_id", F.lit("")).alias("video_id"), F.coalesce("transcript_segments", F.array().cast(SEGMENTS)).alias("transcript_segments"))
    return kept.mapInArrow(scan, "line_no long, video_id string, texts array<string>, starts array<double>, durations array<double>")


def _similarity(a: Counter, b: Counter) -> float:
    if not a or not b:
        return 0.0
    small, large = (a, b) if len(a) < len(b) else (b, a)
    dot = sum(n * large[w] for w, n in small.items() if w in large)
    return dot / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))


def choose_cuts(words: list[str], marks: dict[int, tuple[float, str]], params: SplitParams) -> list[tuple[int, str]]:
    """(word, kind) of every cut, a piece ending before ``word``. ``marks`` maps boundary words to (bonus, kind)."""
    bags = [w.lower().strip(".,;:!?\"'()[]¡¿…") for w in words]
    heavy = [w if len(w) > 3 else "" for w in bags]
    places = sorted(marks)
    cuts: list[tuple[int, str]] = []
    start, at = 0, 0
    while True:
        room = params.max_size - (params.overlap if cuts else 0)
        if len(words) - start <= room:
            return cuts
        low = start + max(1, int(room * params.least_fill))
        while at < len(places) and places[at] < low:
            at += 1
        window, k = [], at
        while k < len(places) and places[k] <= start + room:
            window.append(places[k])
            k += 1
        if not window:
            window = list(range(low, start + room + 1, max(1, params.block // 4)))
        sims = []
        for p in window:
            left = Counter(w for w in heavy[max(0, p - params.block) : p] if w)
            right = Counter(w for w in heavy[p : p + params.block] if w)
            sims.append(_similarity(left, right))
        rising, best = [0.0] * len(window), (-1.0, 0, "word")
        peak = 0.0
        for i in range(len(window) - 1, -1, -1):
            peak = max(peak, sims[i])
            rising[i] = peak
        peak = 0.0
        for i, p in enumerate(window):
            peak = max(peak, sims[i])
            bonus, kind = marks.get(p, (0.0, "word"))
            depth = (peak - sims[i]) + (rising[i] - sims[i]) + bonus
            best = max(best, (depth, p, kind))
        cuts.append((best[1], best[2]))
        start = best[1]


def _marks(starts: list[int], words: list[str], times: list[tuple[float | None, float | None]], sections: list[float], params: SplitParams) -> dict[int, tuple[float, str]]:
    """Boundaries: segment starts, with bonuses for sections, pauses and sentence ends; sentence ends inside segments."""
    marks: dict[int, tuple[float, str]] = {}
    pending = sorted(sections)
    end: float | None = None
    for k, first in enumerate(starts):
        begin, length = times[k]
        bonus, kind = 0.0, "segment"
        if 0 < first < len(words):
            if words[first - 1].rstrip("\"'”’)»")[-1:] in (".", "!", "?", "…", "。"):
                bonus, kind = bonus + params.sentence_bonus, "sentence"
            if begin is not None and end is not None and begin - end > 0.5:
                bonus += params.pause_bonus * min(1.0, (begin - end) / params.pause)
                kind = "pause" if begin - end >= params.pause / 2 else kind
        opens = False
        while pending and begin is not None and pending[0] <= begin + 0.05:
            pending.pop(0)
            opens = True
        if opens:
            bonus, kind = bonus + params.section_bonus, "section"
        if 0 < first < len(words) and (first not in marks or bonus > marks[first][0]):
            marks[first] = (bonus, kind)
        if begin is not None:
            end = begin + (length or 0.0)
    for i in range(1, len(words)):
        if words[i - 1][-1] in ".!?…" and i not in marks:
            marks[i] = (params.sentence_bonus / 2, "sentence")
    return marks


def split_lines(lines: DataFrame, sections: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """Pieces of every line above the limit.

    ``lines`` has (line_no, video_id, transcript_segments), ``sections`` (video_id, start_ts); others are ignored. Returns
    (line_no, piece_no, first_word, n_words, overlap_words, cut, text); ``cut`` tells what the piece ends with.
    """
    if not 0 <= params.overlap < params.max_size:
        raise ValueError("the overlap must be smaller than the limit")
    texts = cut(oversized(lines, params.max_size))
    # one row per video; the times stay exact, as a section rounded up would miss the segment it begins with
    times = sections.where("video_id IS NOT NULL AND start_ts IS NOT NULL").select("video_id", F.col("start_ts").cast("double").alias("at")).distinct()
    times = times.groupBy("video_id").agg(F.sort_array(F.collect_list("at")).alias("sections"))
    uses = texts.groupBy("video_id").agg(F.count("*").alias("uses"))
    times = cut(times.join(uses, "video_id"))
    joined = weighted_lookup(texts, times, ["video_id"], "uses", "left") if times.count() else texts.withColumn("sections", F.array().cast("array<double>"))
    names = ["line_no", "piece_no", "first_word", "n_words", "overlap_words", "cut", "text"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                line, pieces, begins, lengths, marks_at = (b.column(c)[i].as_py() for c in range(5))
                words, spans, starts, at = [], [], [], 0
                for t in pieces:
                    starts.append(len(words))
                    for m in WORD.finditer(t):
                        words.append(m[0])
                        spans.append((at + m.start(), at + m.end()))
                    at += len(t) + 1
                text = " ".join(pieces)
                begins, lengths = begins or [None] * len(pieces), lengths or [None] * len(pieces)
                cuts = choose_cuts(words, _marks(starts, words, list(zip(begins, lengths)), marks_at or [], params), params)
                out: list[list] = [[] for _ in names]
                for k, (first, (last, kind)) in enumerate(zip([0, *(c for c, _ in cuts)], [*cuts, (len(words), "end")])):
                    over = min(params.overlap, first)
                    row = (line, k, first - over, last - first + over, over, kind, text[spans[first - over][0] : spans[last - 1][1]])
                    for column, value in zip(out, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    schema = "line_no long, piece_no int, first_word int, n_words int, overlap_words int, cut string, text string"
    return joined.select("line_no", "texts", "starts", "durations", "sections").mapInArrow(split, schema)
