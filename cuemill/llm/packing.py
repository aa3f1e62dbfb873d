"""Problem 7: fill fixed-capacity containers with items.

Method: mixture-controlled packing. Items wait in one queue per source. Deficit round-robin fills each window of
containers: every source earns its share of the window's tokens and pays for the items it sends; what it can't spend is
carried to the next window, and from one packing partition to the next by a running sum of targets and actual tokens. A
carried amount is never cut: it is paid back in equal parts over the windows of the partition. The items of a window are
placed by best fit, the largest first, into the containers still open and new ones.

Packing partitions are slices of the time at which a source that sends at its target share would send an item, so each of
them holds the target mixture for as long as the sources last; a source whose target is above its share of all tokens ends
earlier, and the others share what it leaves.

An item is split only if it alone exceeds the capacity: into full containers and a remainder that is packed like an item.

Defined results: null and empty texts have 0 tokens and still get a container; null sources are the source ""; equal sizes
are placed by key; repeated keys are repeated items; an empty table gives no containers.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuemill.runtime import cut, weighted_lookup

#: Pre-tokenising pattern that belongs to the byte-level BPE vocabulary (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048
    #: Containers of one window, tokens of one packing partition, containers that stay open from window to window.
    window: int = 32
    shard_tokens: int = 3_000_000
    open_containers: int = 24
    #: Target share below which sources count as one in the report of a window's mixture.
    small: float = 0.01
    #: Vocabulary file of byte-level BPE ranks, read by the driver and sent to the executors.
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def count_tokens(docs: DataFrame, key: str, source: str, text: str, vocabulary: str = PackParams.vocabulary) -> DataFrame:
    """(key, source, n_tokens) of every document's whole text."""
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoder = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(encoder.encode_ordinary(t)) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["key", "source", "n_tokens"])

    columns = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text"))
    return columns.mapInArrow(scan, "key long, source string, n_tokens long")


def _fill(sizes: list[int], open_room: list[tuple[int, int]], capacity: int, fresh: int) -> tuple[list[int], int]:
    """Best fit, the sizes given largest first. ``open_room`` holds (room, container), sorted, and is updated."""
    places = []
    for size in sizes:
        i = bisect_left(open_room, (size, -1))
        if i < len(open_room):
            room, box = open_room.pop(i)
        else:
            room, box, fresh = capacity, fresh, fresh + 1
        insort(open_room, (room - size, box))
        places.append(box)
    return places, fresh


def pack_shard(
    keys: list, parts: list[int], sources: list[str], sizes: list[int], shares: dict[str, float], deficits: dict[str, float], params: PackParams
) -> tuple[list[int], list[tuple[int, float]]]:
    """A container number for each item of one packing partition, and (tokens, deviation) of each window.

    The deviation is half the summed difference between the window's shares and the targets of the sources that had items
    waiting, those below ``small`` counted as one.
    """
    queues: dict[str, deque[int]] = defaultdict(deque)
    for i in sorted(range(len(keys)), key=lambda i: (keys[i], parts[i])):
        queues[sources[i]].append(i)
    budget = params.window * params.capacity
    back = {s: deficits.get(s, 0.0) / max(1, -(-sum(sizes) // budget)) for s in queues}
    own: dict[str, float] = defaultdict(float)
    placed, open_room, fresh, windows = [0] * len(keys), [], 0, []
    live = sorted(queues)
    while live:
        waiting, taken, used, spent = live, [], 0, defaultdict(int)
        for s in live:
            own[s] += back[s]
        while live and used < budget:
            whole = sum(shares.get(s, 0.0) for s in live)
            grant = budget - used
            sent = 0
            for s in live:
                own[s] += grant * (shares.get(s, 0.0) / whole if whole else 1 / len(live))
                q = queues[s]
                while q and used < budget and sizes[q[0]] <= own[s]:
                    i = q.popleft()
                    own[s] -= sizes[i]
                    used += sizes[i]
                    spent[s] += sizes[i]
                    sent += 1
                    taken.append(i)
            live = [s for s in live if queues[s]]
            if not sent and used >= budget * 0.9:
                break
        windows.append((used, _deviation(spent, {s: shares.get(s, 0.0) for s in waiting}, params.small)))
        taken.sort(key=lambda i: (-sizes[i], keys[i], parts[i]))
        boxes, fresh = _fill([sizes[i] for i in taken], open_room, params.capacity, fresh)
        for i, box in zip(taken, boxes):
            placed[i] = box
        open_room = sorted(open_room[-params.open_containers :])
    return placed, windows


def _deviation(spent: dict[str, int], target: dict[str, float], small: float) -> float:
    used, whole = sum(spent.values()), sum(target.values())
    if not used or not whole:
        return 0.0
    off, rest = 0.0, 0.0
    for s, share in target.items():
        x = spent.get(s, 0) / used - share / whole
        if share / whole >= small:
            off += abs(x)
        else:
            rest += x
    return (off + abs(rest)) / 2


@dataclass(frozen=True)
class _Plan:
    """Items cut to the capacity and spread over packing partitions, with each source's share and carried deficit there."""

    loose: DataFrame
    alone: DataFrame
    carry: DataFrame


def _plan(items: DataFrame, params: PackParams, shares: DataFrame | None) -> _Plan:
    cap = params.capacity
    parts = items.select("key", "source", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / cap).cast("int") - 1))).alias("part"), "n_tokens")
    parts = parts.select("key", "source", "part", (F.col("part").cast("long") * cap).alias("first_token"), F.least(F.lit(cap).cast("long"), F.col("n_tokens") - F.col("part").cast("long") * cap).alias("size"))
    alone = parts.where(F.col("size") == cap)
    loose = parts.where(F.col("size") < cap)
    sizes = cut(loose.groupBy("source").agg(F.sum("size").alias("tokens"), F.count("*").alias("uses")))
    total = float(sizes.agg(F.sum("tokens")).first()[0] or 0)
    if shares is None:
        shares = sizes.select("source", F.col("tokens").alias("share"))
    shares = sizes.join(shares.groupBy("source").agg(F.max("share").alias("share")), "source", "left").select("source", "tokens", "uses", F.greatest(F.coalesce(F.col("share").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("share"))
    whole = float(shares.agg(F.sum("share")).first()[0] or 0)
    # a source without a share sends over all the time that its tokens would take at their natural one
    natural = F.col("tokens") / F.lit(max(total, 1.0))
    share = F.col("share") / F.lit(whole) if whole else natural
    shares = cut(shares.select("source", "uses", share.alias("share"), F.greatest(F.lit(1.0), F.col("tokens") / F.when(share > 0, share).when(natural > 0, natural)).alias("lasts")))
    # an item's place in its source's time, by hash: from 0 to the time the source lasts
    place = (F.shiftrightunsigned(F.xxhash64("key", "part"), 11) / F.lit(float(1 << 53))).cast("double")
    loose = weighted_lookup(loose, shares, ["source"], "uses")
    loose = loose.withColumn("shard", F.floor(place * F.coalesce("lasts", F.lit(1.0)) / params.shard_tokens).cast("int"))
    loose = cut(loose.select("shard", "key", "source", "part", "first_token", "size", "share", "lasts"))
    sums = loose.groupBy("shard", "source").agg(F.sum("size").alias("tokens"), F.first("share").alias("share"), F.first("lasts").alias("lasts"))
    own = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    due = F.col("share") * F.least(F.col("shard").cast("double") * params.shard_tokens, F.col("lasts"))
    carry = sums.select("shard", "source", (due - F.coalesce(F.sum("tokens").over(own), F.lit(0))).alias("deficit"))
    return _Plan(loose, alone, cut(carry))


def _run(plan: _Plan, params: PackParams, schema: str, rows) -> DataFrame:
    """Pack every partition; ``rows`` makes the output of (shard, items, containers, windows)."""

    def run(key, left: pd.DataFrame) -> pd.DataFrame:
        own = left.drop_duplicates("source")
        shares = dict(zip(own["source"], own["share"].astype(float)))
        deficits = dict(zip(own["source"], own["deficit"].astype(float)))
        boxes, windows = pack_shard(left["key"].tolist(), left["part"].tolist(), left["source"].tolist(), left["size"].tolist(), shares, deficits, params)
        return rows(key[0], left, boxes, windows)

    # a pair of shard and source has at most a shard's rows, so this join has no hot key
    return plan.loose.join(plan.carry, ["shard", "source"]).groupBy("shard").applyInPandas(run, schema)


def pack(items: DataFrame, params: PackParams, shares: DataFrame | None = None) -> DataFrame:
    """Containers of (key, source, n_tokens): (container, key, part, first_token, n_tokens, source).

    ``shares`` (source, share) sets the target proportions of the windows; by default each source gets its share of all
    tokens. Memory: a packing partition holds ``shard_tokens`` tokens of items on average, split by a hash of the item,
    so a source with a third of all rows is spread over all of them.
    """
    plan = _plan(items, params, shares)

    def rows(shard: int, left: pd.DataFrame, boxes: list[int], windows: list) -> pd.DataFrame:
        return pd.DataFrame({"container": [f"s{shard}-{b}" for b in boxes], "key": left["key"], "part": left["part"], "first_token": left["first_token"], "n_tokens": left["size"], "source": left["source"]})

    packed = _run(plan, params, "container string, key long, part int, first_token long, n_tokens long, source string", rows)
    single = plan.alone.select(F.concat(F.lit("d"), F.col("key"), F.lit("-"), F.col("part")).alias("container"), "key", "part", "first_token", F.col("size").alias("n_tokens"), "source")
    return packed.unionByName(single)


def mixture_report(items: DataFrame, params: PackParams, shares: DataFrame | None = None) -> DataFrame:
    """(shard, window, tokens, deviation) of every window of the same packing: how far its mixture is from the target."""

    def rows(shard: int, left: pd.DataFrame, boxes: list[int], windows: list) -> pd.DataFrame:
        return pd.DataFrame({"shard": shard, "window": range(len(windows)), "tokens": [n for n, _ in windows], "deviation": [d for _, d in windows]})

    return _run(_plan(items, params, shares), params, "shard int, window int, tokens long, deviation double", rows)


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """(containers, tokens, fill, items, fewest): how full the containers are."""
    boxes = packed.groupBy("container").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("items"))
    return boxes.agg(
        F.count("*").alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        (F.sum("tokens") / (F.count("*") * capacity)).alias("fill"), F.sum("items").alias("items"), F.max("tokens").alias("fullest"),
    )
