"""Problem 4: near-duplicate records with small edits.

Method: pigeonhole blocks. A text is the set of its runs of ``width`` consecutive words; its fingerprint is ``blocks`` x
``rows`` MinHash values, of which two texts share each with probability equal to their Jaccard similarity. The
fingerprint is split into blocks; texts that agree on a whole block are candidates; the Hamming distance of the full
fingerprints discards those that are certainly apart, and the exact Jaccard similarity of the shingle sets decides.

Exact copies are one class: pairs are found between classes, and expanded by membership only where a caller wants every
pair. Blocks shared by many classes, and classes of many copies, are cut into parts that are paired part by part, so no task
and no row holds an unbounded group; crowded blocks are salted before their exchange.

Shingles are compared as 40-bit hashes: two sets of a thousand share one by chance with probability 1e-6.

Defined results: null, empty and too short texts have no shingle and take no part; texts are read whole; copies and ties
count as pairs of similarity 1; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuemill.runtime import cut, weighted_lookup

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class NearDupParams:
    width: int = 5
    similarity: float = 0.8
    #: Blocks and values a block: a pair at the threshold t is missed with probability (1 - t ** rows) ** blocks.
    blocks: int = 24
    rows: int = 5
    #: Classes that share a block, and copies of a class, are paired in parts of this many.
    part: int = 200
    #: Blocks are counted in so many cells by hash; those of a cell with four times the mean are spread over ``salts`` tasks.
    cells: int = 65_536
    salts: int = 64
    #: Most candidate texts whose keys are broadcast to the second reading of the texts; beyond, that join is a shuffle.
    broadcast_rows: int = 1_000_000


#: For pairs at similarity 0.5: missed with probability 0.003 there, 0.0002 at 0.55.
HALF = NearDupParams(width=3, similarity=0.5, blocks=90, rows=4)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Stable 63-bit hashes of words, remembered per task."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 2_000_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingle_hashes(text: str, width: int, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words."""
    h = np.array([words[w] for w in WORD.findall(text.lower())], np.uint64)
    if len(h) < width:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k] + np.uint64(k + 1))
    return np.unique(out)


def minhashes(shingles: np.ndarray, count: int, seed: int = 20) -> np.ndarray:
    """``count`` MinHash values (uint32) of a non-empty shingle set: one multiply and add a value, minimum over the set."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 2**32, count, dtype=np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    best = np.full(count, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(low), 2048):
            part = low[k : k + 2048, None] * a[None, :]
            part += b[None, :]
            part ^= part >> np.uint32(15)
            part *= np.uint32(0x2C1B3C6D)
            np.minimum(best, part.min(axis=0), out=best)
    return best


def _buckets(prints: np.ndarray, params: NearDupParams, seed: int) -> np.ndarray:
    """One 64-bit hash per block of a fingerprint; it names the block's place too, and the field through ``seed``."""
    with np.errstate(over="ignore"):
        h = _mix(np.arange(1, params.blocks + 1, dtype=np.uint64)) + np.uint64(seed)
        values = prints.reshape(params.blocks, params.rows).astype(np.uint64)
        for r in range(params.rows):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + values[:, r])
    return h.view(np.int64)


def _marks(prints: np.ndarray) -> bytes:
    """The low four bits of every value (a minimum's high bits are mostly zero): the short fingerprint whose Hamming distance is verified."""
    bits = (prints & np.uint32(15)).astype(np.uint8)
    bits = np.append(bits, np.zeros(len(bits) % 2, np.uint8))
    return (bits[::2] << np.uint8(4) | bits[1::2]).tobytes()


#: Equal half bytes of two bytes, by their exclusive or.
_EQUAL = np.array([(x < 16) + (x % 16 == 0) for x in range(256)], np.uint8)


def _packed(shingles: np.ndarray) -> bytes:
    """The low 40 bits of every hash: two sets of a thousand meet by chance with probability 1e-6."""
    return np.unique(shingles & np.uint64(0xFFFFFFFFFF)).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    body = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, 5)
    out = np.zeros((len(body), 8), np.uint8)
    out[:, :5] = body
    return out.view(np.uint64).ravel()


def _scan(texts: DataFrame, params: NearDupParams, verify: bool) -> DataFrame:
    """One row per text with a shingle. For search: (field, key, id, n, marks, blocks); for verification: (id, shingles).

    ``id`` is a 64-bit hash of field and shingle set: equal sets are one class.
    """
    names = ["id", "shingles"] if verify else ["field", "key", "id", "n", "marks", "blocks"]
    kinds = [pa.int64(), pa.binary()] if verify else [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = _Words()
        for b in batches:
            fields, keys, pieces = b.column(0), b.column(1), b.column(2)
            out: list[list] = [[] for _ in names]
            for i in range(b.num_rows):
                field, key = fields[i].as_py() or "", keys[i].as_py()
                if key is None:
                    continue
                s = shingle_hashes(" ".join(p or "" for p in pieces[i].as_py() or []), params.width, words)
                if len(s):
                    seed = xxhash.xxh3_64_intdigest(field)
                    ident = xxhash.xxh3_64_intdigest(s.tobytes(), seed) - 2**63
                    if verify:
                        row = (ident, _packed(s))
                    else:
                        prints = minhashes(s, params.blocks * params.rows)
                        row = (field, key, ident, len(s), _marks(prints), _buckets(prints, params, seed))
                    for column, value in zip(out, row):
                        column.append(value)
                if len(out[0]) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    schema = "id long, shingles binary" if verify else "field string, key long, id long, n int, marks binary, blocks array<long>"
    return texts.select("field", "key", "pieces").mapInArrow(scan, schema)


def _paired(parted: DataFrame, group: str, item: str) -> DataFrame:
    """(x, y), x < y, of every two different items of a group, from (group, parts, part, item). Each pair of a group's parts is a
    row of work of its own, whatever the group's size."""
    parts = parted.groupBy(group, "parts", "part").agg(F.collect_list(item).alias("own"))
    left = parts.select(group, "own", F.col("part").alias("at"), F.explode(F.sequence(F.col("part"), F.col("parts") - 1)).alias("part"))
    both = left.join(parts.select(group, "part", F.col("own").alias("others")), [group, "part"])
    pairs = both.select(F.explode("own").alias("x"), "others", (F.col("at") == F.col("part")).alias("same")).select("x", F.explode("others").alias("y"), "same")
    # within one part every pair comes both ways, between two parts one way
    kept = pairs.where((F.col("x") < F.col("y")) | (~F.col("same") & (F.col("x") > F.col("y"))))
    return kept.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def _candidates(found: DataFrame, classes: DataFrame, params: NearDupParams) -> DataFrame:
    """Distinct (a, b), a < b, of the classes (id, blocks) that share a block; ``found`` has the blocks of every text.

    Blocks held by two classes, nearly all, give their pair in one aggregation. A block held by more is cut into parts
    of about ``part`` classes by hash. Blocks in crowded cells, at most a quarter of the cells, are exchanged by block and salt.
    """
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(params.cells)).alias("cell")
    counts = found.select(F.explode("blocks").alias("bucket")).groupBy(cell("bucket")).agg(F.count("*").alias("n"))
    counts = cut(counts)  # one row a cell
    least = max(params.part, 4 * (counts.agg(F.sum("n")).first()[0] or 0) / params.cells)
    crowded = F.broadcast(counts.where(F.col("n") > least).select("cell"))
    rows = classes.select(F.explode("blocks").alias("bucket"), "id").withColumn("cell", cell("bucket"))
    summary = (F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    parts = F.ceil(F.col("n") / params.part).cast("int").alias("parts")
    place = F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part")

    plain = rows.join(crowded, "cell", "left_anti").select("bucket", "id").repartition("bucket")  # the one exchange of counts and parts
    of_plain = plain.groupBy("bucket").agg(*summary)
    parted = plain.join(of_plain.where("n > 2").select("bucket", parts), "bucket").select("bucket", "parts", place, "id")

    salted = rows.join(crowded, "cell", "left_semi").select("bucket", F.pmod(F.xxhash64("id"), F.lit(params.salts)).cast("int").alias("salt"), "id").repartition("bucket", "salt")
    of_salted = salted.groupBy("bucket", "salt").agg(*summary).groupBy("bucket").agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"))
    more = of_salted.where("n > 2").select("bucket", parts, F.explode(F.sequence(F.lit(0), F.lit(params.salts - 1))).alias("salt"))
    spread = salted.join(more, ["bucket", "salt"]).select("bucket", "parts", place, "id")

    two = of_plain.unionByName(of_salted).where("n = 2 AND a < b").select("a", "b")
    many = _paired(parted.unionByName(spread), "bucket", "id")
    return two.unionByName(many.select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()


def _near(params: NearDupParams):
    """Discards pairs whose sizes or fingerprints are too far apart, with five standard deviations of slack."""
    count = params.blocks * params.rows
    equal = params.similarity + (1 - params.similarity) / 16  # half bytes also agree by chance
    least = equal - 5 * (equal * (1 - equal) / count) ** 0.5

    def hamming(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [np.asarray(b.column(i), np.int64) for i in (2, 3)]
            keep = np.minimum(*sizes) >= params.similarity * np.maximum(*sizes)
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, (count + 1) // 2) for c in (4, 5))
            agree = _EQUAL[x ^ y].sum(axis=1, dtype=np.int64) - count % 2
            keep &= agree >= least * count
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))], ["a", "b"])

    return hamming


def _exact(params: NearDupParams):
    def jaccard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, score = [], []
            for i in range(b.num_rows):
                x, y = (_unpacked(b.column(c)[i]) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                j = common / (len(x) + len(y) - common)
                if j >= params.similarity:
                    keep.append(i)
                    score.append(j)
            taken = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(taken), b.column(1).take(taken), pa.array(score, pa.float64())], ["a", "b", "similarity"])

    return jaccard


def near_duplicates(texts: DataFrame, params: NearDupParams = NearDupParams()) -> tuple[DataFrame, DataFrame]:
    """Classes and links of (field, key, pieces), a text being its pieces joined by spaces; keys are unique in a field.

    Returns ``members`` (field, key, id), one row per text with a shingle, ``id`` naming its class of equal shingle sets,
    and ``links`` (a, b, similarity), a < b, every pair of classes of one field at or above the threshold.
    """
    found = cut(_scan(texts, params, verify=False))
    members = found.select("field", "key", "id")
    classes = found.groupBy("id").agg(F.first(F.struct("n", "marks", "blocks")).alias("c"))
    pairs = _candidates(found, classes.select("id", "c.blocks"), params)
    short = found.select("id", "n", "marks").dropDuplicates(["id"])
    side = lambda x: short.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("marks").alias(f"m_{x}"))
    close = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "m_a", "m_b")
    close = cut(close.mapInArrow(_near(params), "a long, b long"))
    # only the texts of close pairs are read again, one for each class
    wanted = close.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    first = members.groupBy("id").agg(F.min(F.struct("field", "key")).alias("at")).join(wanted, "id", "left_semi").select("at.field", "at.key")
    first = cut(first)
    if first.count() <= params.broadcast_rows:
        first = F.broadcast(first)
    sets = cut(_scan(texts.join(first, ["field", "key"], "left_semi"), params, verify=True))
    part = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s_{x}"))
    full = close.join(part("a"), "a").join(part("b"), "b").select("a", "b", "s_a", "s_b")
    return members, full.mapInArrow(_exact(params), "a long, b long, similarity double")


def every_pair(members: DataFrame, links: DataFrame, part: int = NearDupParams.part) -> DataFrame:
    """(field, key_a, key_b), key_a < key_b: the links expanded by membership, and all pairs within classes of copies.

    Classes are cut into parts of about ``part`` keys, and both steps work on pairs of parts.
    """
    sizes = members.groupBy("id").agg(F.count("*").alias("n"), F.first("field").alias("field"), F.min("key").alias("x"), F.max("key").alias("y"))
    sizes = cut(sizes.withColumn("parts", F.ceil(F.col("n") / part).cast("int")))
    place = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part")
    keys = cut(weighted_lookup(members, sizes.select("id", "parts", "n", F.col("n").alias("uses")), ["id"], "uses").select("field", "id", "n", "parts", place, "key"))
    named = keys.where("n > 2").select("id", "parts", "part", F.struct("field", "key").alias("item"))
    within = _paired(named, "id", "item").select("x.field", F.col("x.key").alias("x"), F.col("y.key").alias("y"))
    two = sizes.where("n = 2 AND x < y").select("field", "x", "y")
    keys = keys.select("id", "part", "field", "key")
    parted = lambda rows, c: rows.join(sizes.select(F.col("id").alias(c), "parts"), c).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    across = parted(links.select("a", "b"), "a").join(keys.withColumnRenamed("id", "a"), ["a", "part"]).select("field", F.col("key").alias("x"), "b")
    across = parted(across, "b").join(keys.select(F.col("id").alias("b"), "part", F.col("key").alias("y")), ["b", "part"]).select("field", "x", "y")
    out = across.unionByName(within).unionByName(two)
    return out.select("field", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))


def _of_classes(members: DataFrame, lookup: DataFrame, how: str = "inner") -> DataFrame:
    """Members with the columns of their class in ``lookup`` (unique by id) and its number of copies; a class of any size is no hot key."""
    sizes = members.groupBy("id").agg(F.count("*").alias("copies"))
    return weighted_lookup(members, cut(sizes.join(lookup, "id", how).withColumn("uses", F.col("copies"))), ["id"], "uses")


def class_summary(members: DataFrame, links: DataFrame) -> DataFrame:
    """(field, key, class_id, copies, links): one row per text, its class and the number of classes linked to it."""
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    out = _of_classes(members, degree, "left")
    return out.select("field", "key", F.col("id").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))


def _afresh(df: DataFrame) -> DataFrame:
    """Checkpointed, without the size estimate that a checkpoint keeps: a self-join squares it, so its digits would double every time."""
    kept = cut(df)
    session = kept.sparkSession
    return DataFrame(session._jsparkSession.createDataFrame(kept._jdf.toJavaRDD(), kept._jdf.schema()), session)


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(field, key, group_id): connected groups of linked classes, named by their least class.

    Every round hooks each current group to its least neighbour, points all of them to the root of their tree, and keeps only
    the links that still join different groups, one of each. Two groups that choose each other are the only cycle, whose
    smaller one is the root and the least of its tree. A group with a neighbour never stays alone, so a round at least halves
    the groups that have one: rounds are logarithmic, and none is left out. Every round's tables are checkpointed.
    """
    labels = _afresh(members.select("id").distinct().withColumn("label", F.col("id")))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = _afresh(both.where("a <> b").distinct())
    while not edges.isEmpty():
        least = _afresh(edges.groupBy("a").agg(F.min("b").alias("up")))
        over = least.select(F.col("a").alias("up"), F.col("up").alias("top"))
        root = (F.col("top") == F.col("a")) & (F.col("a") < F.col("up"))
        hooks = _afresh(least.join(over, "up").select("a", F.when(root, F.col("a")).otherwise(F.col("up")).alias("up")))
        while True:
            over = hooks.select(F.col("a").alias("up"), F.col("up").alias("top"))
            moved = _afresh(hooks.join(over, "up").select("a", F.col("up").alias("old"), F.col("top").alias("up")))
            hooks = moved.select("a", "up")
            if moved.where("old <> up").isEmpty():
                break
        labels = _afresh(labels.join(hooks.withColumnRenamed("a", "label"), "label", "left").select("id", F.coalesce("up", "label").alias("label")))
        ends = edges.join(hooks, "a").select("b", F.col("up").alias("x")).join(hooks.withColumnRenamed("a", "b"), "b")
        edges = _afresh(ends.select(F.col("x").alias("a"), F.col("up").alias("b")).where("a <> b").distinct())
    return _of_classes(members, labels).select("field", "key", F.col("label").alias("group_id"))
