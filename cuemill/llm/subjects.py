"""Problem 3: subject areas of documents.

Method: passages (summary sentences and domain entries) are normalised vectors, clustered by bisecting k-means; the
leaves are labelled by their discriminative terms and by a sample of hand labels; a document gets the subjects of
its mixture of leaves. Freely spelled domain entries are first mapped to the canonical list.

A word's vector is its profile over the canonical domain terms of the documents it stands in (positive pointwise mutual
information, weighted by how far that profile is from the corpus's beyond chance), so words of all languages share one
space and words without a subject weigh nothing. Sentences that recur word for word over documents of all domains are
stock phrases ("a marathon and not a sprint") and have no vector.

Defined results: documents without summary and without a non-blank domain have no row; null entries are skipped; a document
whose passages have no vector gets no subject; repeated rows count as one; ties in clustering follow the seed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuemill.llm.terms import TermParams, entries, map_terms
from cuemill.runtime import WHITE, cut, once, weighted_lookup

@dataclass(frozen=True)
class SubjectParams:
    leaves: int = 40
    #: Rounds of k-means a split, and its seed.
    rounds: int = 12
    seed: int = 11
    #: Documents a word must stand in, and occurrences from which a sentence may be a stock phrase.
    least_df: int = 4
    stock: int = 8
    #: Share of the greatest possible gain below which such a sentence is one.
    stock_gain: float = 0.13
    #: Hand labels used at most (documents, in order of a hash of their key); the only bounded sample.
    label_sample: int = 20_000
    #: Weight of seed words against hand labels, passages' worth of support that a subject needs, and its least share.
    seed_weight: float = 3.0
    support: float = 0.6
    share: float = 0.12
    #: Subject name to words of canonical terms that speak for it, where hand labels are few; none by default.
    seeds: Mapping[str, Sequence[str]] = field(default_factory=dict)
    terms: TermParams = field(default_factory=TermParams)


def _passages(videos: DataFrame) -> DataFrame:
    """(id, passage, words): summary sentences as sets of lower-case words."""
    sentences = videos.where("summary IS NOT NULL").select("id", F.posexplode(F.split("summary", rf"(?<=[.!?])[{WHITE}]+|\n+")).alias("passage", "sentence"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("sentence"), F.lit(r"(\p{L}[\p{L}\p{M}]+)"), 1))
    return sentences.select("id", "passage", words.alias("words"), F.xxhash64(F.lower("sentence")).alias("sentence")).where(F.size("words") > 0)


def _information(counts: DataFrame, key: str, totals: DataFrame, everything: float, terms: int) -> DataFrame:
    """(key, n, gain): how far the domains seen with ``key`` are from the corpus's, in nats beyond what chance gives."""
    parts = F.col("c") * F.log(F.col("c") * everything / F.col("t"))  # of n times the divergence plus log n
    gains = counts.join(F.broadcast(totals), "term").groupBy(key).agg(F.sum("c").alias("n"), F.sum(parts).alias("parts"))
    kl = F.col("parts") / F.col("n") - F.log(F.col("n"))
    return gains.select(key, "n", F.greatest(F.lit(0.0), kl - (terms - 1) / (2 * F.col("n"))).alias("gain"))


def subject_mixtures(videos: DataFrame, terms: DataFrame, areas: DataFrame, labels: DataFrame, params: SubjectParams = SubjectParams(), aliases: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Leaf mixtures and leaf labels.

    ``videos`` has (id, video_id, summary, domains); ``terms`` (term_id, field, name); ``areas`` (subject_id, name);
    ``labels`` (video_id, subject_id). Returns (id, subject_id, support, share) for every subject with any support, and
    (leaf, subject_id, weight, terms): the leaves with their likeliest subject and discriminative terms.
    """
    spark = videos.sparkSession
    # cut at each of these places: the driver plans every exchange again after each stage, so its memory follows the largest plan
    videos = cut(videos.select(F.col("id").cast("long"), "video_id", "summary", "domains").dropDuplicates(["id"]))
    names = terms.where("field = 'domains' AND name IS NOT NULL").select("term_id", "name").distinct().orderBy("term_id").collect()  # the fixed canonical list
    index = {r.term_id: i for i, r in enumerate(names)}
    size = max(1, len(index))
    found = entries(videos, "id", ["domains"]).select("key", "field", "value")
    answers = cut(map_terms(found.select("field", "value"), terms.where("field = 'domains'"), params.terms, aliases).where("term_id <> 0").select("field", "value", "n", "term_id"))
    place = F.create_map(*[F.lit(x) for pair in (index or {-1: 0}).items() for x in pair])
    domains = cut(weighted_lookup(found, answers, ["field", "value"], "n").select(F.col("key").alias("id"), place[F.col("term_id")].alias("term")).distinct())

    passages = cut(_passages(videos))
    totals = cut(domains.groupBy("term").agg(F.count("*").alias("t")))
    everything = float(totals.agg(F.sum("t")).first()[0] or 1)
    seen = passages.select("id", F.explode("words").alias("word")).distinct().join(domains, "id").groupBy("word", "term").agg(F.count("*").alias("c"))
    seen = cut(seen)
    gains = _information(seen, "word", totals, everything, size).where(f"n >= {params.least_df} AND gain > 0")
    pmi = F.greatest(F.lit(0.0), F.log(F.col("c") * everything / (F.col("n") * F.col("t")))) * F.col("c") / (F.col("c") + 1)
    cells = seen.join(gains, "word").join(F.broadcast(totals), "term").withColumn("x", pmi * F.col("gain")).where("x > 0")
    dense = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0)))
    profiles = cut(cells.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("term", "x"))).alias("m"), F.sum("c").alias("uses")).select("word", "uses", dense.alias("v")))

    by_sentence = passages.select("id", "sentence").distinct().join(domains, "id").groupBy("sentence", "term").agg(F.count("*").alias("c"))
    stock = _information(by_sentence, "sentence", totals, everything, size).where((F.col("n") >= params.stock) & (F.col("gain") < params.stock_gain * math.log(max(size, 2)))).select("sentence")
    stock = cut(stock)
    live = passages.join(stock, "sentence", "left_anti").select("id", "passage", F.explode("words").alias("word"))
    summed = weighted_lookup(live, profiles, ["word"], "uses").groupBy("id", "passage").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    one_hot = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == F.col("term"), 1.0).otherwise(0.0))
    points = summed.select("id", "passage", vector_to_array("v").alias("v")).unionByName(domains.select("id", (-1 - F.col("term")).alias("passage"), one_hot.alias("v")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    points = once(points, norm=norm).where("norm > 0").select("id", "passage", array_to_vector(F.transform("v", lambda x: x / F.col("norm"))).alias("features"))
    points = cut(points)

    empty = spark.createDataFrame([], "id long, subject_id int, support double, share double"), spark.createDataFrame([], "leaf int, subject_id int, weight double, terms array<string>")
    subjects = {r.subject_id: r.name for r in areas.where("subject_id IS NOT NULL").select("subject_id", "name").distinct().collect()}  # fixed list
    if points.isEmpty() or not subjects:
        return empty
    # equal vectors, as of all entries of one domain, are one point with a weight; fit keeps its points in memory and on disk by itself
    weighted = points.groupBy("features").agg(F.count("*").cast("double").alias("weight"))
    model = BisectingKMeans(k=params.leaves, seed=params.seed, maxIter=params.rounds, distanceMeasure="cosine", minDivisibleClusterSize=4.0, weightCol="weight", predictionCol="leaf").fit(weighted)
    leaves = cut(model.transform(points).select("id", "passage", "leaf"))
    centers = [np.asarray(c) for c in model.clusterCenters()]

    # leaves to subjects: expectation-maximisation over the labelled sample, from seed words of the discriminative terms where any are given
    ids = sorted(subjects)
    prior = np.full((len(centers), len(ids)), 0.02)
    top: list[list[str]] = []
    for k, c in enumerate(centers):
        order = np.argsort(-c)[:4]
        top.append([names[i].name for i in order if c[i] > 0.05])
        for i in np.flatnonzero(c > 0.02):
            for j, s in enumerate(ids):
                if any(w in names[i].name.lower().split() for w in params.seeds.get((subjects[s] or "").lower(), ())):
                    prior[k, j] += params.seed_weight * c[i] ** 2
    sample = labels.where("video_id IS NOT NULL AND subject_id IS NOT NULL").select("video_id", "subject_id").distinct().join(videos.select("id", "video_id"), "video_id")
    chosen = sample.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(params.label_sample)
    rows = sample.join(chosen, "id").groupBy("id").agg(F.collect_set("subject_id").alias("s")).join(leaves.groupBy("id").agg(F.collect_list("leaf").alias("l")), "id").select("s", "l").collect()
    weights = prior / prior.sum(1, keepdims=True)
    at = {s: j for j, s in enumerate(ids)}
    for _ in range(8):
        counts = prior.copy()
        for r in rows:
            own = [at[s] for s in r.s if s in at]
            for leaf in r.l:
                w = weights[leaf, own]
                counts[leaf, own] += w / w.sum() if w.sum() else 0
        weights = counts / counts.sum(1, keepdims=True)

    flat = [(k, ids[j], float(weights[k, j])) for k in range(len(centers)) for j in range(len(ids))]
    table = spark.createDataFrame(flat, "leaf int, subject_id int, weight double")
    # a leaf has a weight for every subject, so a subject's rows are as many as the document's passages
    mixtures = leaves.join(F.broadcast(table), "leaf").groupBy("id", "subject_id").agg(F.sum("weight").alias("support"), F.avg("weight").alias("share"))
    best = [(k, ids[int(np.argmax(weights[k]))], float(weights[k].max()), top[k]) for k in range(len(centers))]
    return mixtures, spark.createDataFrame(best, "leaf int, subject_id int, weight double, terms array<string>")


def assign_subjects(mixtures: DataFrame, params: SubjectParams = SubjectParams()) -> DataFrame:
    """(id, subject_id) of every subject with enough support, and of the best one where none has."""
    lead = F.max(F.struct("support", -F.col("subject_id"))).alias("top")
    marked = mixtures.groupBy("id").agg(lead, F.collect_list(F.struct("subject_id", "support", "share")).alias("all")).select("id", "top", F.inline("all"))
    enough = (F.col("support") >= params.support) & (F.col("share") >= params.share)
    return marked.where(enough | ((F.col("subject_id") == -F.col("top")["col2"]) & (F.col("support") >= 0.3))).select("id", "subject_id").distinct()


def composition(assigned: DataFrame, areas: DataFrame) -> DataFrame:
    """(subject_id, name, documents): make-up of the corpus by subject; subjects without a document count 0."""
    n = assigned.groupBy("subject_id").agg(F.count("*").alias("documents"))
    return areas.select("subject_id", "name").distinct().join(n, "subject_id", "left").select("subject_id", "name", F.coalesce("documents", F.lit(0)).alias("documents"))
