"""Problem 6: lines repeated across one source's documents.

Method: a table of line counts per source is kept and advanced by deltas. Each new partition is counted alone and merged;
lines whose count passes the threshold in the merge are crossings; only documents that hold a newly crossed line, and the
new documents that hold a recurring one, are rebuilt.

The table has one row per source and line, and for lines below the threshold the places where they stand, so that a crossing
finds its earlier documents in the table itself. A line below the threshold stands in fewer documents than it, so no row holds an
unbounded group; a merge reads the table and the new partition, never an earlier partition. A document belongs to one partition.

Lines are split at the line feed and are the same when their letters and digits agree, case aside. A line counts once a
document. Defined results: null texts have no lines; lines without letter or digit and documents without a source don't
count and stay as they are; repeated rows of one document count once; an empty delta changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuemill.runtime import checkpoint_dir, cut, subfolders, weighted_lookup

PLACES = "array<struct<id:long,line_idx:int>>"
STATE = f"source string, line_key string, n long, places {PLACES}"
REMOVED = "id long, line_idx int, line_key string"


def line_key(line: str | Column) -> Column:
    """Letters and digits of a line in lower case; ß is ss, as its capital form is SS."""
    return F.replace(F.regexp_replace(F.lower(line), r"[^\p{L}\p{Nd}]+", ""), F.lit("ß"), F.lit("ss"))


def line_rows(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(id, source, line_idx, line_key) of every countable line."""
    lines = docs.select(F.col(key).cast("long").alias("id"), F.col(source).cast("string").alias("source"), F.posexplode(F.split(text, "\n", -1)).alias("line_idx", "line"))
    return lines.select("id", "source", "line_idx", line_key("line").alias("line_key")).where("source IS NOT NULL AND line_key <> ''")


def count_delta(lines: DataFrame) -> DataFrame:
    """(source, line_key, n): documents per line of one partition. The first aggregation is spread by document, so a line
    that stands in a third of all documents is no hot key of it, and it reaches the second one pre-aggregated."""
    return lines.select("source", "line_key", "id").distinct().groupBy("source", "line_key").agg(F.count("*").alias("n"))


def advance(state: DataFrame, delta: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Merge the lines of a new partition, ``delta`` being its line_rows, into a state.

    Returns the new state and (id, line_idx, line_key) of the lines to remove that were not known before: newly crossed ones of
    earlier partitions, recurring ones of the new one.
    """
    keys = ["source", "line_key"]
    old = state.select(*keys, F.col("n").alias("before"), "places")
    merged = old.join(count_delta(delta), keys, "full_outer")
    merged = cut(merged.select(*keys, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("n", F.lit(0)).alias("uses"), (F.coalesce("before", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n"), "places"))
    over = F.col("n") >= least
    crossed = merged.where(over & (F.col("before") < least)).select("line_key", F.explode("places").alias("p")).select("p.id", "p.line_idx", "line_key")
    found = cut(weighted_lookup(delta, merged.where("uses > 0").select(*keys, over.alias("over"), "uses"), keys, "uses"))
    hits = crossed.unionByName(found.where("over").select("id", "line_idx", "line_key")).distinct()
    fresh = found.where("NOT over").groupBy(*keys).agg(F.collect_set(F.struct("id", "line_idx")).cast(PLACES).alias("fresh"))
    below = merged.where(~over).join(fresh, keys, "left")
    none = F.array().cast(PLACES)
    kept = below.select(*keys, "n", F.concat(F.coalesce("places", none), F.coalesce("fresh", none)).alias("places"))
    return kept.unionByName(merged.where(over).select(*keys, "n", F.lit(None).cast(PLACES).alias("places"))), hits


class LineStore:
    """The state as a stored table: every merge writes the next version beside the lines it removes, both in a shared folder.

    A merge is named, and a name merged before is skipped, so a job that is run again counts nothing twice. A version counts
    once its state and its lines are written whole.
    """

    def __init__(self, spark: SparkSession, folder: str, least: int):
        self.spark, self.folder, self.least = spark, folder.rstrip("/"), least

    def versions(self) -> list[str]:
        """Names of the complete versions, the oldest first."""
        done = [v for v in subfolders(self.spark, self.folder) if "_SUCCESS" in subfolders(self.spark, f"{self.folder}/{v}/state", files=True)]
        return sorted(done)

    def state(self) -> DataFrame:
        last = self.versions()[-1:]
        return self.spark.read.schema(STATE).parquet(f"{self.folder}/{last[0]}/state") if last else self.spark.createDataFrame([], STATE)

    def merge(self, name: str, docs: DataFrame, key: str, source: str, text: str) -> None:
        known = self.versions()
        if any(v.split("-", 1)[1] == name for v in known):
            return
        state, hits = advance(self.state(), line_rows(docs, key, source, text), self.least)
        target = f"{self.folder}/{len(known):06d}-{name}"
        hits.write.mode("overwrite").parquet(f"{target}/removed")
        state.write.mode("overwrite").parquet(f"{target}/state")  # last: its success marker completes the version

    def removed(self) -> DataFrame:
        """(id, line_idx, line_key) of all lines to remove."""
        known = self.versions()
        return self.spark.read.schema(REMOVED).parquet(*[f"{self.folder}/{v}/removed" for v in known]) if known else self.spark.createDataFrame([], REMOVED)


def recurring_lines(partitions: Sequence[DataFrame], key: str, source: str, text: str, least: int, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge every partition in turn into the store at ``folder``, by default a new one; the final state and all lines to remove."""
    spark = partitions[0].sparkSession
    store = LineStore(spark, folder or f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}", least)
    for i, docs in enumerate(partitions):
        store.merge(f"part{i}", docs, key, source, text)
    return store.state(), store.removed().select("id", "line_idx")


def rebuild(docs: DataFrame, removed: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, n_removed) of the documents that hold a line to remove, without those lines; no other document is touched."""
    marks = removed.groupBy("id").agg(F.collect_set("line_idx").alias("gone"))
    hit = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(marks, "id")
    kept = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains("gone", s["i"]))
    return hit.select("id", F.array_join(F.transform(kept, lambda s: s["x"]), "\n").alias("text"), F.size("gone").alias("n_removed"))
