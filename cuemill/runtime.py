"""Session, table and physical-plan helpers shared by all operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A lookup row is heavy when it stands for at least this share of the rows that look it up; at most 1 / share rows can be heavy.
HEAVY_SHARE = 0.001
#: Characters with the Unicode property White_Space, for Java and Python regular expressions alike.
WHITE = "\\t\\n\\x0b\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cuemill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    return reachable(session)


def reachable(spark: SparkSession) -> SparkSession:
    """Set a session up, once: Python workers import this package from where the driver did, and Arrow batches of long texts stay small."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) == 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; one of our own only where the session names none, as in tests."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    wanted = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not wanted:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        wanted = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    context.setCheckpointDir(wanted)
    return context._jsc.sc().getCheckpointDir().get()


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, for data that one run writes and reads back."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def subfolders(spark: SparkSession, folder: str, files: bool = False) -> list[str]:
    """Names of the folders, or of the files, in a folder of any file system that Spark knows; none if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() != files) if fs.exists(path) else []


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder: lineage ends there, and a lost executor costs nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def widen(df: DataFrame) -> DataFrame:
    """Spread rows over the cores where the input has fewer partitions than there are cores; larger inputs are left as they are.

    For stages whose CPU cost a row is far above its bytes, on tables of one or a few files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns in a place that later filters and projections aren't merged into, so a costly expression runs once."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def weighted_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``lookup`` (unique by ``keys``), whose column ``weight`` tells how many rows will look each entry up.

    Entries that stand for HEAVY_SHARE of the rows or more number at most 1 / HEAVY_SHARE whatever the data, so they
    are broadcast; all other entries are joined by a shuffle in which no key can be hot. ``weight`` is dropped.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    least = max(2.0, total * HEAVY_SHARE)
    marked = F.broadcast(lookup.where(F.col(weight) >= least).select(*keys, F.lit(True).alias("_heavy")))
    tagged = rows.join(marked, list(keys), "left")
    heavy = tagged.where(F.col("_heavy")).drop("_heavy").join(F.broadcast(lookup.where(F.col(weight) >= least)), list(keys), how)
    light = tagged.where(F.col("_heavy").isNull()).drop("_heavy").join(lookup.where(F.col(weight) < least), list(keys), how)
    return heavy.unionByName(light).drop(weight)


def text_of(column: str | Column) -> Column:
    """Any column as a string, null as the empty string."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def segment_texts(column: str) -> Column:
    """array<string> of the texts of an array of segments: null segments and null texts are empty strings, a null array is an empty one."""
    return F.coalesce(
        F.transform(F.col(column), lambda s: F.coalesce(s["text"], F.lit(""))),
        F.array().cast(T.ArrayType(T.StringType())),
    )
