import statistics

import pytest
from pyspark.sql import functions as F

from cuemill.runtime import checkpoint_dir, own_folder, subfolders, weighted_lookup


@pytest.fixture
def plain(spark):
    """Partitions as the plan makes them, not as adaptive execution joins them afterwards."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_key_with_a_third_of_all_rows_is_spread(plain):
    rows = plain.range(0, 60_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 997)) AS key", "id")
    lookup = rows.groupBy("key").agg(F.count("*").alias("uses")).withColumn("value", F.length("key"))
    out = weighted_lookup(rows, lookup, ["key"], "uses")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 2 * statistics.median(sizes)
    joined = rows.join(lookup.hint("merge"), "key").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in joined) >= 20_000  # what a plain join does


def test_lookup_keeps_what_has_no_entry_where_asked(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "key string, id long")
    lookup = spark.createDataFrame([("a", 2, "x")], "key string, uses long, value string")
    assert {(r.id, r.value) for r in weighted_lookup(rows, lookup, ["key"], "uses", "left").collect()} == {(1, "x"), (2, None), (3, None), (4, "x")}
    assert weighted_lookup(rows, lookup.limit(0), ["key"], "uses").count() == 0


def test_folders_of_a_run_are_its_own_and_below_the_checkpoints(spark):
    a, b = own_folder(spark, "x"), own_folder(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark)) and subfolders(spark, a) == []
    spark.range(3).write.json(f"{a}/one")
    assert subfolders(spark, a) == ["one"] and "_SUCCESS" in subfolders(spark, f"{a}/one", files=True)
