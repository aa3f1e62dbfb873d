"""Failure reports, the circuit breaker, backoff, and model throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuemill.params import DEFAULTS, FAILURE_REASONS, Params


def transient(reason: Column) -> Column:
    """Whether a failure may pass by itself."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in FAILURE_REASONS.items() for x in pair])[reason], F.lit(False))


def failure_counts(failures: DataFrame, reason: str = "reason", flag: str = "transient") -> DataFrame:
    """(reason, failures, transient) in order of reason."""
    return failures.groupBy(reason).agg(F.count("*").alias("failures"), F.count_if(flag).alias("transient")).orderBy(reason)


def circuit_breaker(attempts: DataFrame, key: str, order: str, outcome: str, limit: int = DEFAULTS.block_abort) -> DataFrame:
    """The attempts that are made before ``limit`` blocked ones in a row end the run.

    Skipped attempts neither count nor break a row of blocks; every other outcome breaks it. Rows after the end are dropped;
    ``run_length`` is the row of blocks so far and ``aborted`` marks the attempt that ends the run. A key is one run of a job, whose
    attempts are made one after the other, so its window is bounded by what one job does.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    blocked, skipped = F.col(outcome) == "blocked", F.col(outcome) == "skipped"
    island = attempts.withColumn("_island", F.sum(F.when(blocked | skipped, 0).otherwise(1)).over(w))
    inside = Window.partitionBy(key, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = island.withColumn("run_length", F.sum(F.when(blocked, 1).otherwise(0)).over(inside))
    hit = counted.withColumn("_hit", F.sum(F.when(blocked & (F.col("run_length") >= limit), 1).otherwise(0)).over(w))
    return hit.where((F.col("_hit") == 0) | ((F.col("_hit") == 1) & blocked & (F.col("run_length") == limit))).withColumn("aborted", F.col("_hit") == 1).drop("_island", "_hit")


def backoff_seconds(attempt: Column, p: Params = DEFAULTS) -> Column:
    """Delay after a failed attempt, counted from 0: base times factor to the attempt, capped."""
    return F.least(F.lit(p.backoff_base) * F.pow(F.lit(p.backoff_factor), attempt), F.lit(p.backoff_cap))


def paced(requests: DataFrame, key: str, order: str, seconds: str, unit: str, delay: float = DEFAULTS.request_delay, jitter: float = DEFAULTS.request_jitter) -> DataFrame:
    """Requests with ``starts``, seconds after the first of their key: a request begins when the one before is done and at least a
    jittered delay after that one began. ``unit`` is a number from -1 to 1 for each request, by which the delay before the next varies."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    wait = F.greatest(F.coalesce(F.col(seconds).cast("double"), F.lit(0.0)), F.lit(float(delay)) * (1 + F.lit(float(jitter)) * F.col(unit)))
    return requests.withColumn("starts", F.coalesce(F.sum(wait).over(w), F.lit(0.0)))


def scrape_verdict(outcomes: DataFrame) -> DataFrame:
    """One row (saved, skipped, failed, aborted, ok): a scrape is fine when the breaker didn't end it and something was saved or was there already."""
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    out = outcomes.agg(n("saved").alias("saved"), n("skipped").alias("skipped"), n("failed", "blocked").alias("failed"), F.coalesce(F.max("aborted"), F.lit(False)).alias("aborted"))
    return out.withColumn("ok", ~F.col("aborted") & (F.col("saved") + F.col("skipped") > 0))


def tokens_per_second(tokens: Column, nanoseconds: Column) -> Column:
    """Throughput of summed counters; null unless both are positive."""
    return F.when((tokens > 0) & (nanoseconds > 0), tokens / (nanoseconds / F.lit(1e9)))


def model_report(runs: DataFrame, ok: str = "success") -> DataFrame:
    """(model, runs, ok, failed, avg_seconds, total_seconds, retried) over processing runs; null durations don't count.

    Where the runs have ``tokens``, those of successful runs come out as tokens and tokens a second of their time.
    """
    counted = "tokens" in runs.columns
    good = F.col("status") == ok
    extra = [F.sum(F.when(good, F.col("tokens"))).alias("tokens"), F.sum(F.when(good, F.col("duration_ms"))).alias("good_ms")] if counted else []
    attempts = runs.groupBy("model", "video_id").agg(F.count("*").alias("n"), F.count_if(good).alias("ok"), F.sum("duration_ms").alias("ms"), F.count("duration_ms").alias("timed"), *extra)
    total = [F.sum("tokens").alias("tokens"), tokens_per_second(F.sum("tokens"), F.sum("good_ms") * 1_000_000).alias("per_second")] if counted else []
    return attempts.groupBy("model").agg(
        *total,
        F.sum("n").alias("runs"), F.sum("ok").alias("ok"), (F.sum("n") - F.sum("ok")).alias("failed"),
        (F.sum("ms") / F.sum("timed") / 1000).alias("avg_seconds"), (F.sum("ms") / 1000).alias("total_seconds"), F.count_if(F.col("n") > 1).alias("retried"),
    )
