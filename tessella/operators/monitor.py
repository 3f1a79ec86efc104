"""Run statistics from an edit log ``(event_id, call_id, failed, secs, ts)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.graph import ranked


def running_throughput(log: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """After each finished tile: how many are done, mean seconds per tile and tiles per hour.

    Seconds are summed as whole hundredths over range partitions, so no single task sees the whole log."""
    done = log.where("NOT failed").withColumn("run", F.lit(0)).withColumn("cs", F.round(F.col("secs") * 100).cast("long"))
    r = ranked(done, ["run"], list(order), "idx", "cs")
    n, total = F.col("idx") + 1, F.col("upto")
    return r.select(
        "event_id", n.alias("done"), total.alias("cs"), (total / (n * 100.0)).alias("secs_per_tile"),
        F.when(total > 0, n * 360000.0 / total).alias("tiles_per_hour"),
    )


def progress_every(progress: DataFrame, n: int, step: int = 20) -> DataFrame:
    """Every ``step``-th row and the last one; ``n`` is the number of rows."""
    return progress.where((F.col("done") % step == 0) | (F.col("done") == n))


def retry_report(log: DataFrame, limit: int) -> DataFrame:
    """Per call: attempts, failures, the state of the last attempt, and whether it gave up: ``limit`` failed
    attempts or more and the last one failed. One aggregation, no sort per call."""
    last = F.max_by("failed", F.struct("ts", "event_id"))
    a = log.groupBy("call_id").agg(
        F.count("*").alias("attempts"), F.count_if("failed").alias("failures"), last.alias("last_failed")
    )
    return a.withColumn("gave_up", F.col("last_failed") & (F.col("failures") >= limit))


def throughput_windows(log: DataFrame, width: str = "1 hour") -> DataFrame:
    """Finished tiles and their seconds per tumbling window; works on batches and streams."""
    w = log.where("NOT failed").groupBy(F.window("ts", width).alias("w")).agg(
        F.count("*").alias("tiles"), F.sum(F.round(F.col("secs") * 100).cast("long")).alias("cs")
    )
    return w.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "tiles", "cs")
