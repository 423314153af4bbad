"""Checkpoints of walks and the operation queue, as table operations. The time now is always a parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import sink_insert_ignore


def ckpt_resumable(runs: DataFrame, now: float, ttl: float = 86_400.0) -> DataFrame:
    """The newest running run of each space, to resume or, if it is too old, to invalidate. Failed runs aren't resumed."""
    newest = Window.partitionBy("space_id").orderBy(F.desc("started_at"), F.desc("run_id"))
    top = runs.where("status = 'running'").withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    return top.select("space_id", "run_id", F.when(F.lit(now) - F.col("started_at") > ttl, "invalidate").otherwise("resume").alias("action"))


def ckpt_save(walked: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(walked tokens with new ones, count of each run)."""
    merged = sink_insert_ignore(walked, more, ["run_id", "token"], "token")  # rows of a key are alike
    return merged, merged.groupBy("run_id").agg(F.count("*").alias("walked_count"))


def ckpt_remaining(nodes: DataFrame, walked: DataFrame) -> DataFrame:
    return nodes.join(walked.select("token"), nodes.node_token == F.col("token"), "left_anti")


def ckpt_transition(runs: DataFrame, changes: DataFrame, now: float) -> DataFrame:
    """changes: run_id, to (completed, failed or invalidated)."""
    return runs.join(changes, "run_id", "left").select("run_id", "space_id", "started_at", F.coalesce("to", "status").alias("status"), F.when(F.col("to") == "completed", F.lit(now)).alias("completed_at"))


def ckpt_cleanup(runs: DataFrame, walked: DataFrame, now: float, age: float = 604_800.0) -> tuple[DataFrame, DataFrame]:
    kept = runs.where((F.col("status") == "running") | (F.lit(now) - F.col("started_at") <= age))
    return kept, walked.join(kept.select("run_id"), "run_id", "left_semi")


def queue_eligible(ops: DataFrame, now: float, n: int, kind: str | None = None, stale: float = 300.0) -> DataFrame:
    """The next n operations: pending and due, or processing since too long; one attempt more."""
    due = (F.col("status") == "pending") & (F.col("scheduled_at") <= now) | (F.col("status") == "processing") & (F.lit(now) - F.col("created_at") > stale)
    rows = ops.where(due if kind is None else due & (F.col("operation_type") == kind))
    return rows.orderBy("scheduled_at", "operation_id").limit(n).select("operation_id", "scheduled_at", (F.col("attempts") + 1).alias("attempts"))


def queue_transition(ops: DataFrame, results: DataFrame, now: float, retry: float = 60.0) -> DataFrame:
    """results: operation_id, ok, permanent, error."""
    dead = F.col("permanent") | (F.col("attempts") >= F.col("max_attempts"))
    return ops.join(results, "operation_id").select(
        "operation_id", F.when(F.col("ok"), "done").when(dead, "failed").otherwise("pending").alias("status"), F.when(~F.col("ok") & ~dead, F.lit(now + retry)).otherwise(F.col("scheduled_at")).alias("scheduled_at"),
        F.when(F.col("ok"), F.lit(now)).alias("processed_at"), F.when(F.col("ok"), "").otherwise(F.substring("error", 1, 500)).alias("last_error"),
    )


def queue_stats(ops: DataFrame) -> DataFrame:
    return ops.groupBy("status").agg(F.count("*").alias("n"))


def queue_cleanup(ops: DataFrame, now: float, age: float = 604_800.0) -> DataFrame:
    return ops.where((F.col("status") != "done") | (F.lit(now) - F.col("processed_at") <= age))
