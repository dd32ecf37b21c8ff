"""Run tables: validity, speedup against the moving baseline, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_is_valid():
    """Memory may be NULL, where it was not measured."""
    measured = F.coalesce(F.col("memory_mb") >= 0, F.lit(True))
    checks = (F.col("worker_count") >= 1) & (F.col("seconds") >= 0) & measured
    return F.coalesce(checks, F.lit(False))


def invalid_runs(runs: DataFrame) -> DataFrame:
    return runs.where(~run_is_valid())


def speedup(baseline, seconds):
    """Baseline over time; 0 for a zero time, NULL without a baseline."""
    return F.when(baseline.isNull(), F.lit(None)).when(seconds == 0, F.lit(0.0)).otherwise(baseline / seconds)


def efficiency(speedup_value, workers):
    """Speedup per worker in percent; 0 for no workers."""
    return F.when(speedup_value.isNull(), F.lit(None)).when(workers == 0, F.lit(0.0)).otherwise(
        speedup_value / workers * 100
    )


def with_speedup(runs: DataFrame, chunk: int = 65536) -> DataFrame:
    """Compare each run with the latest earlier one-worker run of its experiment.

    ``run_seq`` is unique within an experiment.  The running baseline is found in
    two steps so that a long experiment never sorts in one task: within pieces of
    ``chunk`` consecutive run numbers, and across the one-row-per-piece table.
    """
    alone = F.when(F.col("worker_count") == 1, F.col("seconds"))
    cut = runs.withColumn("_piece", F.expr(f"run_seq DIV {int(chunk)}"))

    earlier_pieces = (
        Window.partitionBy("experiment").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        cut.groupBy("experiment", "_piece")
        .agg(F.max_by(alone, F.when(alone.isNotNull(), F.col("run_seq"))).alias("_last"))
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier_pieces))
        .drop("_last")
    )
    earlier_runs = (
        Window.partitionBy("experiment", "_piece")
        .orderBy("run_seq")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    baseline = F.coalesce(F.last(alone, ignorenulls=True).over(earlier_runs), F.col("_carried"))
    return (
        cut.join(carried, ["experiment", "_piece"])
        .withColumn("baseline_seconds", baseline)
        .drop("_piece", "_carried")
        .withColumn("mode", F.when(F.col("worker_count") == 1, "sequential").otherwise("parallel"))
        .withColumn("memory_mb", F.greatest("memory_mb", F.lit(0.0)))
        .withColumn("speedup", speedup(F.col("baseline_seconds"), F.col("seconds")))
        .withColumn("efficiency", efficiency(F.col("speedup"), F.col("worker_count")))
    )


def runs_by_workers(measured: DataFrame) -> DataFrame:
    """Mean time and mean speedup per worker count."""
    return measured.groupBy("worker_count").agg(
        F.avg("seconds").alias("mean_seconds"), F.avg("speedup").alias("mean_speedup")
    )


def experiment_summary(runs: DataFrame) -> DataFrame:
    """The summary rows of experiments, ready for the CSV sink."""
    return runs.select(
        "experiment",
        "status",
        F.col("worker_count").alias("workers"),
        "repeat",
        F.col("seconds").alias("elapsed_seconds"),
        "point_count",
        "error",
    )


def experiment_stability(runs: DataFrame) -> DataFrame:
    """Per worker count: all repeats succeeded on one and the same input."""
    same_input = (F.min("checksum") == F.max("checksum")) & (F.count("checksum") == F.count(F.lit(1)))
    return (
        runs.groupBy("experiment", "worker_count")
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.every(F.coalesce(F.col("status") == "success", F.lit(False))).alias("all_success"),
            F.coalesce(same_input, F.lit(False)).alias("same_input"),
        )
        .withColumn("is_stable", F.col("all_success") & F.col("same_input"))
    )
