"""Plan against results: what is done, what is left, what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scfsweep.functions import job_folder

# How planned jobs meet results: by the full job name, or by run and job folder alone, for plans that
# do not know the seed's name and for names re-read from logs.
KEYS = {"name": ["run_id", "jobname"], "folder": ["run_id", "job_folder"]}


def _keyed(table: DataFrame, by: str) -> DataFrame:
    if by not in KEYS:
        raise ValueError(f"by must be one of {tuple(KEYS)}, not {by!r}")
    return table if by == "name" else table.withColumn("job_folder", job_folder(F.col("jobname")))


def job_states(results: DataFrame, by: str = "name") -> DataFrame:
    """One row per job that left results; a job re-run to convergence counts as converged.

    Aggregated before any join, so a job with very many rows reaches the join as one.
    """
    return _keyed(results, by).groupBy(*KEYS[by]).agg(
        F.bool_or("converged").alias("converged"), F.count(F.lit(1)).alias("n_rows")
    )


def _converged(results: DataFrame, by: str) -> DataFrame:
    return _keyed(results.filter(F.col("converged")), by).select(*KEYS[by]).distinct()


def pending_jobs(plan: DataFrame, results: DataFrame, by: str = "name") -> DataFrame:
    """Planned jobs with no converged result."""
    return _keyed(plan, by).join(_converged(results, by), KEYS[by], "left_anti")


def done_jobs(plan: DataFrame, results: DataFrame, by: str = "name") -> DataFrame:
    """Planned jobs that need not run again."""
    return _keyed(plan, by).join(_converged(results, by), KEYS[by], "left_semi")


def coverage(plan: DataFrame, results: DataFrame, by: str = "name") -> DataFrame:
    """Every planned job with ``status``: done, not_converged or missing."""
    status = (
        F.when(F.col("n_rows").isNull(), F.lit("missing"))
        .when(F.col("converged"), F.lit("done"))
        .otherwise(F.lit("not_converged"))
    )
    return _keyed(plan, by).join(job_states(results, by), KEYS[by], "left").withColumn("status", status)


def missing_ranges(covered: DataFrame, status: str = "missing") -> DataFrame:
    """Steps without results as ranges: (run_id, job, u, first_k, last_k, n_steps), one row per gap.

    Gaps and islands: steps that follow each other differ from their rank by the same number. Ranks are
    taken within one U value of a run, whose steps a plan bounds, and only over the steps of that status.
    """
    sweep = ["run_id", "job", "u"]
    steps = covered.filter(F.col("status") == status).select(*sweep, "k").distinct()
    island = F.col("k") - F.row_number().over(Window.partitionBy(*sweep).orderBy("k"))
    return (
        steps.withColumn("_island", island)
        .groupBy(*sweep, "_island")
        .agg(F.min("k").alias("first_k"), F.max("k").alias("last_k"), F.count(F.lit(1)).alias("n_steps"))
        .drop("_island")
    )


def coverage_summary(covered: DataFrame) -> DataFrame:
    """Jobs per run, job type and status."""
    return covered.groupBy("run_id", "job", "status").agg(F.count(F.lit(1)).alias("n_jobs"))
