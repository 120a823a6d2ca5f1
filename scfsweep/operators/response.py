"""From result rows to the response of every (run, job, channel)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scfsweep.functions import is_perturbed, job_step, job_u, reciprocal
from scfsweep.functions.jobs import SIGNED_U_PATTERN
from scfsweep.schema import check_job

SUM_KEYS = ("run_id", "jobname", "channel_id")
TOTAL_COLUMNS = (
    "run_id",
    "channel_id",
    "u",
    "d_first",
    "d_last",
    "slope_first",
    "slope_last",
    "pert",
    "n1_nf",
)


def select_results(results: DataFrame, *, perturbed_by: str = "depth", converged_only: bool = False) -> DataFrame:
    """Perturbed jobs, the columns that are computed on, and their strict types."""
    rows = results.filter(is_perturbed(F.col("jobname"), perturbed_by))
    if converged_only:
        rows = rows.filter(F.col("converged"))
    kept = [
        F.col("run_id"),
        F.col("jobname"),
        F.col("channel_id").cast("int").alias("channel_id"),
        *[F.col(c).cast("double").alias(c) for c in ("before_scf", "first_scf", "last_scf")],
    ]
    if "seen" in results.columns:
        kept.append(F.col("seen"))
    return rows.select(*kept)


def base_results(results: DataFrame, *, perturbed_by: str = "depth") -> DataFrame:
    """Rows of the unperturbed jobs, which the response leaves out."""
    return results.filter(~is_perturbed(F.col("jobname"), perturbed_by))


def unread_u(results: DataFrame) -> DataFrame:
    """Jobs whose U is no whole number (a sign, a fraction, none at all): (run_id, jobname, u_text).

    Without ``signed_u`` these are read by their leading digits or not at all, so U_0.5 and U_0.25
    meet in the mean of U = 0. Look here before trusting means of such runs.
    """
    text = F.regexp_extract("jobname", SIGNED_U_PATTERN, 1)
    odd = results.filter(~text.rlike("^[0-9]{1,9}$"))
    return odd.select("run_id", "jobname", text.alias("u_text")).distinct()


def drop_repeats(results: DataFrame) -> DataFrame:
    """One row per (run, job, channel, spin) when a job's rows were appended more than once.

    Of differing repeats a converged one wins, then the largest values, so the choice never depends
    on task order. Partial aggregation keeps a job repeated very often from becoming one big group.
    """
    keys = [*SUM_KEYS, "spin"]
    best = F.max(F.struct("converged", "last_scf", "first_scf", "before_scf")).alias("best")
    return results.groupBy(*keys).agg(best).select(
        *keys, "best.before_scf", "best.first_scf", "best.last_scf", "best.converged"
    )


def spin_sums(selected: DataFrame) -> DataFrame:
    """Both spins added per (run, job, channel): s0, s1, sf. A sum over nothing but NULL is 0."""
    sums = [
        F.coalesce(F.sum(source), F.lit(0.0)).alias(name)
        for source, name in (("before_scf", "s0"), ("first_scf", "s1"), ("last_scf", "sf"))
    ]
    if "seen" in selected.columns:
        sums.append(F.min("seen").alias("seen"))
    return selected.groupBy(*SUM_KEYS).agg(*sums)


def differences(sums: DataFrame, job: str, *, signed_u: bool = False) -> DataFrame:
    """Adds u, the step number k and the two occupation differences."""
    name = F.col("jobname")
    return sums.select(
        *SUM_KEYS,
        job_u(name, signed_u).alias("u"),
        job_step(name, check_job(job)).alias("k"),
        (F.col("s1") - F.col("s0")).alias("d_first"),
        (F.col("sf") - F.col("s0")).alias("d_last"),
        *([F.col("seen")] if "seen" in sums.columns else []),
    )


def slopes(diffs: DataFrame, job: str, step: float | DataFrame, *, alpha_includes_u: bool = True) -> DataFrame:
    """Adds slope_first, slope_last, their difference n1_nf and the perturbation ``k * step``.

    ``step`` is one increment for all runs, or a table (run_id, step) with each run's own.
    The alpha job perturbs on top of the swept value, so its numerator is ``k * step + u``;
    ``alpha_includes_u=False`` leaves ``u`` out.
    """
    if isinstance(step, DataFrame):
        own = step.select("run_id", F.col("step").cast("double").alias("_step"))
        with_own = slopes_of(diffs.join(own, "run_id"), job, F.col("_step"), alpha_includes_u)
        return with_own.drop("_step")
    return slopes_of(diffs, job, F.lit(float(step)), alpha_includes_u)


def slopes_of(diffs: DataFrame, job: str, step: Column, alpha_includes_u: bool) -> DataFrame:
    """:func:`slopes` with the increment as a column of each row."""
    pert = F.col("k") * step
    shifted = check_job(job) == "alpha" and alpha_includes_u
    numerator = pert + F.col("u") if shifted else pert
    return (
        diffs.withColumn("slope_first", numerator * reciprocal(F.col("d_first")))
        .withColumn("slope_last", numerator * reciprocal(F.col("d_last")))
        .withColumn("n1_nf", F.col("slope_first") - F.col("slope_last"))
        .withColumn("pert", pert)
    )


def response_rows(
    results: DataFrame,
    job: str,
    step: float | DataFrame,
    *,
    perturbed_by: str = "depth",
    converged_only: bool = False,
    dedupe: bool = False,
    alpha_includes_u: bool = True,
    signed_u: bool = False,
) -> DataFrame:
    """One row per (run, perturbed job, channel), job name and step kept for later merging."""
    sums = job_sums(results, perturbed_by=perturbed_by, converged_only=converged_only, dedupe=dedupe)
    return sum_responses(sums, job, step, alpha_includes_u=alpha_includes_u, signed_u=signed_u)


def job_sums(results: DataFrame, *, perturbed_by: str = "depth", converged_only: bool = False, dedupe: bool = False) -> DataFrame:
    """Spin sums of the rows that :func:`response_rows` selects."""
    rows = drop_repeats(results) if dedupe else results
    return spin_sums(select_results(rows, perturbed_by=perturbed_by, converged_only=converged_only))


def sum_responses(sums: DataFrame, job: str, step: float | DataFrame, *, alpha_includes_u: bool = True, signed_u: bool = False) -> DataFrame:
    """Responses of spin sums."""
    return slopes(differences(sums, job, signed_u=signed_u), job, step, alpha_includes_u=alpha_includes_u)


def both_responses(results: DataFrame, steps: dict[str, float], *, alpha_includes_u: bool = True, signed_u: bool = False, **selection) -> DataFrame:
    """Responses of both jobs of one table, with the ``job`` their names tell: one pass and no union.

    A union hides how its sides lie; rows of one table keep the layout they were stored in.
    """
    name = F.col("jobname")
    found = job_sums(results, **selection).withColumn("job", F.when(name.contains("_alpha_"), F.lit("alpha")).when(name.contains("_u_"), F.lit("u")))
    of_job = lambda values: F.coalesce(*[F.when(F.col("job") == job, value) for job, value in values.items()])
    pert = F.col("k") * of_job({job: F.lit(float(step)) for job, step in steps.items()})
    shifted = (F.col("job") == "alpha") & F.lit(alpha_includes_u)
    rows = found.filter(F.col("job").isin(*steps)).select(
        *SUM_KEYS, "job", job_u(name, signed_u).alias("u"), of_job({job: job_step(name, job) for job in steps}).alias("k"), (F.col("s1") - F.col("s0")).alias("d_first"), (F.col("sf") - F.col("s0")).alias("d_last")
    )
    rows = rows.withColumn("pert", pert)
    numerator = F.when(shifted, F.col("pert") + F.col("u")).otherwise(F.col("pert"))
    return rows.withColumn("n1_nf", numerator * reciprocal(F.col("d_first")) - numerator * reciprocal(F.col("d_last")))


def total_view(rows: DataFrame) -> DataFrame:
    """The published columns of a response table (the job name is dropped)."""
    return rows.select(*TOTAL_COLUMNS)


def in_sweep_order(rows: DataFrame) -> DataFrame:
    """Rows sorted for export: as first seen in each file where that was kept, else u, step, channel.

    A range-partitioned sort over the whole key, so one large run spreads over many tasks.
    """
    if "seen" in rows.columns:
        return rows.orderBy("run_id", "seen", "jobname", "channel_id")
    steps = [c for c in ("k", "pert") if c in rows.columns][:1]
    return rows.orderBy("run_id", "u", *steps, "channel_id")
