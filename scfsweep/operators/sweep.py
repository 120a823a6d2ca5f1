"""Sweep plans: every job a run should have, with its set-points, tolerance and path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scfsweep.functions import (
    default_if_blank,
    fixed_text,
    is_integer_text,
    is_number_text,
    is_signed_decimal_text,
    job_path,
    normalise_job,
    scientific_text,
    short_text,
    steps_count,
    steps_list,
)
from scfsweep.schema import SWEEP_DECIMAL

# Defaults of a sweep's arguments.
DEFAULTS = {
    "base_value": "0.00000001",
    "energy_tol": "1e-5",
    "u_start": "0",
    "u_step": "2",
    "u_end": "12",
    "pert_start": "0.05",
    "pert_step": "0.05",
    "pert_end": "0.25",
}
# A sequence with more members than this is taken for a mistake.
MAX_MEMBERS = 1_000_000
_CHECKS = {
    "u_start": is_integer_text,
    "u_step": is_integer_text,
    "u_end": is_integer_text,
    "pert_start": is_signed_decimal_text,
    "pert_step": is_number_text,
    "pert_end": is_signed_decimal_text,
    "base_value": is_number_text,
    "energy_tol": is_number_text,
}


def sweep_arguments(runs: DataFrame) -> DataFrame:
    """Text arguments -> checked and typed ones, one row per run.

    Input columns: run_id, seed, job and any of the names in ``DEFAULTS``, all text. Blanks take the
    default. ``rejected`` names the arguments that are malformed, do not fit the sweep's decimals as
    written (their columns are NULL), or whose step leads nowhere: zero, away from the end, or beyond
    MAX_MEMBERS members. Runs in = accepted + rejected.
    """
    given = {
        name: default_if_blank(F.col(name), default) if name in runs.columns else F.lit(default)
        for name, default in DEFAULTS.items()
    }
    job = normalise_job(F.col("job"))

    def typed(name: str) -> Column:
        text = F.when(_CHECKS[name](given[name]), given[name])
        if name == "energy_tol":
            return text.try_cast("double")
        value, exact = text.try_cast(SWEEP_DECIMAL), text.try_cast("double")
        return F.when(F.abs(value.cast("double") - exact) <= F.abs(exact) * 1e-14, value)

    values = runs.select("run_id", "seed", job.alias("job"), *[typed(name).alias(name) for name in DEFAULTS])

    def step_fault(name: str) -> Column:
        start, step, end = (F.col(f"{name}_{part}").cast("double") for part in ("start", "step", "end"))
        members = F.try_divide(end - start, step)
        return F.coalesce(members, F.when(start.isNotNull() & step.isNotNull() & end.isNotNull(), F.lit(-1.0)))

    faults = []
    for name in _CHECKS:
        fault = F.col(name).isNull()
        if name in ("u_step", "pert_step"):
            members = step_fault(name.removesuffix("_step"))
            fault = fault | F.coalesce((members < 0) | (members >= MAX_MEMBERS), F.lit(False))
        faults.append(F.when(fault, F.lit(name)))
    faults.append(F.when(F.col("job").isNull(), F.lit("job")))
    return values.withColumn("rejected", F.array_join(F.array_compact(F.array(*faults)), ","))


def rejected(arguments: DataFrame) -> DataFrame:
    """Runs that get no plan, and why."""
    return arguments.filter(F.col("rejected") != "").select("run_id", "rejected")


def accepted(arguments: DataFrame) -> DataFrame:
    return arguments.filter(F.col("rejected") == "").drop("rejected")


def swept_values(arguments: DataFrame) -> DataFrame:
    """Adds ``u_values`` and ``alpha_values``: both sequences, each shifted by the base value."""
    base = F.col("base_value")

    def shifted(name: str) -> Column:
        values = steps_list(F.col(f"{name}_start"), F.col(f"{name}_step"), F.col(f"{name}_end"))
        return F.transform(values, lambda v: (v + base).cast(SWEEP_DECIMAL))

    return arguments.withColumn("u_values", shifted("u")).withColumn("alpha_values", shifted("pert"))


def perturbation_times(arguments: DataFrame) -> DataFrame:
    """Number of perturbation steps per run."""
    times = steps_count(F.col("pert_start"), F.col("pert_step"), F.col("pert_end"))
    return arguments.withColumn("times", times)


def sweep_grid(arguments: DataFrame) -> DataFrame:
    """One row per job of every run: each U value with its base job (k = 0) and its steps (k = 1..n).

    Both sequences are exploded from the run's own row, so the plan grows without a join.
    """
    u_values = steps_list(F.col("u_start"), F.col("u_step"), F.col("u_end"))
    shifts = steps_list(F.col("pert_start"), F.col("pert_step"), F.col("pert_end"))
    base = F.array(F.lit(0).cast(SWEEP_DECIMAL))
    per_value = arguments.select("*", F.explode(u_values).alias("u"))
    return per_value.select("*", F.posexplode(F.concat(base, shifts)).alias("k", "shift"))


def with_setpoints(grid: DataFrame) -> DataFrame:
    """Adds the values each job runs at, as numbers and as input-file text.

    The U job sweeps U and keeps alpha at the base value, the alpha job the other way round;
    a perturbation step always adds to alpha.
    """
    swept = F.col("base_value") + F.col("u")
    u_job = F.col("job") == "u"
    alpha_start = F.when(u_job, F.col("base_value")).otherwise(swept)
    return (
        grid.withColumn("u_value", F.when(u_job, swept).otherwise(F.col("base_value")).cast(SWEEP_DECIMAL))
        .withColumn("alpha_value", (alpha_start + F.col("shift")).cast(SWEEP_DECIMAL))
        .withColumn("u_text", fixed_text(F.col("u_value")))
        .withColumn("alpha_text", fixed_text(F.col("alpha_value")))
    )


def with_tolerances(grid: DataFrame) -> DataFrame:
    """Adds the energy tolerance: as given for base jobs, a tenth of it for perturbed ones."""
    tol = F.when(F.col("k") == 0, F.col("energy_tol")).otherwise(F.col("energy_tol") / 10.0)
    return grid.withColumn("tol", tol).withColumn("tol_text", scientific_text(F.col("tol")))


def with_job_paths(grid: DataFrame) -> DataFrame:
    """Adds ``jobname``, spelled as the job's rows in the result tables."""
    name = job_path(short_text(F.col("u")), F.col("job"), F.col("k"), F.col("seed"))
    return grid.withColumn("jobname", name)


def sweep_plan(arguments: DataFrame) -> DataFrame:
    """The full plan of the accepted runs: grid, set-points, tolerances and paths."""
    return with_job_paths(with_tolerances(with_setpoints(sweep_grid(accepted(arguments)))))


def folder_plan(parsed: DataFrame) -> DataFrame:
    """Plan of finished runs, from their parsed folder names: run_id, seed, job, u, k, jobname.

    The folder tells how often each U was perturbed, not by how much, so there are no set-points.
    The cell file may be named unlike the folder: compare with results by ``folder``.
    """
    u_values = steps_list(F.col("init_u"), F.col("step_u"), F.col("final_u"))
    steps = F.sequence(F.lit(0), F.greatest(F.col("times"), F.lit(0)).cast("int"))
    runs = parsed.filter("valid").select(F.col("folder").alias("run_id"), "seed", "job", u_values.alias("_u"), steps.alias("_k"))
    per_value = runs.select("run_id", "seed", "job", "_k", F.explode("_u").alias("u"))
    return with_job_paths(per_value.select("run_id", "seed", "job", "u", F.explode("_k").alias("k")))
