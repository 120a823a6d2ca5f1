"""Column expressions over job names such as ``./U_2_u/U_2_u_3/SEED``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scfsweep.schema import check_job

# How job names spell the swept value, the step and a perturbed folder.
U_PATTERN = r"U_(\d+)"
SIGNED_U_PATTERN = r"U_(-?\d+(?:\.\d+)?)"
STEP_PATTERNS = {"u": r"u_(\d+)", "alpha": r"alpha_(\d+)"}
PERTURBED_FOLDER_PATTERN = r"U_-?\d+(\.\d+)?_(u|alpha)_\d+/"
PERTURBED_SLASHES = 3


def _group(text: Column, pattern: str) -> Column:
    # regexp_extract gives '' where nothing matches, which an ANSI cast would refuse.
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def job_u(jobname: Column, signed: bool = False) -> Column:
    """Swept value named by the job: a whole number, or with ``signed`` also -2 and 0.5."""
    if signed:
        return _group(jobname, SIGNED_U_PATTERN).try_cast("double")
    return _group(jobname, U_PATTERN).try_cast("int")


def job_step(jobname: Column, job: str) -> Column:
    """Number of the perturbation step, 1-based; NULL for a base job."""
    return _group(jobname, STEP_PATTERNS[check_job(job)]).try_cast("int")


def all_slashes(text: Column) -> Column:
    """Count of ``/``, without running a regular expression over every row."""
    return F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit("")))


def is_perturbed(jobname: Column, by: str = "depth") -> Column:
    """True for perturbed jobs.

    ``depth`` asks for exactly three slashes, so names re-read from logs (one slash) never pass;
    ``folder`` looks for the perturbed folder's name instead and accepts both spellings.
    """
    if by == "depth":
        return all_slashes(jobname) == PERTURBED_SLASHES
    if by == "folder":
        return jobname.rlike(PERTURBED_FOLDER_PATTERN)
    raise ValueError(f"by must be 'depth' or 'folder', not {by!r}")


def seed_of(jobname: Column) -> Column:
    """Last component of the job name."""
    return F.substring_index(jobname, "/", -1)


def job_folder(jobname: Column) -> Column:
    """Name of the folder a job ran in: ``U_2_u`` or ``U_2_u_3``, however much of the path is given."""
    return F.substring_index(F.substring_index(jobname, "/", -2), "/", 1)


def file_stem(path: Column) -> Column:
    """The path without its last extension."""
    return F.regexp_replace(path, r"\.[^./]+$", "")


def job_path(u_text: Column, job: Column, step: Column, seed: Column) -> Column:
    """Name a planned job gets in the results; ``step`` 0 is the base job."""
    base = F.concat(F.lit("U_"), u_text, F.lit("_"), job)
    perturbed = F.concat(F.lit("./"), base, F.lit("/"), base, F.lit("_"), step.cast("string"), F.lit("/"), seed)
    return F.when(step == 0, F.concat(F.lit("./"), base, F.lit("/"), seed)).otherwise(perturbed)


def normalise_job(text: Column) -> Column:
    """``u``/``U`` -> ``u``, ``alpha``/``Alpha`` -> ``alpha``, anything else NULL."""
    return F.when(text.isin("u", "U"), F.lit("u")).when(text.isin("alpha", "Alpha"), F.lit("alpha"))
