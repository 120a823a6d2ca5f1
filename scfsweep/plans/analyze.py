"""Whole analyses: one job alone, or both jobs of every run merged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scfsweep.operators.merge import merge_by_key, merge_by_position, merged_mean
from scfsweep.operators.pairing import increments, pair_runs, relabelled
from scfsweep.operators.response import job_sums, response_rows, sum_responses
from scfsweep.operators.views import mean_view
from scfsweep.schema import check_job
from scfsweep.scratch import kept
from scfsweep.sources import parse_folders, read_run_results, run_folders

MODES = ("both", "u", "alpha")
_MERGES = {"position": merge_by_position, "key": merge_by_key}


@dataclass(frozen=True)
class Analysis:
    """Lazy tables of an analysis. ``rows`` maps each analysed job to its response rows."""

    mode: str
    rows: dict[str, DataFrame]
    means: DataFrame


def perturbation_values(mode: str, u: float | None = None, alpha: float | None = None) -> dict[str, float]:
    """Perturbation increment per analysed job; each mode needs exactly its own ones present."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    given = {"u": u, "alpha": alpha}
    wanted = ("u", "alpha") if mode == "both" else (mode,)
    lacking = [job for job in wanted if given[job] is None]
    if lacking:
        raise ValueError(f"mode {mode!r} needs the perturbation value of {', '.join(lacking)}")
    return {job: float(given[job]) for job in wanted}


def analyze_single(results: DataFrame, job: str, step: float, **options) -> Analysis:
    """Response and per-U means of one job."""
    rows = response_rows(results, check_job(job), step, **options)
    return Analysis(job, {job: rows}, mean_view(rows, job))


def analyze_pairs(results_u: DataFrame, results_alpha: DataFrame, pairs: DataFrame, *, align: str = "position", **options) -> Analysis:
    """Both jobs of runs that lie in folders of their own, paired by :func:`pair_runs`.

    Both sides come under the U folder's name, each pair with its own perturbation increment. Rows are
    summed before they are renamed, so the join moves one row per (folder, job, channel), and an alpha
    folder that serves several U folders is summed once.
    """
    if align not in _MERGES:
        raise ValueError(f"align must be one of {tuple(_MERGES)}, not {align!r}")
    steps = increments(pairs)
    tables = {"u": results_u, "alpha": results_alpha}
    late = {k: options.pop(k) for k in ("alpha_includes_u", "signed_u") if k in options}
    rows = {
        job: sum_responses(relabelled(job_sums(table, **options), pairs, job), job, steps, **late) for job, table in tables.items()
    }
    return Analysis("both", rows, merged_mean(_MERGES[align](rows["u"], rows["alpha"])))


def analyze_folders(spark: SparkSession, root: str | list[str], *, align: str = "position", **options) -> Analysis:
    """:func:`analyze_pairs` of all run folders below one or several roots."""
    parsed = kept(parse_folders(run_folders(spark, root)), "folders")
    pairs = kept(pair_runs(parsed), "pairs")
    u, alpha = (read_run_results(spark, root, job) for job in ("u", "alpha"))
    return analyze_pairs(u, alpha, pairs, align=align, **options)


def analyze(
    results_u: DataFrame | None,
    results_alpha: DataFrame | None,
    *,
    mode: str = "both",
    u_step: float | None = None,
    alpha_step: float | None = None,
    align: str = "position",
    **options,
) -> Analysis:
    """Analysis in any mode. ``align`` chooses how both jobs meet: by position, or by key.

    ``options`` are those of :func:`scfsweep.operators.response.response_rows`.
    """
    steps = perturbation_values(mode, u_step, alpha_step)
    tables = {"u": results_u, "alpha": results_alpha}
    absent = [job for job in steps if tables[job] is None]
    if absent:
        raise ValueError(f"mode {mode!r} needs the results of {', '.join(absent)}")
    if mode != "both":
        return analyze_single(tables[mode], mode, steps[mode], **options)
    rows = {job: response_rows(tables[job], job, step, **options) for job, step in steps.items()}
    if align not in _MERGES:
        raise ValueError(f"align must be one of {tuple(_MERGES)}, not {align!r}")
    return Analysis(mode, rows, merged_mean(_MERGES[align](rows["u"], rows["alpha"])))
