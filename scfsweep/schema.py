"""Column names, file headers and table schemas shared by the whole package.

Inside the package columns are snake_case and every table carries ``run_id``; the names with
blanks and dashes exist only in files.
"""

from __future__ import annotations

from pyspark.sql import types as T

JOBS = ("u", "alpha")

# Fixed values of the file formats.
RESULT_HEADER = ("Jobname", "Channel ID", "Spin", "Before SCF", "1st SCF", "Last SCF", "Converged")
RESULT_COLUMNS = ("jobname", "channel_id", "spin", "before_scf", "first_scf", "last_scf", "converged")
_RESULT_TYPES = (
    T.StringType(),
    T.IntegerType(),
    T.IntegerType(),
    T.DoubleType(),
    T.DoubleType(),
    T.DoubleType(),
    T.BooleanType(),
)

RESULT_FILE_SCHEMA = T.StructType(
    [T.StructField(name, kind) for name, kind in zip(RESULT_HEADER, _RESULT_TYPES)]
)
# Files that hold the rows of many runs.
SHARED_FILE_SCHEMA = T.StructType([T.StructField("run_id", T.StringType()), *RESULT_FILE_SCHEMA])
RESULT_SCHEMA = T.StructType(
    [T.StructField("run_id", T.StringType())]
    + [T.StructField(name, kind) for name, kind in zip(RESULT_COLUMNS, _RESULT_TYPES)]
)

# Sweep values, offsets and set-points: exact decimals with the 14 places the input files carry.
SWEEP_DECIMAL = T.DecimalType(24, 14)


def check_job(job: str) -> str:
    if job not in JOBS:
        raise ValueError(f"job must be one of {JOBS}, not {job!r}")
    return job


def response_column(job: str) -> str:
    """Name of the response column of one job in per-channel tables."""
    return f"n1_nf_{check_job(job)}"


def perturbation_column(job: str) -> str:
    return f"{check_job(job)}_pert"


def export_names(job: str) -> dict[str, str]:
    """Column -> header name used when a total view of ``job`` is written to CSV."""
    check_job(job)
    return {
        "channel_id": "Channel ID",
        "u": "U",
        "d_first": "S1-S0",
        "d_last": "SF-S0",
        "slope_first": f"{job}/S1-S0",
        "slope_last": f"{job}/SF-S0",
        "pert": f"{job}_pert",
        "n1_nf": "n1-nF",
    }


# Headers of the per-channel tables (channel view, mean and merged mean).
CHANNEL_EXPORT_NAMES = {
    "channel_id": "Channel ID",
    "u": "U",
    "n1_nf_u": "n1-nF_U",
    "n1_nf_alpha": "n1-nF_Alpha",
}
