"""CSV outputs. Every table is one write of all runs and channels, split by partition folders.

Rows are range-sorted on the full key first: files come out in order, each folder gets few files,
and a run or channel that holds much of the data is shared by many tasks. ``folders`` names the
partition folders; all other keys are columns of the files. By default runs share files, since there
may be millions of them; ``RUN_CHANNEL`` gives each channel of each run a folder of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.operators.response import in_sweep_order, total_view
from scfsweep.operators.views import channel_view, mean_view
from scfsweep.plans.analyze import Analysis
from scfsweep.schema import (
    CHANNEL_EXPORT_NAMES,
    RESULT_COLUMNS,
    RESULT_FILE_SCHEMA,
    RESULT_HEADER,
    export_names,
    perturbation_column,
)
from scfsweep.scratch import scratch_folder

# Folder of each mode's outputs.
PLOT_FOLDERS = {"u": "plot_U", "alpha": "plot_Alpha", "both": "plot"}
JOB_LABELS = {"u": "U", "alpha": "Alpha"}


RUN_CHANNEL = ("run_id", "channel_id")
PER_CHANNEL = ("channel_id",)


def _csv(table: DataFrame, path: str, folders: tuple[str, ...]) -> None:
    table.write.mode("overwrite").option("header", True).partitionBy(*folders).csv(path)


def _headed(table: DataFrame, names: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Published header names; columns in ``keep`` hold their own."""
    return table.select(*[F.col(c).alias(c if c in keep else names.get(c, c)) for c in table.columns])


def _sorted(table: DataFrame, folders: tuple[str, ...], *rest: str) -> DataFrame:
    """Sorted by folder first, so that each task writes to few of them."""
    keys = [*folders, *[c for c in RUN_CHANNEL if c not in folders], *rest]
    return table.orderBy(*keys)


def write_total_view(rows: DataFrame, job: str, path: str, folders: tuple[str, ...] = ()) -> None:
    """All channels of each run, in sweep order, under their published headers."""
    _csv(_headed(total_view(in_sweep_order(rows)), export_names(job)), path, folders)


def write_channel_views(rows: DataFrame, job: str, path: str, folders: tuple[str, ...] = PER_CHANNEL) -> None:
    """Perturbation and response of each channel; the channel's id also stays in the files."""
    view = _sorted(channel_view(rows, job), folders, "u", perturbation_column(job))
    if "channel_id" in folders:
        first, rest = list(RUN_CHANNEL), [c for c in view.columns if c not in RUN_CHANNEL]
        view = view.select(*first, F.col("channel_id").alias("Channel ID"), *rest)
    _csv(_headed(view, CHANNEL_EXPORT_NAMES, folders), path, folders)


def write_means(means: DataFrame, path: str, folders: tuple[str, ...] = PER_CHANNEL) -> None:
    """Mean responses, sorted by u."""
    _csv(_headed(_sorted(means, folders, "u"), CHANNEL_EXPORT_NAMES, folders), path, folders)


def export_analysis(analysis: Analysis, root: str, folders: tuple[str, ...] = PER_CHANNEL) -> str:
    """Writes what the analysis' mode publishes below ``root``; returns the folder.

    Both jobs: merged means. One job: total view, channel views and means, which share one
    computation of the response rows, written to the shared scratch folder.
    """
    folder = f"{root}/{PLOT_FOLDERS[analysis.mode]}"
    if analysis.mode == "both":
        write_means(analysis.means, f"{folder}/channel_mean", folders)
        return folder
    job = analysis.mode
    spark, kept = analysis.rows[job].sparkSession, analysis.rows[job]
    path = scratch_folder(spark, "rows")
    kept.write.parquet(path)
    rows = spark.read.schema(kept.schema).parquet(path)
    write_total_view(rows, job, f"{folder}/sorted_{JOB_LABELS[job]}")
    write_channel_views(rows, job, f"{folder}/channel_total", folders)
    write_means(mean_view(rows, job), f"{folder}/channel_mean_{JOB_LABELS[job]}", folders)
    return folder


def _file_columns(results: DataFrame) -> DataFrame:
    return results.select(*[F.col(c).alias(h) for c, h in zip(RESULT_COLUMNS, RESULT_HEADER)])


def append_results(results: DataFrame, path: str) -> None:
    """Adds result rows to a result table's folder."""
    _file_columns(results).write.mode("append").option("header", True).csv(path)


def reset_results(spark: SparkSession, path: str) -> None:
    """Starts a result table anew: its folder holds the header and no row."""
    empty = spark.createDataFrame([], RESULT_FILE_SCHEMA)
    empty.write.mode("overwrite").option("header", True).csv(path)
