"""Result tables: one CSV row per (job, channel, spin), for many runs at once."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.schema import RESULT_COLUMNS, RESULT_FILE_SCHEMA, RESULT_HEADER, RESULT_SCHEMA, SHARED_FILE_SCHEMA, check_job
from scfsweep.sources.paths import named_apart, one_folder, roots_of, run_key

_BAD_ROWS = {"fail": "FAILFAST", "null": "PERMISSIVE", "drop": "DROPMALFORMED"}


def csv_options(header: bool, on_bad: str) -> dict[str, object]:
    """How result files are read, in batch and as a stream."""
    return {
        "header": header,
        "enforceSchema": not header,
        "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True,
        "mode": _BAD_ROWS[on_bad],
    }


def read_results(
    spark: SparkSession,
    paths: str | list[str],
    *,
    header: bool = True,
    run_level: int = 1,
    on_bad: str = "fail",
    keep_order: bool = False,
    by_name: bool | None = None,
    modified_after: str | None = None,
    any_depth: bool = False,
    shared: bool = False,
) -> DataFrame:
    """Result CSVs as rows with ``run_id``, the folder ``run_level`` above each file.

    A run is named by that folder's name; where several paths or a pattern are given, and so two
    folders may have one name, by the folder's whole path. ``by_name`` decides otherwise.
    A header is checked against the expected names. Blanks after commas are accepted. A value that
    is no number fails the read unless ``on_bad`` is ``null`` or ``drop``. ``keep_order`` adds the
    orderable column ``seen``, which follows the line order of each file. ``modified_after`` (a time such as
    2024-05-01T12:00:00) leaves out older files without opening them. ``any_depth`` also reads the folders
    below the paths, which tasks list; a pattern of many folders is listed by the driver alone. ``shared`` reads
    files of many runs, whose first column names each row's run: ``run_id`` is that name, ``folder`` the folder's.
    """
    reader = spark.read.schema(SHARED_FILE_SCHEMA if shared else RESULT_FILE_SCHEMA).options(**csv_options(header, on_bad))
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    if any_depth:
        reader = reader.option("recursiveFileLookup", True)
    raw = reader.csv(paths)
    by_name = named_apart(paths) if by_name is None else by_name
    folder = run_key(by_name, run_level)
    columns = [folder.alias("folder"), F.col("run_id")] if shared else [folder.alias("run_id")]
    columns += [F.col(f"`{old}`").alias(new) for old, new in zip(RESULT_HEADER, RESULT_COLUMNS)]
    if keep_order:
        # Row ids only order lines of one split; the split's offset orders splits of a file.
        columns.append(
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("seen")
        )
    return raw.select(*columns)


def read_run_results(spark: SparkSession, root: str | list[str], job: str, **options) -> DataFrame:
    """Final tables of one job from every run folder below one or several roots."""
    paths = [f"{r}/*/result_{check_job(job)}_final.csv" for r in roots_of(root)]
    return read_results(spark, paths, **{"by_name": one_folder(root), **options})


def read_run_parts(spark: SparkSession, root: str | list[str], job: str, **options) -> DataFrame:
    """Headerless per-value tables ``U_*_{job}/result_{job}.csv`` of every run below the roots."""
    paths = [f"{r}/*/U_*_{check_job(job)}/result_{job}.csv" for r in roots_of(root)]
    return read_results(spark, paths, header=False, run_level=2, **{"by_name": one_folder(root), **options})


def append_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """Result tables one after another; repeated rows stay repeated."""
    return reduce(DataFrame.unionByName, parts)


def conform(table: DataFrame) -> DataFrame:
    """Any table with the result columns, cast to the result types and in their order."""
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA])
