"""Means of many runs kept in a store, of which a refresh analyses the changed runs only.

A run's results are one file, which is replaced as a whole. Modification times tell which files are new or
replaced since the last refresh; the others are not opened. A refresh writes the means of the runs it read,
and those runs' names, under its number; readers take each run from the newest refresh that has it. So a run
that lost rows loses their means, and a refresh that broke off before its last write shows nowhere.

A file per run costs the file system some work for each run, in writing, listing and opening it. Many small
runs had better share files (``shared``): a folder's file then holds many runs, and is replaced as a whole, too.
So a run that a new file lacks loses its means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.plans.analyze import analyze_single
from scfsweep.scratch import kept
from scfsweep.sources.paths import named_apart, run_key
from scfsweep.sources.results import read_results

_REFRESH = "refresh"
# run_id is the key of a folder, of one run or of many
_RUNS = f"run_id string, upto timestamp, {_REFRESH} long"


def start_store(spark: SparkSession, store: str) -> None:
    """A new store without runs; one that is there starts anew."""
    spark.createDataFrame([], _RUNS).write.mode("overwrite").parquet(f"{store}/runs")


def _files(spark: SparkSession, paths: str, run_level: int, after: str | None) -> DataFrame:
    """(run_id, modified) of the result files. Only metadata is selected, so no file is opened."""
    reader = spark.read.format("binaryFile")
    if after is not None:
        reader = reader.option("modifiedAfter", after)
    return reader.load(paths).select(run_key(named_apart(paths), run_level, "path").alias("run_id"), F.col("modificationTime").alias("modified"))


def refresh_means(
    spark: SparkSession, paths: str, job: str, step: float, store: str, *, run_level: int = 1, shared: bool = False, **options
) -> int:
    """Analyses the runs whose files changed since the last refresh; returns the number of their folders.

    Files as old as the last one seen then are read again: times have whole seconds, and reading a run
    twice gives the same means. With ``shared`` each folder's file holds many runs, which its first column names.
    """
    last = spark.read.schema(_RUNS).parquet(f"{store}/runs").agg(F.max("upto").alias("upto"), F.max(_REFRESH).alias("n")).first()
    after = None
    if last.upto is not None:
        after = spark.range(1).select(F.date_format(F.lit(last.upto) - F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss").alias("t")).first().t
    files = _files(spark, paths, run_level, after)
    number = 0 if last.n is None else last.n + 1
    found = files.groupBy("run_id").agg(F.max("modified").alias("upto")).withColumn(_REFRESH, F.lit(number).cast("long"))
    # the files' times are asked for once, and before the files are read
    changed = kept(found, "changed")
    n = changed.count()
    if n:
        results = read_results(spark, paths, run_level=run_level, modified_after=after, shared=shared)
        if shared:
            results = results.withColumn("run_id", F.struct("folder", "run_id"))
        means = analyze_single(results, job, step, **options).means
        if shared:
            means = means.select("run_id.folder", "run_id.run_id", *[c for c in means.columns if c != "run_id"])
        means.write.mode("overwrite").parquet(f"{store}/means/{_REFRESH}={number}")
        # last: from here on the refresh counts
        changed.write.mode("append").parquet(f"{store}/runs")
    return n


def stored_run_means(spark: SparkSession, store: str) -> DataFrame:
    """Means of every run as of its newest refresh. A run of a shared folder is named ``folder/run``."""
    newest = spark.read.schema(_RUNS).parquet(f"{store}/runs").groupBy("run_id").agg(F.max(_REFRESH).alias(_REFRESH))
    means = spark.read.parquet(f"{store}/means").withColumn(_REFRESH, F.col(_REFRESH).cast("long"))
    if "folder" not in means.columns:
        return means.join(newest, ["run_id", _REFRESH], "left_semi").drop(_REFRESH)
    current = means.join(newest.withColumnRenamed("run_id", "folder"), ["folder", _REFRESH], "left_semi").drop(_REFRESH)
    return current.withColumn("run_id", F.concat_ws("/", "folder", "run_id")).drop("folder")
