"""Result tables that grow while jobs finish.

Result rows carry no event time, so state cannot expire: it holds one entry per distinct key seen,
kept by the state store's partitions, never by one task. Every query here runs
``trigger(availableNow=True)``: it takes what has arrived and ends; run it again to go on from its
checkpoint. Production sessions should keep state in RocksDB, off the executors' heap:
``spark.sql.streaming.stateStore.providerClass`` = ``org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.operators.response import SUM_KEYS, differences, drop_repeats, select_results, slopes, spin_sums
from scfsweep.schema import RESULT_COLUMNS, RESULT_FILE_SCHEMA, RESULT_HEADER
from scfsweep.sources.paths import named_apart, run_key
from scfsweep.sources.results import csv_options

SPIN_KEYS = (*SUM_KEYS, "spin")
_VERSION = "batch_id"
_UPTO = "upto"


def read_result_stream(
    spark: SparkSession,
    path: str,
    *,
    header: bool = True,
    run_level: int = 1,
    files_per_batch: int = 1000,
    on_bad: str = "fail",
    by_name: bool | None = None,
) -> DataFrame:
    """Result CSVs as a stream; each new file is read once, as strictly as in batch."""
    raw = (
        spark.readStream.schema(RESULT_FILE_SCHEMA)
        .options(**csv_options(header, on_bad))
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    return raw.select(
        run_key(named_apart(path) if by_name is None else by_name, run_level).alias("run_id"),
        *[F.col(f"`{old}`").alias(new) for old, new in zip(RESULT_HEADER, RESULT_COLUMNS)],
    )


def append_stream(results: DataFrame, target: str, checkpoint: str, form: str = "parquet") -> None:
    """Appends arriving rows to a table of files (``parquet``, ``csv``, ...), each exactly once."""
    query = (
        results.writeStream.format(form)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def _write_updates(updates: DataFrame, target: str, checkpoint: str) -> None:
    def write(batch: DataFrame, batch_id: int) -> None:
        # A repeated batch overwrites its own folder, so a restart leaves no row twice.
        batch.write.mode("overwrite").parquet(f"{target}/{_VERSION}={batch_id}")

    query = (
        updates.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def running_spin_sums(
    results: DataFrame, target: str, checkpoint: str, *, perturbed_by: str = "depth", converged_only: bool = False
) -> None:
    """Keeps spin sums per (run, job, channel); each batch writes the sums it changed.

    Rows that arrive again are added again, as in the batch form; see :func:`running_spins`.
    """
    selected = select_results(results, perturbed_by=perturbed_by, converged_only=converged_only)
    _write_updates(spin_sums(selected), target, checkpoint)


def running_spins(results: DataFrame, target: str, checkpoint: str) -> None:
    """Keeps one row per (run, job, channel, spin), so rows that arrive again change nothing."""
    _write_updates(drop_repeats(results), target, checkpoint)


def latest(
    spark: SparkSession, target: str, keys: tuple[str, ...] = SUM_KEYS, snapshots: str | None = None
) -> DataFrame:
    """Current state of a running table: the newest version of every key.

    With ``snapshots`` (see :func:`take_snapshot`) only batches after the last snapshot are read.
    """
    versions = spark.read.parquet(target)
    values = [c for c in versions.columns if c not in (*keys, _VERSION)]
    if snapshots is not None:
        taken = spark.read.parquet(snapshots)
        upto = taken.agg(F.max(_UPTO)).first()[0]
        base = taken.filter(F.col(_UPTO) == upto).withColumnRenamed(_UPTO, _VERSION)
        versions = versions.filter(F.col(_VERSION) > upto).unionByName(base)
    newest = F.max_by(F.struct(*values), _VERSION).alias("_v")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def take_snapshot(
    spark: SparkSession, target: str, snapshots: str, keys: tuple[str, ...] = SUM_KEYS, *, first: bool = False
) -> int:
    """Writes the state of a running table as of its last batch; returns that batch's number.

    Versions pile up with every batch. After a snapshot, earlier ones are no longer read and their
    folders may be archived. Pass ``first`` while there is no snapshot yet.
    """
    last = spark.read.parquet(target).agg(F.max(_VERSION)).first()[0]
    state = latest(spark, target, keys, None if first else snapshots)
    state.write.mode("overwrite").parquet(f"{snapshots}/{_UPTO}={last}")
    return last


def running_rows(
    spark: SparkSession,
    target: str,
    job: str,
    step: float | DataFrame,
    snapshots: str | None = None,
    *,
    deduped: bool = False,
    perturbed_by: str = "depth",
    converged_only: bool = False,
    alpha_includes_u: bool = True,
    signed_u: bool = False,
) -> DataFrame:
    """Response rows of a running table as it stands; feed them to the views for running means.

    ``target`` holds spin sums, or with ``deduped`` the rows of :func:`running_spins`, whose selection
    is then made here.
    """
    if deduped:
        rows = latest(spark, target, SPIN_KEYS, snapshots)
        sums = spin_sums(select_results(rows, perturbed_by=perturbed_by, converged_only=converged_only))
    else:
        sums = latest(spark, target, snapshots=snapshots)
    return slopes(differences(sums, job, signed_u=signed_u), job, step, alpha_includes_u=alpha_includes_u)
