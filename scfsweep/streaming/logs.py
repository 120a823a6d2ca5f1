"""Occupations picked while logs grow.

A log arrives in pieces. Every micro-batch reduces its lines where they are read and adds what stays, three
lines per series and task at most, to a running table under the batch's number; a batch that is repeated
after a failure overwrites its own folder. The picks of all logs so far come from those few rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.operators.logs import picked, survivors
from scfsweep.sources.logs import tag_lines
from scfsweep.sources.paths import file_path

_BATCH = "batch_id"
_UPTO = "upto"


def read_log_stream(
    spark: SparkSession, path: str, *, pattern: str = "*", piece: str = r"\.(\d+)$", files_per_batch: int = 1000
) -> DataFrame:
    """Lines of arriving pieces as (file, block, split, line).

    A piece is named after its log and a number that ``piece`` finds; without one it is the whole log.
    Pieces may arrive in any order, as lines are placed by piece, split and line.
    """
    raw = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).text(path)
    number = F.coalesce(F.nullif(F.regexp_extract(file_path(), piece, 1), F.lit("")).cast("long"), F.lit(0))
    return raw.select(
        F.regexp_replace(file_path(), piece, "").alias("file"),
        number.alias("block"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").alias("line"),
    )


def running_log_picks(lines: DataFrame, target: str, checkpoint: str) -> None:
    """Takes the lines that have arrived and ends; run it again to go on from its checkpoint.

    Lines that bear no ``row`` of their own get one from the place in their split, which only a batch knows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if "row" not in batch.columns:
            batch = batch.withColumn("row", F.struct("split", F.monotonically_increasing_id().alias("line")))
        survivors(tag_lines(batch)).write.mode("overwrite").parquet(f"{target}/{_BATCH}={batch_id}")

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _kept(spark: SparkSession, target: str, snapshots: str | None) -> DataFrame:
    rows = spark.read.parquet(target)
    if snapshots is None:
        return rows.drop(_BATCH)
    taken = spark.read.parquet(snapshots)
    upto = taken.agg(F.max(_UPTO)).first()[0]
    base = taken.filter(F.col(_UPTO) == upto).drop(_UPTO)
    return rows.filter(F.col(_BATCH) > upto).drop(_BATCH).unionByName(base)


def log_picks_so_far(spark: SparkSession, target: str, snapshots: str | None = None) -> DataFrame:
    """What :func:`pick_observations` gives for the lines so far; a log without its finish line is not converged."""
    return picked(_kept(spark, target, snapshots))


def snapshot_log_picks(spark: SparkSession, target: str, snapshots: str, *, first: bool = False) -> int:
    """Reduces all batches to one set of survivors; later reads start there. Pass ``first`` while there is none."""
    last = spark.read.parquet(target).agg(F.max(_BATCH)).first()[0]
    # rows of one log come together, so that each of its series is reduced to three
    merged = survivors(_kept(spark, target, None if first else snapshots).repartition("file"))
    merged.write.mode("overwrite").parquet(f"{snapshots}/{_UPTO}={last}")
    return last
