"""Bringing the responses of a run's two jobs together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scfsweep.functions import job_folder, seed_of
from scfsweep.functions.exact import exact_mean
from scfsweep.operators.numbering import number_in_block, rows_before
from scfsweep.operators.views import MEAN_KEYS, channels, with_channel
from scfsweep.schema import perturbation_column, response_column

# 2**BLOCK_BITS steps share a numbering block in merge_by_position, which bounds what one task sorts.
BLOCK_BITS = 10
CHANNEL = ["run_id", "job", "channel_id"]
JOB_KEYS = ["run_id", "channel_id", "u", "k", "seed"]
BLOCK = ["_u", "_block"]


def _written_u(jobname: Column) -> Column:
    """U as the job's own folder spells it, which is the folder's second part."""
    return F.substring_index(F.substring_index(job_folder(jobname), "_", 2), "_", -1)


def channel_pairs(rows_u: DataFrame, rows_alpha: DataFrame) -> DataFrame:
    """The i-th U channel of a run beside its i-th alpha channel; the longer list is cut.

    Ranks are taken over the distinct channels of a run, never over its rows.
    """
    by_channel = Window.partitionBy("run_id").orderBy("channel_id")
    ranked = [
        channels(rows).select(
            "run_id",
            F.col("channel_id").alias(f"channel_{side}"),
            F.dense_rank().over(by_channel).alias("pair"),
        )
        for side, rows in (("u", rows_u), ("alpha", rows_alpha))
    ]
    return ranked[0].join(ranked[1], ["run_id", "pair"]).select("run_id", "pair", "channel_u", "channel_alpha")


def cut_channels(rows_u: DataFrame, rows_alpha: DataFrame) -> DataFrame:
    """(run_id, job, channel_id) that have no partner in :func:`channel_pairs` and so no merged row."""
    pairs = channel_pairs(rows_u, rows_alpha)
    cut = [
        channels(rows)
        .join(pairs.select("run_id", F.col(f"channel_{job}").alias("channel_id")), ["run_id", "channel_id"], "left_anti")
        .select("run_id", F.lit(job).alias("job"), "channel_id")
        for job, rows in (("u", rows_u), ("alpha", rows_alpha))
    ]
    return cut[0].unionByName(cut[1])


def _before_all(rows: DataFrame) -> Column:
    """A value below every u: whole numbers in job names carry no sign, signed ones are doubles."""
    return F.lit(-1) if dict(rows.dtypes)["u"] == "int" else F.lit(float("-inf"))


def _both(rows_u: DataFrame, rows_alpha: DataFrame) -> DataFrame:
    """Rows of both jobs with their numbering block (NULL u and k come first in order).

    The filter states what the join on these keys implies anyway. Stated here, it stands in both
    readings of the inputs and keeps their shuffles identical; see :func:`_block_offsets`.
    """
    seen = "seen" in rows_u.columns and "seen" in rows_alpha.columns

    def place(rows: DataFrame) -> tuple[Column, Column]:
        # as first seen, where that was kept: by the file's split, then by line
        if seen:
            return F.col("seen.block"), F.col("seen.row")
        return F.coalesce(F.col("u"), _before_all(rows)), F.coalesce(F.col("k"), F.lit(-1))

    sides = [
        rows.select(
            F.lit(job).alias("job"),
            "run_id",
            "channel_id",
            "jobname",
            "u",
            place(rows)[0].alias("_u"),
            place(rows)[1].alias("_k"),
            F.shiftright(place(rows)[1], BLOCK_BITS).alias("_block"),
            "pert",
            "n1_nf",
        )
        for job, rows in (("u", rows_u), ("alpha", rows_alpha))
    ]
    placed = F.col("run_id").isNotNull() & F.col("channel_id").isNotNull()
    return sides[0].unionByName(sides[1]).filter(placed)


def _block_offsets(both: DataFrame) -> DataFrame:
    """Per numbering block: rows of its channel that come earlier, and the paired U channel.

    Windows here run over counted blocks (one row per U value and 1,024 steps), not over data rows.
    Rows with and without a response are counted apart because that asks for the same columns as the
    rows themselves: Spark then reuses the shuffle of the spin sums and does not scan twice.
    """
    rows = F.count("n1_nf") + F.count_if(F.col("n1_nf").isNull())
    blocks = both.groupBy(*CHANNEL, *BLOCK).agg(rows.alias("n"))
    of_run = Window.partitionBy("run_id")
    of_job = Window.partitionBy("run_id", "job").orderBy("channel_id")
    ranked = blocks.withColumn("offset", rows_before(CHANNEL, BLOCK)).withColumn(
        "pair", F.dense_rank().over(of_job)
    )
    channels_of = {job: F.max(F.when(F.col("job") == job, F.col("pair"))).over(of_run) for job in ("u", "alpha")}
    paired = ranked.withColumn("_n_u", channels_of["u"]).withColumn("_n_alpha", channels_of["alpha"])
    return (
        paired.filter((F.col("pair") <= F.col("_n_u")) & (F.col("pair") <= F.col("_n_alpha")))
        .withColumn(
            "channel_u",
            F.max(F.when(F.col("job") == "u", F.col("channel_id"))).over(Window.partitionBy("run_id", "pair")),
        )
        .select(*CHANNEL, *BLOCK, "offset", "channel_u")
    )


def merge_by_position(rows_u: DataFrame, rows_alpha: DataFrame) -> DataFrame:
    """n-th U row of a channel beside the n-th row of its alpha partner; the shorter side is NULL.

    Rows count in (u, step, job name) order, or as first seen in the files if both sides kept that
    (``keep_order``), and carry the U channel's id. Pairing follows position
    alone, so with unequal sweeps alpha responses land beside another U value and surplus alpha rows
    have no ``u``; :func:`merge_by_key` avoids both.

    A row's position is the offset of its block plus its number inside the block, so no task ever
    sorts a whole channel: a block holds 1,024 steps of one U value, times the seeds in the run.
    Counting the blocks reads the spin sums' shuffle a second time, not the files.
    """
    both = _both(rows_u, rows_alpha)
    # Numbered before the join, so that the rows' sort by block serves both.
    numbered = both.withColumn("_nth", number_in_block(CHANNEL, BLOCK, ["_k", "jobname"]))
    placed = numbered.join(_block_offsets(both), [*CHANNEL, *BLOCK]).withColumn(
        "position", F.col("offset") + F.col("_nth")
    )

    # Each side has at most one row per position, so an aggregate does what a full outer join would,
    # with one exchange and no sort.
    def of(job: str, column: str) -> Column:
        return F.max(F.when(F.col("job") == job, F.col(column)))

    return (
        placed.groupBy("run_id", F.col("channel_u").alias("channel_id"), "position")
        .agg(
            of("u", "u").alias("u"),
            of("u", "pert").alias(perturbation_column("u")),
            of("u", "n1_nf").alias(response_column("u")),
            of("alpha", "pert").alias(perturbation_column("alpha")),
            of("alpha", "n1_nf").alias(response_column("alpha")),
        )
    )


def merge_by_key(rows_u: DataFrame, rows_alpha: DataFrame) -> DataFrame:
    """Rows of equal (run, channel, U as written, step, seed) side by side; unmatched rows of both sides stay.

    Equals :func:`merge_by_position` when both sweeps are complete, and needs no ordering at all. Both
    sides are one union that is summed up per key, so nothing can fan out: U_0.5 and U_0.25 stay apart
    although both read as u = 0, and a job that stands in the rows twice, in two spellings, is one row
    (of differing responses the larger). :func:`repeated_responses` lists what such rows held.
    """
    columns = ["run_id", "channel_id", "u", "k", "jobname", "pert", "n1_nf"]
    sides = [rows.select(*columns, F.lit(job).alias("job")) for job, rows in (("u", rows_u), ("alpha", rows_alpha))]
    return merge_jobs_by_key(sides[0].unionByName(sides[1]))


def merge_jobs_by_key(rows: DataFrame) -> DataFrame:
    """:func:`merge_by_key` of rows of both jobs, told apart by ``job``."""
    keys = [*JOB_KEYS, "_written"]
    named = with_channel(rows).withColumn("seed", seed_of(F.col("jobname"))).withColumn("_written", _written_u(F.col("jobname")))

    def of(job: str, column: str) -> Column:
        return F.max(F.when(F.col("job") == job, F.col(column)))

    merged = named.filter(F.col("run_id").isNotNull()).groupBy(*keys)
    columns = [of(job, c).alias(name) for job in ("u", "alpha") for c, name in (("pert", perturbation_column(job)), ("n1_nf", response_column(job)))]
    return merged.agg(*columns).drop("_written")


def repeated_responses(rows: DataFrame) -> DataFrame:
    """Every response of the jobs that :func:`merge_by_key` takes for one: (JOB_KEYS, jobname, pert, n1_nf, spellings).

    A job found under several names, such as the name a result table gives it and the one re-read from
    its log, has a response for each. Names are counted first, so only the jobs concerned are joined.
    """
    named = with_channel(rows).withColumn("seed", seed_of(F.col("jobname"))).withColumn("_written", _written_u(F.col("jobname")))
    keys = [*JOB_KEYS, "_written"]
    several = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("spellings")).filter("spellings > 1")
    other = several.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "spellings")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return named.join(other, same).select(*JOB_KEYS, "jobname", "pert", "n1_nf", "spellings")


def merged_mean(merged: DataFrame) -> DataFrame:
    """Mean of both responses per (run, channel, u) of merged rows, the same to the last bit in every run."""
    return merged.groupBy(*MEAN_KEYS).agg(
        *[exact_mean(F.col(response_column(job))).alias(response_column(job)) for job in ("u", "alpha")]
    )
