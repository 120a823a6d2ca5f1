"""Per-channel views of a response table. The channel stays a column: one job serves all channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scfsweep.functions.exact import exact_mean
from scfsweep.schema import check_job, perturbation_column, response_column

MEAN_KEYS = ("run_id", "channel_id", "u")


def with_channel(rows: DataFrame) -> DataFrame:
    """Rows that belong to a channel. A blank channel id shows in the total view only."""
    return rows.filter(F.col("channel_id").isNotNull())


def channel_view(rows: DataFrame, job: str, channel_id: int | None = None) -> DataFrame:
    """(run_id, channel_id, u, {job}_pert, n1_nf_{job}) of all channels, or of one."""
    of_channel = with_channel(rows) if channel_id is None else rows.filter(F.col("channel_id") == channel_id)
    return of_channel.select(
        *MEAN_KEYS,
        F.col("pert").alias(perturbation_column(job)),
        F.col("n1_nf").alias(response_column(job)),
    )


def alpha_columns(view: DataFrame) -> DataFrame:
    """The columns an alpha channel view lends to a merge; applying it twice changes nothing."""
    keys = [c for c in ("run_id", "channel_id") if c in view.columns]
    return view.select(*keys, perturbation_column("alpha"), response_column("alpha"))


def channels(rows: DataFrame) -> DataFrame:
    """Channels of every run. Selected result rows will do, which spares the spin sums."""
    return with_channel(rows).select("run_id", "channel_id").distinct()


def mean_view(rows: DataFrame, job: str) -> DataFrame:
    """Mean response per (run, channel, u) of one job, the same to the last bit in every run."""
    mean = exact_mean(F.col("n1_nf")).alias(response_column(check_job(job)))
    return with_channel(rows).groupBy(*MEAN_KEYS).agg(mean)
