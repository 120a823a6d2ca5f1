"""Results stored by run, so that summing, merging and averaging them moves no row.

Both jobs lie in one table, bucketed by run. Every key of an analysis holds the run, so spin sums, the merge
by key and the means all find their rows together and the plan has no exchange. Store results this way when
they are analysed more often than written. A run that holds a large share of all rows makes one large bucket,
which adaptive execution can't split: bucket by more columns then (``("run_id", "channel_id")`` serves as well,
as every key of the merge by key holds the channel, too).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scfsweep.operators.merge import merge_jobs_by_key, merged_mean
from scfsweep.operators.response import both_responses

RUN = ("run_id",)


def store_by_run(results: DataFrame, name: str, buckets: int, columns: tuple[str, ...] = RUN) -> None:
    """Writes result rows of both jobs as table ``name``, one file per bucket."""
    dealt = results.repartition(buckets, *columns)
    dealt.write.mode("overwrite").bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(name)


def stored_means(spark: SparkSession, name: str, u_step: float, alpha_step: float, **options) -> DataFrame:
    """Means of both responses of a table of :func:`store_by_run`, merged by key, without an exchange."""
    rows = both_responses(spark.table(name), {"u": u_step, "alpha": alpha_step}, **options)
    return merged_mean(merge_jobs_by_key(rows))
