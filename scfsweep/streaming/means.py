"""Means kept up to date by differences: what changes is taken out and put back, nothing else is read again.

A stateful operator holds the spin sums of every (run, job, channel), those of a cell of jobs together. A micro-batch that adds rows to a job
turns its old sums into new ones; the old response leaves the mean of its (run, channel, u) and the new one
enters it. Both are whole numbers (:mod:`scfsweep.functions.exact`), so taking out is exact, and the means
equal those of a batch run over all rows to the last bit. Infinite and NaN responses are counted beside them.

Every batch writes one row for each mean it changes, under its number, so a batch repeated after a failure
overwrites its own rows. State grows with the number of jobs, as results have no event time to expire by.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scfsweep.functions.exact import LARGE, coarse, fine, joined
from scfsweep.operators.response import SUM_KEYS, select_results, sum_responses
from scfsweep.operators.views import MEAN_KEYS, with_channel
from scfsweep.schema import check_job, response_column

_SUMS = ("s0", "s1", "sf")
_VALUES = ("before_scf", "first_scf", "last_scf")
_CHANGED = "run_id string, jobname string, channel_id int, known boolean, " + ", ".join(f"{when}_{s} double" for when in ("old", "new") for s in _SUMS)
_BATCH = "batch_id"
_UPTO = "upto"
#: Cells of jobs, whose state is one value each
CELLS = 1 << 11


def _add(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The sums of a cell's jobs before and after the batch; NULL counts as nothing."""
    known = {}
    if state.exists:
        *jobs, s0, s1, sf = state.get
        known = dict(zip(zip(*jobs), zip(s0, s1, sf)))
    added = {}
    for part in rows:
        names = [part[c].astype(object).where(part[c].notna(), None).tolist() for c in SUM_KEYS]
        # a channel beside a NULL comes as a double
        names[2] = [None if c is None else int(c) for c in names[2]]
        for job, values in zip(zip(*names), zip(*(part[c].fillna(0.0).tolist() for c in _VALUES))):
            sums = added.setdefault(job, [0.0, 0.0, 0.0])
            for i, value in enumerate(values):
                sums[i] += value
    nothing = (0.0, 0.0, 0.0)
    changed = [(*job, job in known, *known.get(job, nothing), *(t + s for t, s in zip(known.get(job, nothing), sums))) for job, sums in added.items()]
    known.update((row[:3], row[-3:]) for row in changed)
    state.update((*map(list, zip(*known)), *map(list, zip(*known.values()))))
    names = [f"{when}_{s}" for when in ("old", "new") for s in _SUMS]
    yield pd.DataFrame(changed, columns=[*SUM_KEYS, "known", *names]).astype({"channel_id": "Int32"})


def changed_sums(selected: DataFrame, cells: int = CELLS) -> DataFrame:
    """Stream of (run_id, jobname, channel_id, known, old and new sums), one row per job a batch adds rows to.

    Jobs are dealt to ``cells`` cells by their hash, and a cell's jobs share a state: a batch calls Python
    once for a cell it changes and not for each job. A cell's state grows with the number of jobs. The
    number of cells belongs to the checkpoint.
    """
    state = "run_id array<string>, jobname array<string>, channel_id array<int>, " + ", ".join(f"{s} array<double>" for s in _SUMS)
    dealt = selected.withColumn("_cell", F.pmod(F.xxhash64(*SUM_KEYS), F.lit(cells)))
    return dealt.groupBy("_cell").applyInPandasWithState(_add, _CHANGED, state, "update", GroupStateTimeout.NoTimeout)


def _differences(changed: DataFrame, job: str, step: float | DataFrame, **options) -> DataFrame:
    """What a batch adds to the sums and counts of every mean it changes. Reads ``changed`` once."""
    sides = F.array(
        *[
            F.struct(F.lit(sign).alias("sign"), (F.col("known") | F.lit(sign > 0)).alias("there"), *[F.col(f"{when}_{s}").alias(s) for s in _SUMS])
            for sign, when in ((1, "new"), (-1, "old"))
        ]
    )
    # a job name that bears its sign goes through the response unharmed, as only its parts are read
    sums = changed.select(*SUM_KEYS, F.explode(sides).alias("x")).filter("x.there").select("run_id", F.concat_ws("|", "x.sign", "jobname").alias("jobname"), "channel_id", *[f"x.{s}" for s in _SUMS])
    rows = with_channel(sum_responses(sums, job, step, **options))
    sign = F.substring_index("jobname", "|", 1).cast("int")
    value = F.col("n1_nf")
    infinite = F.abs(value) == float("inf")
    wide = F.when(~F.isnan(value) & ~infinite & (F.abs(value) >= LARGE), value)
    return rows.groupBy(*MEAN_KEYS).agg(
        F.sum(sign * coarse(value)).alias("coarse"),
        F.sum(sign * fine(value)).alias("fine"),
        F.sum(sign * wide).alias("wide"),
        *[F.sum(F.when(test, sign)).alias(name) for name, test in (("n", value.isNotNull()), ("n_nan", F.isnan(value)), ("n_up", value == float("inf")), ("n_down", value == float("-inf")))],
    )


def running_mean_differences(
    results: DataFrame,
    job: str,
    step: float | DataFrame,
    target: str,
    checkpoint: str,
    *,
    perturbed_by: str = "depth",
    converged_only: bool = False,
    **options,
) -> None:
    """Takes the result rows that have arrived and ends; run it again to go on from its checkpoint.

    ``options`` are ``alpha_includes_u`` and ``signed_u``. They, the job and the step belong to the target:
    start a new one to change them.
    """
    check_job(job)
    selected = select_results(results, perturbed_by=perturbed_by, converged_only=converged_only)

    def write(batch: DataFrame, batch_id: int) -> None:
        _differences(batch, job, step, **options).write.mode("overwrite").parquet(f"{target}/{_BATCH}={batch_id}")

    query = (
        changed_sums(selected)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _totals(spark: SparkSession, target: str, snapshots: str | None) -> DataFrame:
    rows = spark.read.parquet(target)
    if snapshots is not None:
        taken = spark.read.parquet(snapshots)
        upto = taken.agg(F.max(_UPTO)).first()[0]
        rows = rows.filter(F.col(_BATCH) > upto).unionByName(taken.filter(F.col(_UPTO) == upto).withColumnRenamed(_UPTO, _BATCH))
    values = [c for c in rows.columns if c not in (*MEAN_KEYS, _BATCH)]
    return rows.groupBy(*MEAN_KEYS).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in values])


def means_so_far(spark: SparkSession, target: str, job: str, snapshots: str | None = None) -> DataFrame:
    """(run_id, channel_id, u, n1_nf_{job}) of all rows so far; reads one row per changed mean and batch."""
    nan, up, down = (F.col(f"n_{x}") > 0 for x in ("nan", "up", "down"))
    infinity = F.lit(float("inf"))
    special = F.when(nan | (up & down), F.lit(float("nan"))).when(up, infinity).when(down, -infinity)
    mean = F.when(F.col("n") > 0, F.coalesce(special, joined(F.col("coarse"), F.col("fine"), F.col("wide")) / F.col("n")))
    return _totals(spark, target, snapshots).select(*MEAN_KEYS, mean.alias(response_column(job)))


def snapshot_means(spark: SparkSession, target: str, snapshots: str, *, first: bool = False) -> int:
    """Adds all batches up to one row per mean; later reads start there. Pass ``first`` while there is none."""
    last = spark.read.parquet(target).agg(F.max(_BATCH)).first()[0]
    _totals(spark, target, None if first else snapshots).write.mode("overwrite").parquet(f"{snapshots}/{_UPTO}={last}")
    return last
