"""Which U run goes with which alpha run, judged by their folder names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scfsweep.schema import check_job
from scfsweep.sources.folders import parse_folders

# Runs may be analysed together when these agree ...
RANGE_KEYS = ["seed", "init_u", "step_u", "final_u"]
PAIR_KEYS = [*RANGE_KEYS, "pert_step"]
# ... and these tell equal candidates apart.
TIE_KEYS = ["pert_init", "pert_final", "times"]


def _side(parsed: DataFrame, job: str) -> DataFrame:
    return parsed.filter(F.col("valid") & (F.col("job") == job))


def pair_runs(parsed: DataFrame) -> DataFrame:
    """One row per U run that has a compatible alpha run: pair keys, u_folder, alpha_folder.

    An alpha run that agrees in every setting is preferred, else the first compatible one by
    settings and name. Alpha runs are reduced to one per key before the join, so a seed with very
    many folders yields one row per U folder and never every combination.
    """
    alpha = _side(parsed, "alpha")
    equal = alpha.groupBy(*PAIR_KEYS, *TIE_KEYS).agg(F.min("folder").alias("equal_folder"))
    compatible = alpha.groupBy(*PAIR_KEYS).agg(
        F.min(F.struct(*TIE_KEYS, "folder"))["folder"].alias("other_folder")
    )
    return (
        _side(parsed, "u")
        .withColumnRenamed("folder", "u_folder")
        .join(compatible, PAIR_KEYS)
        .join(equal, [*PAIR_KEYS, *TIE_KEYS], "left")
        .select(
            *PAIR_KEYS,
            "u_folder",
            F.coalesce("equal_folder", "other_folder").alias("alpha_folder"),
        )
    )


def unpaired_runs(parsed: DataFrame) -> DataFrame:
    """U runs :func:`pair_runs` leaves out, with the first setting no alpha run of the seed shares."""
    alpha = _side(parsed, "alpha")
    seeds = alpha.select("seed").distinct().withColumn("_seed", F.lit(True))
    ranges = alpha.select(*RANGE_KEYS).distinct().withColumn("_range", F.lit(True))
    reason = (
        F.when(F.col("_seed").isNull(), F.lit("no alpha run"))
        .when(F.col("_range").isNull(), F.lit("U range differs"))
        .otherwise(F.lit("perturbation step differs"))
    )
    return (
        _side(parsed, "u")
        .join(alpha.select(*PAIR_KEYS).distinct(), PAIR_KEYS, "left_anti")
        .join(seeds, "seed", "left")
        .join(ranges, RANGE_KEYS, "left")
        .select(F.col("folder").alias("u_folder"), "seed", reason.alias("reason"))
    )


def unpaired_alpha_runs(parsed: DataFrame) -> DataFrame:
    """Alpha runs that :func:`pair_runs` gives to no U run: no U run fits, or another one was taken."""
    taken = pair_runs(parsed).select(F.col("alpha_folder").alias("folder")).distinct().withColumn("_taken", F.lit(True))
    fitting = _side(parsed, "u").select(*PAIR_KEYS).distinct().withColumn("_fits", F.lit(True))
    rows = _side(parsed, "alpha").join(taken, "folder", "left").join(fitting, PAIR_KEYS, "left")
    reason = F.when(F.col("_fits").isNull(), F.lit("no U run fits")).otherwise(F.lit("another one was taken"))
    return rows.filter(F.col("_taken").isNull()).select(F.col("folder").alias("alpha_folder"), "seed", reason.alias("reason"))


def relabelled(results: DataFrame, pairs: DataFrame, job: str) -> DataFrame:
    """Results of one job's folders under the run id of their pair, which is the U folder.

    An alpha folder that serves several U folders is read for each of them.
    """
    names = pairs.select(F.col(f"{check_job(job)}_folder").alias("_folder"), F.col("u_folder").alias("_pair"))
    rest = [c for c in results.columns if c != "run_id"]
    return results.join(names, results["run_id"] == names["_folder"]).select(F.col("_pair").alias("run_id"), *rest)


def increments(pairs: DataFrame) -> DataFrame:
    """(run_id, step): every pair's own perturbation increment."""
    return pairs.select(F.col("u_folder").alias("run_id"), F.col("pert_step").cast("double").alias("step"))


def check_pairs(requests: DataFrame) -> DataFrame:
    """Judges given (u_folder, alpha_folder) rows by name alone: ``reason`` is NULL for a fit.

    Row by row, with no join; the seed is not compared, as the two folders were named on purpose.
    """
    kept = ["valid", "job", *RANGE_KEYS[1:], "pert_step"]
    rows = requests.select("u_folder", "alpha_folder")
    for side in ("u", "alpha"):
        parsed = parse_folders(rows, f"{side}_folder")
        rows = parsed.select(
            *rows.columns, *[F.col(c).alias(f"_{side}_{c}") for c in kept]
        )

    def differs(name: str):
        return ~F.col(f"_u_{name}").eqNullSafe(F.col(f"_alpha_{name}"))

    named_wrong = ~(F.col("_u_valid") & F.col("_alpha_valid")) | (F.col("_u_job") != "u") | (
        F.col("_alpha_job") != "alpha"
    )
    range_differs = differs("init_u") | differs("step_u") | differs("final_u")
    reason = (
        F.when(named_wrong, F.lit("unreadable name"))
        .when(range_differs, F.lit("U range differs"))
        .when(differs("pert_step"), F.lit("perturbation step differs"))
    )
    return rows.select("u_folder", "alpha_folder", reason.alias("reason"))
