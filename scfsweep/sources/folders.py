"""Run parameters read from folder names, e.g. ``SEED_u_0_2_12_0.05_0.05_0.25_STEPS_5``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.functions import is_number_text, normalise_job
from scfsweep.sources.paths import one_folder, roots_of, run_key

# Places in the folder name, counted from its end.
_PLACES = {
    "times": 0,
    "pert_final": 2,
    "pert_step": 3,
    "pert_init": 4,
    "final_u": 5,
    "step_u": 6,
    "init_u": 7,
    "job": 8,
}
MAX_TIMES = 1_000_000
_REQUIRED = ("job", "init_u", "step_u", "final_u", "times")


def run_folders(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Folders below ``root`` that hold a final result table, keyed as in :func:`read_run_results`."""
    files = spark.read.option("pathGlobFilter", "result_*_final.csv").format("binaryFile")
    # Only metadata is selected, so no file is opened.
    found = files.load([f"{r}/*" for r in roots_of(root)])
    return found.select(run_key(one_folder(root), 1, "path").alias("folder")).distinct()


def _number(text: Column) -> Column:
    return F.when(is_number_text(text), text.try_cast("double"))


def parse_folders(folders: DataFrame, column: str = "folder") -> DataFrame:
    """Adds seed, job, U range, perturbation range, times, ``valid`` and the ``missing`` parts.

    A number of perturbations beyond 0..MAX_TIMES counts as missing, and so does a U step that leads
    nowhere or makes more than MAX_TIMES values.
    """
    parts = F.reverse(F.split(F.col(column), "_"))
    raw = {name: F.get(parts, F.lit(place)) for name, place in _PLACES.items()}
    values = {
        name: _number(text).alias(name) for name, text in raw.items() if name not in ("job", "times")
    }
    count = F.when(raw["times"].rlike(r"^[+-]?[0-9]+$"), raw["times"].try_cast("bigint"))
    seed = F.array_join(F.reverse(F.slice(parts, 10, F.greatest(F.size(parts) - 9, F.lit(0)))), "_")
    parsed = folders.select(
        "*",
        F.nullif(seed, F.lit("")).alias("seed"),
        normalise_job(raw["job"]).alias("job"),
        values["init_u"],
        values["step_u"],
        values["final_u"],
        values["pert_init"],
        values["pert_step"],
        values["pert_final"],
        count.alias("times"),
    )
    members = F.coalesce(F.try_divide(F.col("final_u") - F.col("init_u"), F.col("step_u")), F.lit(-1.0))
    ranged = F.col("init_u").isNotNull() & F.col("step_u").isNotNull() & F.col("final_u").isNotNull()
    odd = {"times": ~F.col("times").between(0, MAX_TIMES), "step_u": ranged & ((members < 0) | (members >= MAX_TIMES))}
    lacking = F.array_compact(
        F.array(
            *[
                F.when(F.col(name).isNull() | F.coalesce(odd.get(name, F.lit(False)), F.lit(False)), F.lit(name))
                for name in _REQUIRED
            ]
        )
    )
    return parsed.withColumn("missing", F.array_join(lacking, ",")).withColumn(
        "valid", F.col("missing") == ""
    )
