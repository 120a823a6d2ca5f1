"""Changes to calculation settings, on the long table (file, pos, key, value, value_num)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scfsweep.functions import scientific_text
from scfsweep.sources.inputs import number_or_null

# Settings a base job drops, and the grid it runs on.
DROPPED_KEYS = ("continuation", "fine_grid_scale")
BASE_GRID_SCALE = "1.750000000000000"
ENERGY_TOL_KEY = "elec_energy_tol"


def _key() -> Column:
    return F.lower(F.col("key"))


def set_values(settings: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Settings with the values of some keys replaced."""
    value = F.col("value")
    for key, new in values.items():
        value = F.when(_key() == key, new).otherwise(value)
    return settings.withColumn("value", value).withColumn("value_num", number_or_null(F.col("value")))


def with_missing(settings: DataFrame, values: dict[str, str]) -> DataFrame:
    """Settings, and after each file's last line those of ``values`` whose keys it lacks, in their order.

    A file must hold one setting at least to be known here.
    """
    rest = [c for c in settings.columns if c not in ("pos", "key", "value", "value_num")]
    of_file = settings.groupBy(*rest).agg(F.collect_set(_key()).alias("_keys"), F.max("pos").alias("_last"))
    offered = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in values.items()])
    lacking = F.filter(offered, lambda s: ~F.array_contains(F.col("_keys"), s["key"]))
    added = of_file.select(*rest, "_last", F.posexplode(lacking).alias("_i", "_s")).select(
        *rest,
        (F.col("_last") + F.col("_i") + 1).alias("pos"),
        F.col("_s.key").alias("key"),
        F.col("_s.value").alias("value"),
        number_or_null(F.col("_s.value")).alias("value_num"),
    )
    return settings.unionByName(added)


def settings_before(settings: DataFrame, energy_tol: str, *, add_missing: bool = False) -> DataFrame:
    """Settings of a base job: two keys dropped, tolerance and grid set.

    Only settings that the file has are set, unless ``add_missing`` also writes absent ones.
    """
    new = {ENERGY_TOL_KEY: energy_tol, "grid_scale": BASE_GRID_SCALE}
    kept = set_values(settings.filter(~_key().isin(*DROPPED_KEYS)), {k: F.lit(v) for k, v in new.items()})
    return with_missing(kept, new) if add_missing else kept


def settings_perturbed(before: DataFrame) -> DataFrame:
    """Settings of a perturbed job: a tenth of the tolerance, and continuation right after the task.

    The added row comes out of the task's own row, so nothing is joined or read again.
    """
    tenth = scientific_text(F.col("value_num") / 10.0)
    rows = set_values(before, {ENERGY_TOL_KEY: tenth})
    fields = [F.col(c) for c in ("pos", "key", "value", "value_num")]
    own = F.struct(*fields)
    added = F.struct(
        F.col("pos").alias("pos"),
        F.lit("continuation").alias("key"),
        F.lit("default").alias("value"),
        F.lit(None).cast("double").alias("value_num"),
    )
    rest = [c for c in rows.columns if c not in ("pos", "key", "value", "value_num")]
    both = F.when(_key() == "task", F.array(own, added)).otherwise(F.array(own))
    return rows.select(*rest, F.explode(both).alias("_row")).select(*rest, "_row.*")
