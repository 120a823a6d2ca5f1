"""Chart-ready series of mean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scfsweep.operators.views import MEAN_KEYS

# Names the series carry in a legend.
SERIES_NAMES = {"n1_nf_u": "n1-nF_U", "n1_nf_alpha": "n1-nF_Alpha"}


def series_long(means: DataFrame) -> DataFrame:
    """(run_id, channel_id, series, u, y): one row per point, at any size."""
    columns = [c for c in SERIES_NAMES if c in means.columns]
    points = F.array(
        *[F.struct(F.lit(SERIES_NAMES[c]).alias("series"), F.col(c).alias("y")) for c in columns]
    )
    return means.select(*MEAN_KEYS, F.explode(points).alias("_p")).select(
        "run_id", "channel_id", "_p.series", "u", "_p.y"
    )


def series_arrays(means: DataFrame, *, drop_missing: bool = False) -> DataFrame:
    """(run_id, channel_id, series, xs, ys): u as text and its values, sorted by u.

    One array per chart line; means hold one row per distinct u of a channel, which bounds it.
    ``drop_missing`` leaves NULL values out of ``ys`` only, so both arrays may then differ in length.
    """
    points = F.array_sort(F.collect_list(F.struct("u", "y")))
    ys = F.transform("_points", lambda p: p["y"])
    if drop_missing:
        ys = F.filter(ys, lambda y: y.isNotNull())
    return (
        series_long(means)
        .groupBy("run_id", "channel_id", "series")
        .agg(points.alias("_points"))
        .select(
            "run_id",
            "channel_id",
            "series",
            F.transform("_points", lambda p: p["u"].cast("string")).alias("xs"),
            ys.alias("ys"),
        )
    )
