"""First, second and last occupation per (log, species, spin), and whether the run finished."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scfsweep.functions import file_stem
from scfsweep.operators.numbering import number_in_block, rows_before

SERIES = ["file", "species", "spin"]
# Lines a task gathers before it reduces them again.
REDUCE_ROWS = 100_000
PERTURBED_LOG_PATTERN = r"/U_-?\d+(?:\.\d+)?_(?:u|alpha)/U_-?\d+(?:\.\d+)?_(?:u|alpha)_\d+/[^/]+$"


def observations(tagged: DataFrame) -> DataFrame:
    """Occupations in file order: ``position`` counts from 1 within (file, species, spin).

    For looking at logs; it reads them twice. :func:`pick_observations` needs no complete numbering.
    """
    rows = tagged.filter(F.col("species").isNotNull())
    counts = rows.groupBy(*SERIES, "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn("offset", rows_before(SERIES, ["block"])).drop("n")
    return (
        rows.withColumn("_nth", number_in_block(SERIES, ["block"], ["row"]))
        .join(offsets, [*SERIES, "block"])
        .select(*SERIES, (F.col("offset") + F.col("_nth")).alias("position"), "value")
    )


def finished_logs(tagged: DataFrame) -> DataFrame:
    """(file, converged) of every log that has any occupation or the finish line."""
    return tagged.groupBy("file").agg(F.bool_or("finished").alias("converged"))


def _reduced(rows: pa.Table) -> pa.Table:
    """The first two lines and the last of every series of the rows; the first one bears the series' count."""
    if not rows.num_rows:
        return rows
    file = rows["file"].combine_chunks().dictionary_encode()
    file = (file.combine_chunks() if isinstance(file, pa.ChunkedArray) else file).indices.to_numpy()
    series = [pc.fill_null(rows[c], -1).to_numpy() for c in ("spin", "species")]
    place = rows["row"].combine_chunks()
    parts = place.flatten() if pa.types.is_struct(place.type) else [place]
    parts = [p.cast(pa.float64()) if pa.types.is_decimal(p.type) else p for p in parts]
    keys = [*series, file]
    order = np.lexsort([*[p.to_numpy(zero_copy_only=False) for p in reversed(parts)], rows["block"].to_numpy(), *keys])
    new = np.append(True, np.any([np.diff(k[order]) != 0 for k in keys], axis=0))
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(order))
    stay = np.unique(np.concatenate([first, np.minimum(first + 1, end - 1), end - 1]))
    sums = np.append(0, np.cumsum(rows["n"].to_numpy()[order]))
    counts = np.zeros(len(order), np.int64)
    counts[first] = sums[end] - sums[first]
    kept = rows.take(pa.array(order[stay]))
    return kept.set_column(kept.schema.get_field_index("n"), "n", pa.array(counts[stay]))


def survivors(tagged: DataFrame) -> DataFrame:
    """At most three lines per series and task: its first two and its last, ``n`` counting all of them.

    Lines are reduced where they are read, batch by batch, before any shuffle. A split of a file never
    moves, however long the log, and neither does a task hold more than the lines that stay. Survivors
    may be reduced again: a column ``n`` of theirs goes on counting.
    """
    lines = tagged if "n" in tagged.columns else tagged.withColumn("n", F.lit(1).cast("long"))
    lines = lines.select("file", "block", "row", "species", "spin", "value", "finished", "n")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        for batch in batches:
            kept.append(_reduced(pa.Table.from_batches([batch])))
            if sum(t.num_rows for t in kept) > REDUCE_ROWS:
                whole = _reduced(pa.concat_tables(kept))
                kept = [whole]
                if whole.num_rows > REDUCE_ROWS // 2:  # very many series: pass them on
                    yield from whole.to_batches()
                    kept = []
        if kept:
            yield from _reduced(pa.concat_tables(kept)).to_batches()

    return lines.mapInArrow(reduce, lines.schema)


def pick_observations(tagged: DataFrame) -> DataFrame:
    """(file, species, spin, before_scf, first_scf, last_scf, n_obs, converged) in one pass.

    Only :func:`survivors` are shuffled. Positions a short log does not reach are NULL.
    """
    return picked(survivors(tagged))


def picked(kept: DataFrame) -> DataFrame:
    """The picks of survivors, which may come from several tasks, or batches of a stream.

    A finish line travels as a series of its own (NULL species) and is spread over the file at the end.
    """
    in_file = Window.partitionBy(*SERIES)
    ordered = kept.withColumn(
        "_place", F.row_number().over(in_file.orderBy("block", "row"))
    ).withColumn("_places", F.count(F.lit(1)).over(in_file))

    def value_at(place) -> Column:
        return F.max(F.when(F.col("_place") == place, F.col("value")))

    per_series = ordered.groupBy(*SERIES).agg(
        value_at(1).alias("before_scf"),
        value_at(2).alias("first_scf"),
        value_at(F.col("_places")).alias("last_scf"),
        F.sum("n").alias("n_obs"),
        F.bool_or("finished").alias("_finished"),
    )
    finished = F.bool_or("_finished").over(Window.partitionBy("file"))
    return (
        per_series.withColumn("converged", finished)
        .drop("_finished")
        .filter(F.col("species").isNotNull())
    )


def expected_series(species_counts: DataFrame) -> DataFrame:
    """(file, n_species) -> the species and spins 1, 2 every log should report."""
    species = F.when(F.col("n_species") > 0, F.sequence(F.lit(1), F.col("n_species")))
    return species_counts.select("file", F.explode(species).alias("species")).select(
        "*", F.explode(F.array(F.lit(1), F.lit(2))).alias("spin")
    )


def complete_series(picked: DataFrame, species_counts: DataFrame) -> DataFrame:
    """``picked`` limited to the expected species, absent ones as rows of NULL with ``n_obs`` 0."""
    of_file = Window.partitionBy("file")
    return (
        expected_series(species_counts)
        .withColumn("_expected", F.lit(True))
        # Outer on both sides: a species nobody expected still tells whether its log finished.
        .join(picked, SERIES, "full_outer")
        .withColumn("converged", F.coalesce(F.bool_or("converged").over(of_file), F.lit(False)))
        .filter(F.col("_expected"))
        .drop("_expected")
        .withColumn("n_obs", F.coalesce("n_obs", F.lit(0)))
    )


def complete_series_named(found: DataFrame) -> DataFrame:
    """:func:`complete_series` up to the largest species a log names itself, in one pass over the picks."""
    of_series = F.struct("species", "spin", "before_scf", "first_scf", "last_scf", "n_obs")
    per_log = found.groupBy("file").agg(F.collect_list(of_series).alias("_series"), F.max("species").alias("n_species"), F.bool_or("converged").alias("converged"))
    return _with_absent(per_log)


def complete_by_run(picked: DataFrame, species_counts: DataFrame) -> DataFrame:
    """``picked`` limited to species 1..n of its run's cell, spins 1 and 2, absent ones as rows of NULL.

    species_counts has (run_id, n_species). Every log becomes one row that holds its few series, so
    picks are read once; logs of runs without a count keep what they name.
    """
    of_series = F.struct("species", "spin", "before_scf", "first_scf", "last_scf", "n_obs")
    per_log = picked.groupBy("file").agg(F.collect_list(of_series).alias("_series"), F.bool_or("converged").alias("converged"))
    return _with_absent(per_log.withColumn("run_id", log_run(F.col("file"))).join(species_counts, "run_id", "left"))


def _with_absent(counted: DataFrame) -> DataFrame:
    """Rows of species 1..n_species of every log with the few series it has, spins 1 and 2; all it has without n_species."""
    wanted = F.expr(
        "flatten(transform(sequence(1, greatest(n_species, 1)), s -> transform(array(1, 2), p -> struct(s as species, p as spin))))"
    )
    named = F.expr("transform(_series, s -> struct(s.species as species, s.spin as spin))")
    pairs = F.when(F.col("n_species").isNull(), named).when(F.col("n_species") > 0, wanted)
    rows = counted.select("file", "_series", "converged", F.explode(pairs).alias("_pair"))
    found = F.get(F.filter("_series", lambda s: (s["species"] == F.col("_pair.species")) & (s["spin"] == F.col("_pair.spin"))), F.lit(0))
    return rows.withColumn("_found", found).select(
        "file", "_pair.species", "_pair.spin", "_found.before_scf", "_found.first_scf", "_found.last_scf",
        F.coalesce("_found.n_obs", F.lit(0)).alias("n_obs"), "converged",
    )


def _levels(file: Column) -> Column:
    return F.when(file.rlike(PERTURBED_LOG_PATTERN), F.lit(3)).otherwise(F.lit(2))


def log_run(file: Column) -> Column:
    """Name of the run folder a log lies in."""
    run = F.call_function("substring_index", file, F.lit("/"), -(_levels(file) + 1))
    return F.substring_index(run, "/", 1)


def log_results(picked: DataFrame, *, keep_incomplete: bool = True) -> DataFrame:
    """Picked occupations as result rows; run and job name come from the log's path.

    A base job's log lies two folders below the run's parent, a perturbed one's three.
    ``keep_incomplete=False`` leaves out logs too short to hold all three values.
    """
    rows = picked if keep_incomplete else picked.filter(F.col("n_obs") >= 2)
    inside = F.call_function("substring_index", F.col("file"), F.lit("/"), -_levels(F.col("file")))
    return rows.select(
        log_run(F.col("file")).alias("run_id"),
        F.concat(F.lit("./"), file_stem(inside)).alias("jobname"),
        F.col("species").alias("channel_id"),
        "spin",
        "before_scf",
        "first_scf",
        "last_scf",
        "converged",
    )
