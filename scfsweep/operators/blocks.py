"""Perturbation blocks of cell files, edited as arrays in the file's own row (no shuffle, no join)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scfsweep.sources.inputs import block_lines

ITEM_FIELDS = ("block", "pos", "element", "atom_id", "orbital", "value")


def species_count(files: DataFrame) -> DataFrame:
    """(file, text) -> (file, n_species): lines of the U block with more than two fields."""
    listed = F.filter(block_lines(F.col("text"), "U"), lambda line: F.size(F.split(line, r"\s+")) > 2)
    return files.select("file", F.size(listed).alias("n_species"))


def explode_items(cells: DataFrame) -> DataFrame:
    """(file, items, ...) -> one row per item, in long form."""
    rest = [c for c in cells.columns if c != "items"]
    # An outer explode, because a plain one adds a size test that parses every text a second time.
    items = cells.select(*rest, F.explode_outer("items").alias("_item")).filter(F.col("_item").isNotNull())
    return items.select(*rest, *[F.col(f"_item.{f}").alias(f) for f in ITEM_FIELDS])


def _valued(item: Column, value: Column) -> Column:
    return item.withField("value", value.cast("double"))


def update_where(items: Column, condition: Callable[[Column], Column], value: Column) -> Column:
    """Items with ``value`` set on those that meet the condition."""
    return F.transform(items, lambda i: F.when(condition(i), _valued(i, value)).otherwise(i))


def set_block(items: Column, block: str, value: Column) -> Column:
    """Items with every value of one block set."""
    return update_where(items, lambda i: i["block"] == block, value)


def with_alpha(items: Column) -> Column:
    """Items with an alpha block: the file's own, else a copy of its U items, values and all."""
    copies = F.transform(
        F.filter(items, lambda i: i["block"] == "U"), lambda i: i.withField("block", F.lit("ALPHA"))
    )
    has_alpha = F.exists(items, lambda i: i["block"] == "ALPHA")
    return F.when(has_alpha, items).otherwise(F.concat(items, copies))


def derive_alpha(items: Column, value: Column) -> Column:
    """Items with an alpha block: the file's own, else a copy of its U items; all values set."""
    return set_block(with_alpha(items), "ALPHA", value)


def prepare_base(items: Column, u_value: Column, alpha_value: Column) -> Column:
    """Items of a base job: both blocks at their set-points."""
    return derive_alpha(set_block(items, "U", u_value), alpha_value)


def perturb(items: Column, alpha_value: Column) -> Column:
    """Items of a perturbed job: the alpha block moves, U stays."""
    return set_block(items, "ALPHA", alpha_value)


def with_cells(runs: DataFrame, cells: DataFrame) -> DataFrame:
    """Any table with ``run_id`` beside its run's cell: items with an alpha block, and ``cell_status``.

    Every row comes out once. A run should have one cell: with ``no cell`` the items are NULL, with
    ``several cells`` they are those of the first file.
    """
    of_run = cells.groupBy("run_id").agg(
        F.min(F.struct(*[c for c in ("file", "items") if c in cells.columns]))["items"].alias("items"),
        F.count(F.lit(1)).alias("_cells"),
    )
    status = (
        F.when(F.col("_cells").isNull(), F.lit("no cell")).when(F.col("_cells") > 1, F.lit("several cells")).otherwise(F.lit("ok"))
    )
    # with the items made here, an item is parsed and its alpha block derived once for a run
    ready = of_run.withColumn("items", with_alpha(F.col("items")))
    return runs.join(ready, "run_id", "left").withColumn("cell_status", status).drop("_cells")


def planned_items(plan: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Plan rows (with set-points) beside their run's cell, items at the set-points, and ``cell_status``.

    Every plan row comes out once, as :func:`with_cells` has it. A plan made of runs that went through
    :func:`with_cells` needs no ``cells``: then the join moves a row per run and not one per job.
    """
    placed = plan if cells is None else with_cells(plan, cells)
    at_setpoint = F.transform(
        F.col("items"),
        lambda i: i.withField(
            "value",
            F.when(i["block"] == "U", F.col("u_value").cast("double")).when(i["block"] == "ALPHA", F.col("alpha_value").cast("double")).otherwise(i["value"]),
        ),
    )
    return placed.withColumn("items", at_setpoint)


def items_without_cell(items: DataFrame) -> DataFrame:
    """Planned jobs whose run has no cell, or more than one."""
    return items.filter(F.col("cell_status") != "ok").select("run_id", "jobname", "cell_status")


def first_value(items: Column, block: str = "ALPHA") -> Column:
    """Value of the block's first item."""
    return F.get(F.filter(items, lambda i: i["block"] == block), F.lit(0))["value"]


def item_text(item: Column) -> Column:
    """Item as a line of its block.

    The JVM pads with zeros after the shortest exact digits, so values that need more than 15
    significant digits can differ from C's printf in the last place.
    """
    atom = F.coalesce(item["atom_id"].cast("string"), F.lit(""))
    return F.format_string("%4s %s %s: %20.15f", item["element"], atom, item["orbital"], item["value"])
