"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has ``CELLS`` cells; a row's cell comes from a hash of its id and text, and every shard has
``NODES`` virtual nodes on cells of its own. A row belongs to the next virtual node clockwise. A shard is
full at its bound (law ``rows``: the rows over the shards, at most one apart); rows that come to a full
shard go on clockwise to the next virtual node whose shard is not. Only counts per cell decide this: they
are summed before anything moves, CELLS numbers at most, and the walk over the virtual nodes reads those.
Each row then needs its rank in its cell, which cuts the rows of even a hot shard into many small sorts.
Rows alike in id and text are one row with a count until then, so they load neither a cell nor a task.

Null texts have no bytes (size 1); null ids hash like any other value; repeated rows get slots next to
each other.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scfsweep.llm.common import repeated, staged, table

SHARDS = 8
NODES = 128
CELLS = 1 << 16
LAW = "rows"


def _node_cells(spark: SparkSession, shards: int, nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, in ring order."""
    ids = spark.range(shards * nodes).selectExpr(f"cast(id % {shards} as int) as shard", f"cast(id / {shards} as int) as node")
    rows = ids.select("shard", F.pmod(F.xxhash64(F.lit("node"), "shard", "node"), F.lit(CELLS)).cast("int").alias("cell")).collect()
    return sorted({r.cell: (r.cell, r.shard) for r in sorted(rows, key=lambda r: (r.cell, -r.shard))}.values())


def ring_walk(counts: list[int], nodes: list[tuple[int, int]], bounds: list[int]) -> list[tuple[int, int, int]]:
    """Runs (first row in ring order, shard, first slot) that cover all rows, within the bounds.

    counts has the rows of each cell, and the bounds add up to all rows at least.
    """
    sums = [0]
    for n in counts:
        sums.append(sums[-1] + n)
    used = [0] * len(bounds)
    runs = []
    # the rows after the last node wrap around to the first one
    arcs = [(sums[nodes[k - 1][0] + 1] if k else 0, sums[cell + 1], k) for k, (cell, _) in enumerate(nodes)]
    arcs.append((sums[nodes[-1][0] + 1], sums[-1], 0))
    for first, end, k in arcs:
        while first < end:
            for step in range(len(nodes)):
                shard = nodes[(k + step) % len(nodes)][1]
                if used[shard] < bounds[shard]:
                    break
            else:
                raise ValueError("the bounds hold fewer rows than there are")
            n = min(end - first, bounds[shard] - used[shard])
            runs.append((first, shard, used[shard]))
            used[shard] += n
            first += n
    return runs


def run_cells(counts: list[int], runs: list[tuple[int, int, int]]) -> list[dict]:
    """The runs with the first and the last cell that each one touches."""
    sums = [0, *accumulate(counts)]
    ends = [first for first, _, _ in runs[1:]] + [sums[-1]]
    cell_of = lambda rank: bisect_right(sums, rank) - 1
    return [
        {"first": first, "shard": shard, "slot": slot, "first_cell": cell_of(first), "last_cell": cell_of(end - 1)}
        for (first, shard, slot), end in zip(runs, ends)
    ]


def shard_rows(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """docs(doc_id, text) -> doc_id, size, text_crc32, shard, slot, one row each; counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64("doc_id", "text")
    described = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(hashed, F.lit(CELLS)).cast("int").alias("cell"),
        hashed.alias("h"),
    )
    rows = staged(spark, described.groupBy("doc_id", "size", "text_crc32", "cell", "h").agg(F.count("*").alias("n")), "ring")
    cells = staged(spark, rows.groupBy("cell").agg(F.sum("n").alias("n")), "cells")
    counts = [0] * CELLS
    for r in cells.toLocalIterator():
        counts[r.cell] = r.n
    total = sum(counts)
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    runs = ring_walk(counts, _node_cells(spark, shards, nodes), bounds)
    # one run for each virtual node, and one more for each time a shard fills up within an arc
    kind = "array<struct<first: bigint, shard: int, slot: bigint, first_cell: int, last_cell: int>>"
    all_runs = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(run_cells(counts, runs))), kind)))
    # a row for each cell and run in it: CELLS and the number of runs at most
    of_cell = all_runs.select(F.explode(F.sequence("first_cell", "last_cell")).alias("cell"), F.struct("first", "shard", "slot").alias("run"))
    of_cell = of_cell.groupBy("cell").agg(F.array_sort(F.collect_list("run")).alias("runs"))
    starts = cells.select("cell", (F.sum("n").over(Window.orderBy("cell")) - F.col("n")).alias("start"))  # CELLS rows at most
    planned = starts.join(of_cell, "cell")
    before = Window.partitionBy("cell").orderBy("h", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = ranked.join(planned, "cell").withColumn("before", F.col("before") + F.col("start"))
    each = repeated(placed, "n", "nth", "h").withColumn("rank", F.col("before") + F.col("nth"))
    run = each.withColumn("run", F.expr("element_at(filter(runs, r -> r.first <= rank), -1)"))
    return run.select("doc_id", "size", "text_crc32", F.col("run.shard").alias("shard"), (F.col("run.slot") + F.col("rank") - F.col("run.first")).alias("slot"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on eight shards."""
    placed = shard_rows(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return shard_rows(spark, docs.select("doc_id", "text"))
