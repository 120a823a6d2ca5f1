"""Row numbers within groups of any size.

A window over a whole group would put the group into one task. Instead rows are numbered inside
blocks of bounded size, blocks are counted, and each block starts where the earlier ones end.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def rows_before(group: list[str], block: list[str], count: str = "n") -> Column:
    """On a table of counted blocks: rows of the group in earlier blocks. ``block`` must follow the order."""
    earlier = (
        Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(count).over(earlier), F.lit(0))


def number_in_block(group: list[str], block: list[str], order: list[str]) -> Column:
    """Number of a row within its block, from 1."""
    return F.row_number().over(Window.partitionBy(*group, *block).orderBy(*order))
