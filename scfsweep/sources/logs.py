"""Simulator logs as lines, splittable: a huge log is shared by many tasks like any other text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.sources.paths import file_path

# An occupation line, and the words of a finished run.
OCCUPATION_PATTERN = r"(?i)[ \t]\d+[ \t]+\d+ Total\S*\s+\S+"
FINISHED_TEXT = "Finalisation time"


def log_lines(spark: SparkSession, paths: str | list[str], pattern: str = "*.castep") -> DataFrame:
    """Lines as (file, block, row, line): ``row`` orders lines of a block, ``block`` those of a file."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(paths)
    )
    return lines.select(
        file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def tag_lines(lines: DataFrame) -> DataFrame:
    """Occupation and finish lines only, as (file, block, row, species, spin, value, finished)."""
    line = F.col("line")
    finished = line.contains(FINISHED_TEXT)
    # A plain substring test first: nearly every line of a log fails it.
    occupation = F.lower(line).contains(" total") & line.rlike(OCCUPATION_PATTERN)
    # One search gives "species spin Total: value", whose parts are then cheap to split. Finish lines
    # give NULL: casting '' would raise and catch an error for each of them.
    text = F.nullif(F.regexp_extract(line, OCCUPATION_PATTERN, 0), F.lit(""))
    found = F.split(F.trim(text), r"\s+")
    return (
        lines.filter(occupation | finished)
        .select("file", "block", "row", found.alias("_found"), finished.alias("finished"))
        .select(
            "file",
            "block",
            "row",
            F.get("_found", F.lit(0)).try_cast("int").alias("species"),
            F.get("_found", F.lit(1)).try_cast("int").alias("spin"),
            F.element_at("_found", -1).try_cast("double").alias("value"),
            "finished",
        )
    )
