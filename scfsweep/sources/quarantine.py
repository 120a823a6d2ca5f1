"""Result files with bad lines: good rows go on, bad lines are kept with the reason they are bad."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.schema import RESULT_COLUMNS, RESULT_FILE_SCHEMA, RESULT_HEADER
from scfsweep.sources.paths import file_path, named_apart, run_key

_KINDS = {"int": "no integer", "double": "no number", "boolean": "no truth value"}


@dataclass(frozen=True)
class Sorted:
    """``good`` has the columns of :func:`read_results`; ``bad`` has (run_id, file, block, row, line, reason)."""

    good: DataFrame
    bad: DataFrame


def _reason(fields: Column) -> Column:
    """Why a line's fields are no result row; NULL if they are one. An empty field is a NULL and no fault."""
    tests = [F.when(F.size(fields) != len(RESULT_HEADER), F.concat(F.size(fields).cast("string"), F.lit(" fields")))]
    for place, field in enumerate(RESULT_FILE_SCHEMA):
        kind = field.dataType.simpleString()
        if kind in _KINDS:
            text = F.get(fields, F.lit(place))
            tests.append(F.when((text != "") & text.try_cast(kind).isNull(), F.lit(f"{field.name}: {_KINDS[kind]}")))
    return F.coalesce(*tests)


def sort_lines(spark: SparkSession, paths: str | list[str], *, header: bool = True, run_level: int = 1, by_name: bool | None = None) -> Sorted:
    """Reads result CSVs line by line and never fails on one: every line but headers and blanks is good or bad.

    ``block`` and ``row`` order the lines of a file as they do for logs. Both tables come from one
    expression over the same scan; which of them is read decides what is computed.
    """
    raw = spark.read.text(paths)
    by_name = named_apart(paths) if by_name is None else by_name
    lines = raw.select(
        run_key(by_name, run_level).alias("run_id"),
        file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    ).filter(F.trim("line") != "")
    fields = F.transform(F.split("line", ","), lambda x: F.trim(x))
    lines = lines.withColumn("_fields", fields)
    if header:
        lines = lines.filter(F.col("_fields") != F.array(*[F.lit(h) for h in RESULT_HEADER]))
    judged = lines.withColumn("reason", _reason(F.col("_fields")))
    values = [
        F.nullif(F.get("_fields", F.lit(k)), F.lit("")).try_cast(f.dataType).alias(name)
        for k, (f, name) in enumerate(zip(RESULT_FILE_SCHEMA, RESULT_COLUMNS))
    ]
    good = judged.filter(F.col("reason").isNull()).select("run_id", *values)
    return Sorted(good, judged.filter(F.col("reason").isNotNull()).drop("_fields"))


def quarantine(bad: DataFrame, path: str) -> None:
    """Adds bad lines to a folder of their own, by reason, for whoever mends the files."""
    bad.withColumn("why", F.col("reason")).write.mode("append").partitionBy("why").parquet(path)
