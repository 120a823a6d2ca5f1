"""Result tables to which every batch is added once, however often its append is tried.

A batch has a name. Its rows go to a folder of their own, which a repeated try overwrites, and then one row
in the table's manifest makes them count. Readers see batches of the manifest only: what a lost driver
left half written shows nowhere, and an append that is repeated after its commit adds nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.schema import RESULT_COLUMNS, RESULT_FILE_SCHEMA, RESULT_HEADER

_MANIFEST = "batch string, folder string, n_rows long"
_FOLDER = "folder"


def _rows(root: str) -> str:
    return f"{root.rstrip('/')}/rows"


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def start_table(spark: SparkSession, root: str) -> None:
    """A new table without batches; one that is there starts anew."""
    spark.createDataFrame([], _MANIFEST).write.mode("overwrite").parquet(_commits(root))


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(_commits(root)).groupBy("batch", _FOLDER).agg(F.max("n_rows").alias("n_rows"))


def committed(spark: SparkSession, root: str) -> DataFrame:
    """(batch, n_rows) of every batch that counts."""
    return _manifest(spark, root).drop(_FOLDER)


def append_once(results: DataFrame, root: str, batch: str) -> bool:
    """Adds result rows under the batch's name; returns whether they were added now.

    Of two drivers that try one batch at a time the later overwrites the same folder and both commit the
    same batch, which counts once. Different batches never touch each other's files.
    """
    spark = results.sparkSession
    if committed(spark, root).filter(F.col("batch") == batch).limit(1).count():
        return False
    # any text may name a batch, but not a folder
    folder = hashlib.sha256(batch.encode()).hexdigest()[:32]
    path = f"{_rows(root)}/{_FOLDER}={folder}"
    rows = results.select("run_id", *[F.col(c).alias(h) for c, h in zip(RESULT_COLUMNS, RESULT_HEADER)])
    rows.write.mode("overwrite").option("header", True).csv(path)
    written = spark.read.option("header", True).schema(_file_schema()).csv(path).count()
    spark.createDataFrame([(batch, folder, written)], _MANIFEST).coalesce(1).write.mode("append").parquet(_commits(root))
    return True


def _file_schema() -> str:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RESULT_FILE_SCHEMA)
    return f"run_id string, {fields}"


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all batches that count, with their ``batch``. Other folders are pruned, not read."""
    known = _manifest(spark, root).drop("n_rows")
    schema = f"{_file_schema()}, {_FOLDER} string"
    if known.limit(1).count():
        rows = spark.read.option("header", True).schema(schema).csv(_rows(root)).join(known, _FOLDER)
    else:
        rows = spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("string"))
    return rows.select("run_id", *[F.col(f"`{h}`").alias(c) for c, h in zip(RESULT_COLUMNS, RESULT_HEADER)], "batch")
