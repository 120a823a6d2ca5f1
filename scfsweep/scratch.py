"""Folders for intermediate tables and stream checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the session names in ``spark.checkpoint.dir``.

    A session that names none gets one below its warehouse, which executors share, too. Folders are
    not removed here: they go with the checkpoint folder, which the cluster's owner clears.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a scratch folder, so that what reads them more than once makes them once."""
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
