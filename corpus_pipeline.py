"""A corpus pipeline: each stage reads what its predecessor wrote, and its decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scfsweep.llm.common import staged, table
from scfsweep.llm.decontaminate import drop_contaminated
from scfsweep.llm.kneser_ney import drop_unlikely
from scfsweep.llm.mixing import mixed
from scfsweep.llm.near_duplicates import drop_near_duplicates
from scfsweep.llm.sharding import sharded

STAGES = [
    ("quality", drop_unlikely),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mixed),
    ("shard", sharded),
]

#: Language model scores and rounded mixing rates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each one's rows written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return docs
