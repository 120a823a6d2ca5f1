"""What the operators share: staged tables, row numbers, columns made from Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.scratch import scratch_folder

ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str, **options) -> DataFrame:
    """Writes the rows to the shared folder and reads them: they are made once and outlive executors."""
    path = scratch_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROW_KEYS = ("__key1", "__key2")


def with_row_keys(df: DataFrame, *columns: str) -> DataFrame:
    """df with ROW_KEYS, 128 bits of hash of the columns; a null differs from every value."""
    each = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return df.withColumns({key: F.xxhash64(F.lit(k), *each) for k, key in enumerate(ROW_KEYS)})


def without(df: DataFrame, bad: DataFrame) -> DataFrame:
    """df's rows whose ROW_KEYS aren't in bad, without ROW_KEYS."""
    return df.join(bad.select(*ROW_KEYS).distinct(), list(ROW_KEYS), "left_anti").drop(*ROW_KEYS)


#: Copies of a row that one step of ``repeated`` makes
CHUNK = 1 << 10


def repeated(df: DataFrame, n: str, nth: str, *key: str) -> DataFrame:
    """df's rows as often as their column n says, without n; nth counts a row's copies from 0.

    Rows with many copies are cut into chunks and dealt by ``key`` and chunk before the copies are made,
    so that no task makes all of a row's.
    """
    last = F.expr(f"cast(`{n}` as long) - 1")
    chunks = df.filter(F.col(n) > 0).withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / CHUNK))))
    first = F.col("__chunk") * CHUNK
    dealt = chunks.repartition(*key, "__chunk")
    return dealt.withColumn(nth, F.explode(F.sequence(first, F.least(first + CHUNK - 1, last)))).drop(n, "__chunk")


SLOTS = 1 << 22
MAX_KEYS = 1 << 20


def rows_of(
    spark: SparkSession,
    docs: DataFrame,
    keys: DataFrame,
    key: str,
    max_keys: int = MAX_KEYS,
    then: tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str] | None = None,
) -> DataFrame:
    """The rows of docs whose ``key`` (a long, not null) is in ``keys``; docs' columns only.

    Up to max_keys different keys go to every task, and docs stay where they are. More of them are joined
    by a shuffle; a bitmap of SLOTS bits, whatever the number of keys, thins docs before it.

    ``then``, a function of batches and its schema, makes other rows of these. Where docs stay it runs in the
    process that picks them: a mapInArrow of its own would keep a second Python process for every task.
    """
    wanted = keys.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key)).distinct()
    few = wanted.limit(max_keys + 1).toArrow()
    known = few.num_rows <= max_keys
    if known:
        shared = spark.sparkContext.broadcast(np.sort(few.column(key).to_numpy()))
    else:
        slot = f"cast(pmod(xxhash64({key}), {SLOTS}) as int)"
        bitmap = np.zeros(SLOTS, bool)
        bitmap[wanted.selectExpr(f"{slot} as slot").distinct().toArrow()["slot"].to_numpy()] = True  # SLOTS numbers at most
        shared = spark.sparkContext.broadcast(np.packbits(bitmap))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = shared.value if known else np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            at = batch.column("__at").to_numpy()
            if not known:
                stay = near[at]
            elif len(near):
                stay = near[np.minimum(np.searchsorted(near, at), len(near) - 1)] == at
            else:
                stay = np.zeros(len(at), bool)
            yield batch.filter(pa.array(stay)).select(schema.names)

    some = docs.filter(F.col(key).isNotNull()).withColumn("__at", F.col(key).cast("long") if known else F.expr(slot))
    if known and then:
        made, schema_made = then
        return some.mapInArrow(lambda batches: made(run(batches)), schema_made)
    thinned = some.mapInArrow(run, schema)
    found = thinned if known else thinned.join(wanted, key, "left_semi")
    return found.mapInArrow(*then) if then else found


def extended(
    df: DataFrame,
    fields: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    number_rows: bool = False,
) -> DataFrame:
    """df with further columns, computed batch by batch; make() runs once per task.

    With number_rows each row also gets a number of its own. It depends on how rows are dealt to
    tasks, so stage the result before it is read twice.
    """
    fields = [(ROW, T.LongType())] * number_rows + fields
    clashes = set(df.columns) & {name for name, _ in fields}
    if clashes:
        raise ValueError(f"columns already there: {sorted(clashes)}")
    schema = T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        for batch in batches:
            numbers = [pa.array(np.arange(first, first + batch.num_rows))] if number_rows else []
            first += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers, *compute(batch)], schema.names)

    return df.mapInArrow(run, schema)
