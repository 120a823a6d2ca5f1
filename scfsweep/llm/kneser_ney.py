"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, order 5 over bytes.

Counts: each task counts the five-byte windows of its trusted texts and emits every distinct one once;
sums per window, lower-order continuation counts, context totals and backoff weights follow from joins
and groupings of these tables by hashed keys, so no task sees more than its share. Keys are the bytes
themselves: nothing collides.

Scores: no window is left out of the model. Its tables stay sharded; the ``CACHED`` windows that trusted text
holds most often, at most, go to every task, which sums what they give its documents. Every other window of
a document becomes one row (document, window, count), the different ones of these rows are looked up in the
tables of all orders by joins, and the results are joined back and summed. The cache changes what is
shuffled, never a score. A document's score is its bits per byte, drawn towards the mean of its language while
it is short; perplexity is 2 to that power.

Thresholds: per language, from quantiles of the scores of trusted documents: the median plus ``SPREAD``
times the distance to the upper quantile. A language with too few trusted documents uses the threshold of
all. Documents above it are rejected.

Null and empty texts hold no byte and are kept, with the mean of their language for a score. A null language is a
language of its own. Without any trusted row nothing is rejected. Repeated rows count as often as they
occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import ROW, ROW_KEYS, rows_of, staged, table, with_row_keys, without
from scfsweep.llm.words import Texts, mix, text_chunks

ORDER = 5
CACHED = 1 << 20
#: Bytes of text whose windows a task makes at a time; each takes about 100 bytes meanwhile
CHUNK = 1 << 18
PRIOR_BYTES = 200
QUANTILE = 0.99
SPREAD = 3.0
LEAST_TRUSTED = 30


def windows(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER bytes up to each byte and to each text's end, as one number, and where each text's begin.

    Zeros stand before a text and at its end.
    """
    n, lengths = len(texts), np.diff(texts.offsets)
    padded = np.zeros(len(texts.data) + ORDER * n + ORDER - 1, np.uint64)
    shift = np.repeat(np.arange(n) * ORDER + ORDER - 1, lengths)
    padded[np.arange(len(texts.data)) + shift] = texts.data
    ends = np.ones(len(padded), bool)
    starts = texts.offsets[:-1] + np.arange(n) * ORDER
    for k in range(ORDER - 1):
        ends[starts + k] = False
    ends[len(padded) - (ORDER - 1) :] = False
    key = np.zeros(len(padded), np.uint64)
    for k in range(ORDER):
        key[k:] |= padded[: len(padded) - k] << np.uint64(8 * k)
    return key[ends], texts.offsets + np.arange(n + 1)


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): every window of the batches' texts once."""
    keys, counts, held, settled = [], [], 0, 0
    for batch in batches:
        for texts in text_chunks(batch.column("text"), CHUNK):
            k, c = np.unique(windows(texts)[0], return_counts=True)
            keys.append(k)
            counts.append(c.astype(np.int64))
            held += len(k)
            if held > max(2 * settled, 1 << 20):
                k, c = _sum(np.concatenate(keys), np.concatenate(counts))
                keys, counts, held, settled = [k], [c], len(k), len(k)
    if held:
        k, c = _sum(np.concatenate(keys), np.concatenate(counts))
        for at in range(0, len(k), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(k[at : at + (1 << 16)].astype(np.int64)), pa.array(c[at : at + (1 << 16)])], ["key", "n"])


_COUNTED = "key long, n long"


def count_windows(trusted: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(key, n): how often each window occurs in the texts; with ids(doc_id), in those of these documents."""
    if ids is None:
        counted = trusted.select("text").mapInArrow(_counted, _COUNTED)
    else:
        counted = rows_of(trusted.sparkSession, trusted.select("doc_id", "text"), ids, "doc_id", then=(_counted, _COUNTED))
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What to take off counts of 1, 2, and 3 or more."""
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw)]


@dataclass
class Model:
    """Per order from 1: the tables (key, p; the last also n) and (context, backoff); contexts are one byte shorter."""

    grams: list[DataFrame]
    contexts: list[DataFrame]


def model(spark: SparkSession, counts: DataFrame) -> Model:
    tables = [staged(spark, counts, "windows")]
    for order in range(ORDER - 1, 0, -1):
        tail = F.col("key").bitwiseAND(F.lit((1 << 8 * order) - 1))
        lower = tables[0].groupBy(tail.alias("key")).agg(F.count("*").alias("n"))
        tables.insert(0, staged(spark, lower, f"order{order}"))
    # one row of twenty numbers: no shuffle by count, and one job for all orders
    rare = reduce(DataFrame.union, [grams.filter("n <= 4").select(F.lit(order).alias("order"), "n") for order, grams in enumerate(tables, 1)])
    times = [F.count_if((F.col("order") == order) & (F.col("n") == k)) for order in range(1, ORDER + 1) for k in (1, 2, 3, 4)]
    found = rare.agg(F.array(*times).alias("times")).first().times
    out = Model([], [])
    for order, grams in enumerate(tables, 1):
        d = discounts(*found[4 * order - 4 : 4 * order])
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        grams = grams.withColumn("context", F.expr("shiftright(key, 8)")).withColumn("off", off)
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("backoff"))
        contexts = staged(spark, contexts, f"contexts{order}")
        joined = grams.join(contexts, "context").withColumn("tail", F.col("key").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1)))
        if order == 1:
            joined = joined.withColumn("lower", F.lit(1 / 256))
        else:
            joined = joined.join(out.grams[-1].select(F.col("key").alias("tail"), F.col("p").alias("lower")), "tail")
        p = (F.expr("(n - off) / total") + F.col("backoff") * F.col("lower")).alias("p")
        out.grams.append(staged(spark, joined.select("key", p, *["n"] * (order == ORDER)), f"p{order}"))
        out.contexts.append(contexts.select("context", "backoff"))
    return out


def lowest(tables: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of every two bytes: their probability by the orders 1 and 2, and their backoff as a context."""
    parts = [(tables.grams[0], "p"), (tables.contexts[0], "backoff"), (tables.grams[1], "p"), (tables.contexts[1], "backoff"), (tables.contexts[2], "backoff")]
    every = [df.select(F.lit(k).alias("k"), F.col(df.columns[0]).alias("key"), F.col(value).alias("value")) for k, (df, value) in enumerate(parts)]
    got = reduce(DataFrame.union, every).toArrow()  # 131,585 rows at most: 256 * 256 keys, 256, and 1
    kind, key, value = (got[c].to_numpy() for c in ("k", "key", "value"))

    def filled(k: int, out: np.ndarray) -> np.ndarray:
        out[key[kind == k]] = value[kind == k]
        return out

    p = filled(0, np.repeat(filled(1, np.ones(1)) / 256, 256))
    p = filled(2, (filled(3, np.ones(256))[:, None] * p).ravel())
    return p, filled(4, np.ones(1 << 16))


def looked_up(keys: DataFrame, tables: Model) -> DataFrame:
    """(key, log_p) for different windows, known or not: the orders 1 and 2 from arrays, every other by joins.

    The joins shuffle whatever the size: tables broadcast for them at once, ten and more, all pass the driver.
    """
    shared = keys.sparkSession.sparkContext.broadcast(lowest(tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, backoff = shared.value
        for batch in batches:
            key = batch.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(low[key & 0xFFFF]), pa.array(backoff[(key >> 8) & 0xFFFF])], ["key", "p", "backoff"])

    out = keys.select("key").mapInArrow(run, "key long, p double, backoff double")
    for order in range(3, ORDER + 1):
        grams = tables.grams[order - 1].select(F.col("key").alias("part"), F.col("p").alias("own"))
        out = out.withColumn("part", F.col("key").bitwiseAND(F.lit((1 << 8 * order) - 1)))
        if order > 3:
            contexts = tables.contexts[order - 1].withColumnRenamed("context", "before")
            out = out.withColumn("before", F.expr("shiftright(part, 8)")).join(contexts.hint("merge"), "before", "left")
        out = out.join(grams.hint("merge"), "part", "left")
        out = out.select("key", F.coalesce("own", F.coalesce("backoff", F.lit(1.0)) * F.col("p")).alias("p"))
    return out.select("key", F.log2("p").alias("log_p"))


class Scorer:
    """log2 probabilities of some windows, for trials from the driver."""

    def __init__(self, tables: Model):
        self.tables = tables

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        spark = self.tables.grams[0].sparkSession
        distinct, which = np.unique(keys, return_inverse=True)
        asked = spark.createDataFrame([(int(k),) for k in distinct], "key long")
        return looked_up(asked, self.tables).toArrow().sort_by("key")["log_p"].to_numpy()[which]


def commonest(tables: Model, most: int = CACHED) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and log2 probabilities of up to ``most`` windows: as many whole classes of counts as fit, from the top."""
    level = F.expr("if(n < 4096, n, 4096 + length(bin(n)))")
    levels = tables.grams[-1].groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect()  # 4,159 rows at most
    least, rows = None, 0
    for r in sorted(levels, key=lambda r: -r.level):
        rows += r.rows
        if rows > most:
            break
        least = r.level
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0)
    got = tables.grams[-1].filter(level >= least).select("key", F.log2("p").alias("log_p")).toArrow().sort_by("key")  # ``most`` rows at most
    return got["key"].to_numpy().astype(np.uint64), got["log_p"].to_numpy()


class Cache:
    """Which windows are held, and their log2 probabilities; mostly one look into a hash table."""

    def __init__(self, keys: np.ndarray, log_p: np.ndarray):
        self.keys, self.log_p = keys, log_p
        self.bits = np.uint64(64 - max(16, math.ceil(math.log2(len(keys) + 1)) + 1))
        self.slots = np.full(1 << (64 - int(self.bits)), np.iinfo(np.uint64).max)
        self.values = np.zeros(len(self.slots))
        at = (mix(keys) >> self.bits).astype(np.int64)
        self.slots[at], self.values[at] = keys, log_p  # a slot keeps one of its keys; the others are searched for

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (mix(keys) >> self.bits).astype(np.int64)
        held, out = self.slots[at] == keys, self.values[at]
        rest = np.flatnonzero(~held)
        if len(rest) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
            held[rest], out[rest] = self.keys[at] == keys[rest], self.log_p[at]
        out[~held] = 0
        return held, out


_REST = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())]))


def with_bits(spark: SparkSession, docs: DataFrame, tables: Model, cached: int = CACHED) -> DataFrame:
    """docs without text, with the bits that it takes and the number of bytes coded (without the end)."""
    shared = spark.sparkContext.broadcast(commonest(tables, cached))
    own = [f for f in docs.schema.fields if f.name != "text"]
    new = [T.StructField(ROW, T.LongType()), T.StructField("held", T.DoubleType()), T.StructField("bytes", T.LongType()), T.StructField("rest", _REST)]
    names, schema = [f.name for f in own], T.StructType(own + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, context = Cache(*shared.value), TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for texts in text_chunks(batch.column("text"), CHUNK):
                n = len(texts)
                keys, bounds = windows(texts)
                held, log_p = cache(keys)
                rest = np.flatnonzero(~held)
                rows, left = np.repeat(np.arange(n), np.diff(bounds))[rest], keys[rest].astype(np.int64)
                order = np.lexsort((left, rows))
                rows, left = rows[order], left[order]
                starts = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (left[1:] != left[:-1]))[: len(rows)])
                counts = np.diff(np.append(starts, len(rows)))
                pairs = pa.StructArray.from_arrays([pa.array(left[starts]), pa.array(counts.astype(np.int64))], ["key", "n"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[starts], np.arange(n + 1)).astype(np.int32)), pairs)
                # every text has an end, so no sum is empty; equal texts have equal sums wherever they stand
                sums = np.add.reduceat(log_p, bounds[:-1])
                part = batch.slice(texts.first, n).select(names)
                numbers = pa.array(np.arange(first, first + n))
                first += n
                yield pa.RecordBatch.from_arrays([*part.columns, numbers, pa.array(sums), pa.array(np.diff(texts.offsets).astype(np.int64)), lists], schema.names)

    coded = staged(spark, docs.mapInArrow(run, schema), "coded")
    rest = coded.select(ROW, F.explode("rest").alias("w")).select(ROW, "w.key", "w.n")
    found = staged(spark, looked_up(rest.select("key").distinct(), tables), "found")
    sums = rest.join(found.hint("merge"), "key").groupBy(ROW).agg(F.sum(F.col("n") * F.col("log_p")).alias("looked_up"))
    joined = coded.drop("rest").join(sums, ROW, "left")
    return joined.withColumn("bits", -F.col("held") - F.coalesce("looked_up", F.lit(0.0))).drop(ROW, "held", "looked_up")


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, cached: int = CACHED, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs(doc_id, text, lang) and labels(doc_id, quality; 1 is trusted) -> doc_id, lang, bytes, score, perplexity, threshold, kept, and docs' columns keep."""
    ids = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    tables = model(spark, count_windows(docs.filter("text is not null"), ids))
    lang = "coalesce(concat('=', lang), '') as named"
    scored = staged(spark, with_bits(spark, docs.select("doc_id", "text", "lang", *keep), tables, cached).selectExpr("*", lang), "bits")
    # a row per language: written, so that their size is known and documents aren't shuffled by language
    means = scored.groupBy("named").agg(F.coalesce(F.try_divide(F.sum("bits"), F.sum("bytes")), F.lit(8.0)).alias("mean"))
    means = staged(spark, means, "means")
    drawn = scored.join(means, "named").withColumn("score", F.expr(f"(bits + {PRIOR_BYTES} * mean) / (bytes + {PRIOR_BYTES})"))
    quantiles = lambda group: (
        drawn.join(ids, "doc_id", "left_semi")
        .groupBy(*group)
        .agg(F.percentile_approx("score", [0.5, QUANTILE], 10_000).alias("q"), F.count("*").alias("trusted"))
        .withColumn("threshold", F.col("q")[0] + SPREAD * (F.col("q")[1] - F.col("q")[0]))
    )
    own = quantiles(["named"]).filter(F.col("trusted") >= LEAST_TRUSTED).select("named", F.col("threshold").alias("own"))
    every = quantiles([]).first()["threshold"]  # a single number
    limits = staged(spark, means.select("named", F.lit(every).cast("double").alias("every")).join(own, "named", "left"), "limits")
    judged = drawn.join(limits, "named").withColumn("threshold", F.coalesce("own", "every"))
    return judged.select(
        "doc_id", "lang", "bytes", "score", F.pow(F.lit(2.0), "score").alias("perplexity"), "threshold", F.coalesce((F.col("bytes") == 0) | (F.col("score") <= F.col("threshold")), F.lit(True)).alias("kept"), *keep
    )


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, judged by the model of the trusted ones."""
    return judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_unlikely(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows that the classifier rejects; all columns stay."""
    keyed = with_row_keys(docs, "text", "lang")  # which alone decide
    bad = judge(spark, keyed, table(spark, sf_dir, "labels"), keep=ROW_KEYS).filter("not kept")
    return without(keyed, bad)
