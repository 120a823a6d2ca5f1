"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are its distinct words, word stems (the first 4, 5 and 6 bytes of a word, so that
inflected and compound forms share one), word pairs and pairs with one or two words left out, each hashed
to one of ``DIMENSIONS`` coordinates. Training takes a bounded number of labelled rows
(``MAX_ROWS`` ids, chosen by hash), deals their texts to shards of about ``SHARD_ROWS`` rows and ``SHARD_BYTES``,
and runs FTRL in each: an id that stands on many rows, or long texts, give more shards, not larger ones. Every
coordinate has its own learning rate, and L1 keeps rare coordinates at exactly zero. The shards'
weights are averaged. What is left is short and at most DIMENSIONS long, so every task gets all of it.

Words are runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased. Null and empty texts
have no feature and score as the intercept does; rows whose label is null are not learned from; without
any labelled row every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import extended, staged, table
from scfsweep.llm.words import ALNUM, find_words, mix, ngrams, text_chunks

BITS = 22
DIMENSIONS = 1 << BITS
MAX_ROWS = 16_000
SHARD_ROWS = 4_000
SHARD_BYTES = 64 << 20
EPOCHS = 4
ALPHA, BETA, L2 = 1.0, 1.0, 0.5
#: L1 is a sum over rows; so many rows of a shard raise it by one, within the limits. A lower least value lets
#: features that a few rows happen to share decide long texts (cross-validated within training rows)
L1_ROWS, L1_LEAST, L1_MOST = 700, 3.0, 6.0
#: (words, words left out after the first) of each kind of feature
KINDS = ((1, 0), (2, 0), (2, 1), (2, 2))
STEMS = (4, 5, 6)


def features(texts, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate), both sorted, each pair once; with ``keep`` only coordinates that are true there."""
    words = find_words(texts, ALNUM, lower=True, stems=STEMS)
    rows, pairs = words.rows, []
    whole = np.arange(len(words.hashes))
    kinds = [ngrams(words, n, gap) for n, gap in KINDS] + [(whole, mix(h + np.uint64(k))) for k, h in zip(STEMS, words.stems)]
    for at, hashes in kinds:
        index = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
        if keep is not None:
            some = keep[index]
            at, index = at[some], index[some]
        pairs.append(rows[at] << BITS | index)
    both = np.unique(np.concatenate(pairs))
    return both >> BITS, both & (DIMENSIONS - 1)


def train_ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and intercept; rows holds each document's coordinates, visited in the order given."""
    l1 = min(max(len(rows) / L1_ROWS, L1_LEAST), L1_MOST)
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    b = zb = nb = 0.0
    for _ in range(epochs):
        for index, label in zip(rows, labels):
            zi, ni = z[index], n[index]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((BETA + root) / ALPHA + L2), 0.0)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            z[index] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[index] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA * b
            nb += g * g
            b = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
    w = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    return w, b


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """Weights of all coordinates and the intercept, from docs(doc_id, text) and labels(doc_id, label)."""
    known = labels.filter("label is not null and doc_id is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = known.withColumn("h", F.xxhash64("doc_id", "label")).orderBy("h", "doc_id").limit(max_rows).distinct()
    # max_rows rows of three numbers at most, so documents stay where they are
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = staged(spark, found, "labelled")
    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-size["n"] // SHARD_ROWS), -(-size["bytes"] // SHARD_BYTES))
    sample = sample.withColumn("shard", F.pmod(F.xxhash64("h", "text"), F.lit(shards)).cast("int")).drop("h")
    schema = "coordinate int, weight double"

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")]).combine_chunks()
        rows = []
        for texts in text_chunks(group.column("text").combine_chunks() if group.num_rows else pa.array([], pa.string())):
            at, index = features(texts)
            rows += np.split(index.astype(np.int32), np.searchsorted(at, np.arange(1, len(texts))))
        w, b = train_ftrl(rows, group.column("label").to_numpy())
        some = np.flatnonzero(w)
        return pa.table({"coordinate": pa.array(np.append(some, -1), pa.int32()), "weight": np.append(w[some], b)})

    fitted = sample.groupBy("shard").applyInArrow(fit, schema)
    # DIMENSIONS + 1 rows at most
    rows = fitted.groupBy("coordinate").agg((F.sum("weight")).alias("weight"), F.count("*").alias("n")).toArrow()
    if not rows.num_rows:
        return np.zeros(DIMENSIONS, np.float32), -np.inf
    at = rows["coordinate"].to_numpy()
    parts = rows["n"].to_numpy()[at == -1][0]
    weights = np.zeros(DIMENSIONS + 1)
    weights[at] = rows["weight"].to_numpy() / parts
    return weights[:-1].astype(np.float32), float(weights[-1])


def score(spark: SparkSession, docs: DataFrame, weights: np.ndarray, intercept: float) -> DataFrame:
    """docs and its score between 0 and 1, from the column text alone."""
    index = np.flatnonzero(weights).astype(np.int32)
    shared = spark.sparkContext.broadcast((index, weights[index], intercept))

    def make():
        index, values, intercept = shared.value
        dense = np.zeros(DIMENSIONS, np.float32)
        dense[index] = values
        keep = dense != 0

        def compute(batch):
            out = []
            for texts in text_chunks(batch.column("text")):
                rows, at = features(texts, keep)
                out.append(np.bincount(rows, weights=dense[at], minlength=len(texts)) + intercept)
            logit = np.concatenate(out) if out else np.zeros(0)
            return [pa.array(1 / (1 + np.exp(-np.clip(logit, -700, 700))))]

        return compute

    return extended(docs, [("score", T.DoubleType())], make)


def held_out() -> F.Column:
    """True for the fifth of the ids that is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    weights, intercept = train(spark, docs, labels.filter(~held_out()))
    return score(spark, docs, weights, intercept).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
