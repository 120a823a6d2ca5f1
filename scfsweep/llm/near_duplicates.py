"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

* Every document becomes the set of its five-word shingles (hashed; a text of fewer words is one shingle).
  Documents with equal sets are one representative with a multiplicity from here on.
* Bands and rows per band follow from the threshold and the target recall. Representatives shuffle on
  (band, hash); a bucket links its members to its least one, so edges grow with documents and not with
  pairs. The components of these edges hold every pair that shares a bucket.
* Within a component the pairs that share a bucket are compared on their full sets. A component of many
  representatives, or long ones, is dealt to blocks, each pair of blocks being a task's group of bounded size; a group
  returns link counts and a spanning forest, never its pairs. Small components share groups.
* Components of the verified links are the classes.

A class id is the least doc_id of its members. Texts without words have no shingle: they are alone, with
no link. A null id takes part like any other and is the least only in a class of nulls. Repeated rows are
copies of each other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import extended, rows_of, staged, table
from scfsweep.llm.graph import components
from scfsweep.llm.words import ALNUM, find_words, mix, ngrams, text_chunks

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 80
#: Representatives, and bytes of their texts, that a block holds about
BLOCK = 512
BLOCK_BYTES = 4 << 20


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, whose bands reach the recall at the threshold."""
    fit = []
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-hit))
        if bands * rows > most:
            break
        fit.append((bands, rows))
    if not fit:
        raise ValueError("no bands reach this recall with so few hashes")
    return fit[-1]


def _shingles(texts, n: int) -> list[np.ndarray]:
    """The sorted set of each row's shingles."""
    words = find_words(texts, ALNUM, lower=True)
    at, hashes = ngrams(words, n)
    bounds = np.searchsorted(at, words.bounds)
    out = []
    for row in range(len(texts)):
        a, b = bounds[row], bounds[row + 1]
        if a == b and words.bounds[row] < words.bounds[row + 1]:
            own = words.hashes[words.bounds[row] : words.bounds[row + 1]]
            out.append(mix(np.bitwise_xor.reduce(mix(own + np.arange(len(own), dtype=np.uint64)), keepdims=True)))
        else:
            out.append(np.unique(hashes[a:b]))
    return out


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    made = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return made[:count], made[count:] | np.uint64(1)


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(documents, bands) of 64-bit band hashes; the sets aren't empty."""
    flat = np.concatenate(sets)
    first = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
    xors, factors = _seeds(bands * rows)
    out = np.zeros((len(sets), bands), np.uint64)
    for k in range(bands * rows):
        least = np.minimum.reduceat((flat ^ xors[k]) * factors[k], first)
        band = k // rows
        out[:, band] = mix(out[:, band] * np.uint64(31) + least + np.uint64(k))
    return out


def signatures(docs: DataFrame, n: int = WORDS, bands: int = 18, rows: int = 4) -> DataFrame:
    """docs(doc_id, text) -> doc_id, key, shared (equal for equal sets, null without shingles), bands."""

    def make():
        def compute(batch):
            shared, made = [], []
            for texts in text_chunks(batch.column("text")):
                sets = _shingles(texts, n)
                full = [k for k, s in enumerate(sets) if len(s)]
                hashes = band_hashes([sets[k] for k in full], bands, rows).view(np.int64) if full else np.zeros((0, bands), np.int64)
                digests, lists = [None] * len(sets), [None] * len(sets)
                for k, row in zip(full, hashes):
                    digests[k], lists[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest(), row
                shared += digests
                made += lists
            return [pa.array(shared, pa.binary()), pa.array(made, pa.list_(pa.int64()))]

        return compute

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"), size)
    return extended(keyed, [("shared", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))], make).drop("text")


def _intersections(left: list[np.ndarray], right: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs, one by one or, where pairs are dense, as matrix products."""
    values = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, ids, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts[ids] > 1
    used, ids = np.unique(ids[several], return_inverse=True)
    owner = owner[several]
    step = 2048
    if len(pairs) * 10e-6 < -(-len(used) // step) * len(left) * len(right) * step * 1e-10:
        return np.array([len(np.intersect1d(left[a], right[b], assume_unique=True)) for a, b in pairs.tolist()], np.int64)
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    for low in range(0, len(used), step):
        a, b = np.searchsorted(ids, [low, low + step])
        part = np.zeros((len(left) + len(right), step), np.float32)
        part[owner[a:b], ids[a:b] - low] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def links_within(sets: list[np.ndarray], hashes: np.ndarray, sides: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs (i, j) that share a band and reach the threshold. Sides 0 and 1 are compared with each other, side 2 within itself."""
    inner = bool((sides == 2).any())
    left = np.flatnonzero(sides != 1)
    right = left if inner else np.flatnonzero(sides == 1)
    if not len(left) or not len(right):
        return np.zeros((0, 2), np.int64)
    near = np.zeros((len(left), len(right)), bool)
    for band in range(hashes.shape[1]):
        near |= hashes[left, band][:, None] == hashes[right, band][None, :]
    sizes = np.array([len(s) for s in sets])
    small, large = np.minimum(sizes[left][:, None], sizes[right][None, :]), np.maximum(sizes[left][:, None], sizes[right][None, :])
    near &= small >= threshold * large
    pairs = np.argwhere(np.triu(near, 1) if inner else near)
    if not len(pairs):
        return pairs
    both = _intersections([sets[k] for k in left], [sets[k] for k in right], pairs)
    union = sizes[left[pairs[:, 0]]] + sizes[right[pairs[:, 1]]] - both
    pairs = pairs[both >= threshold * union - 1e-9]
    return np.column_stack([left[pairs[:, 0]], right[pairs[:, 1]]])


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect: each node and the least one of its component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, pairs[:, 0], label[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 1], label[pairs[:, 0]])
        label = label[label]
        if (label == before).all():
            return [(k, int(r)) for k, r in enumerate(label) if k != r]


def near_duplicates(spark: SparkSession, docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """docs(doc_id, text) -> doc_id, key, class_id, n_links: documents it is linked to, copies included; one row each."""
    bands, rows = choose_bands(threshold, recall)
    signed = staged(spark, signatures(docs, n, bands, rows), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key"))
    reps = signed.filter("shared is not null").groupBy("shared").agg(first.alias("one"), F.count("*").alias("copies"), F.max("bytes").alias("bytes"), F.first("bands").alias("bands"))
    reps = staged(spark, reps.select("shared", F.col("one.key").alias("rep"), F.col("one.doc_id").alias("rep_id"), "copies", "bytes", "bands"), "reps")
    spread = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    buckets = spread.groupBy("band", "hash").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least != most")
    edges = spread.join(buckets, ["band", "hash"]).filter("rep != least").selectExpr("rep as a", "least as b")
    near = staged(spark, components(spark, edges), "near")
    weighed = near.join(reps.select(F.col("rep").alias("node"), "copies", "bytes"), "node")
    load = lambda n, b: F.ceil(F.greatest(F.col(n) / block, F.col(b) / BLOCK_BYTES)).cast("int")
    sizes = weighed.groupBy("root").agg(F.count("*").alias("size"), F.sum("bytes").alias("sum")).withColumn("blocks", F.greatest(load("size", "sum"), F.lit(1)))
    shares = staged(spark, weighed.join(sizes, "root").withColumn("own", F.expr("cast(pmod(xxhash64(node, 1), blocks) as int)")), "shares")
    small = shares.filter("blocks = 1").agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"))
    groups = max(1, small.select(load("n", "b").alias("g")).first().g)
    # (root, i, j): the groups a representative takes part in; whole small components share group (-1, g, g)
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.col("root").alias("c"), F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    shared = F.expr(f"named_struct('c', -1L, 'i', cast(pmod(xxhash64(root, 2), {groups}) as int), 'j', -1)")
    members = shares.select(F.col("node").alias("key"), "copies", "own", F.when(F.col("blocks") == 1, F.array(shared)).otherwise(every).alias("at"))
    texts = rows_of(spark, docs.select("text", F.xxhash64("doc_id", "text").alias("key")), members, "key")
    dealt = texts.join(members, "key").select("key", "copies", "own", "text", F.explode("at").alias("at"))
    dealt = dealt.selectExpr("at.c as c", "at.i as i", "at.j as j", "key", "copies", "own", "text")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        keys, once = np.unique(group.column("key").to_numpy(), return_index=True)
        group = group.take(pa.array(once)).combine_chunks()
        text = group.column("text").combine_chunks()
        sets = [s for part in text_chunks(text) for s in _shingles(part, n)]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        own = group.column("own").to_numpy()
        sides = np.full(len(keys), 2) if j == -1 or i == j else (own == j).astype(int)
        pairs = links_within(sets, band_hashes(sets, bands, rows), sides, threshold)
        copies = group.column("copies").to_numpy().astype(np.int64)
        counts = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(keys)) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(keys))
        to = keys.copy()
        for k, r in _forest(pairs, len(keys)):
            to[k] = keys[r]
        return pa.table({"a": keys, "b": to, "links": counts.astype(np.int64)})

    found = staged(spark, dealt.groupBy("c", "i", "j").applyInArrow(compare, "a long, b long, links long"), "links")
    linked = components(spark, found.filter("a != b").select("a", "b"))
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    classed = reps.select("shared", "rep", "rep_id", "copies").join(linked.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left")
    classed = staged(spark, classed.select("shared", "rep_id", "copies", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "classed")
    ids = classed.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    named = classed.join(ids, "root").selectExpr("shared", "class_id", "root", "links + copies - 1 as n_links")
    out = signed.drop("bands", "bytes").join(named, "shared", "left")
    return out.select(
        "doc_id", "key", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("root", "key").alias("root"), "shared"
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates(spark, table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the least id; texts without words and all columns stay."""
    found = staged(spark, near_duplicates(spark, docs), "classes")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key"))
    stay = found.filter("shared is not null").groupBy("root").agg(best.alias("one")).select(F.col("one.key").alias("__key"))
    stay = stay.union(found.filter("shared is null").select("key")).distinct()
    rows = found.groupBy("key").agg(F.count("*").alias("__rows")).withColumnRenamed("key", "__key").join(stay, "__key")
    kept = docs.withColumn("__key", F.xxhash64("doc_id", "text")).join(rows, "__key")
    # rows alike in id and text are copies, too
    return kept.filter("__rows = 1").union(kept.filter("__rows > 1").dropDuplicates(["__key"])).select(*docs.columns)
