"""MinHash near-dedup by an inverted join of signature coordinates.

* A document is the set of its four-word shingles; equal sets become one representative. Its signature has
  ``COORDINATES`` least hashes, and each (coordinate, value) pair is a token with a posting list.
* Two documents that reach the threshold share ``least_matches`` of their tokens, but for one in
  ``1 / (1 - RECALL)``. Tokens have one order for all documents, rarest first, so two such documents share
  a token among each one's first ``COORDINATES - least_matches + 1`` (the prefix). Only prefixes are posted;
  tokens of one document alone are never joined, and what many documents have lies behind the prefix.
* Collisions are counted over whole signatures, pairs with enough of them are retained, and their full
  shingle sets decide by whole numbers.
* Merging skips what is settled. First each list's least member meets all others (as many pairs as
  postings). What that links is one component, and lists within one component are skipped from then on. What
  the other lists hold together is compared in groups of bounded size, only the members outside the largest
  component with all others: collisions are counted, retained pairs settled on their full sets, those with
  most collisions first, and pairs that others have connected by then are skipped. A group returns a spanning
  forest, never its pairs.

Texts without words have an empty set: they are linked with nothing and are their own component. Shorter
texts than a shingle are one. Null texts are empty; null ids come last and name a component only where all
of it has none; repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import ROW_KEYS, extended, staged, table, with_row_keys
from scfsweep.llm.graph import components
from scfsweep.llm.words import PRINTED, find_words, mix, ngrams, text_chunks

WORDS = 4
#: A pair is linked when 100 * intersection >= PERCENT * union
PERCENT = 80
RECALL = 0.9999
COORDINATES = 48
SLOTS = 1 << 24
#: Members on either side of a group
LEFT, RIGHT = 1024, 4096
#: Shingles a member has about; longer ones count for several
AVERAGE = 512


def least_matches(percent: int = PERCENT, coordinates: int = COORDINATES, recall: float = RECALL) -> int:
    """The most collisions that a pair at the threshold still has with probability ``recall``."""
    p, missed = percent / 100, 0.0
    for k in range(coordinates + 1):
        missed += math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k)
        if missed > 1 - recall:
            return max(k, 1)
    return coordinates


def _sets(texts, n: int) -> list[np.ndarray]:
    """The sorted set of each row's shingle hashes."""
    words = find_words(texts, PRINTED, lower=True)
    at, hashes = ngrams(words, n)
    bounds, counts = np.searchsorted(at, words.bounds), words.counts
    out = []
    for row in range(len(texts)):
        a, b = bounds[row], bounds[row + 1]
        if a == b and counts[row]:
            own = words.hashes[words.bounds[row] : words.bounds[row + 1]]
            out.append(mix(np.add.reduce(mix(own + np.arange(1, len(own) + 1, dtype=np.uint64)), keepdims=True) + np.uint64(len(own))))
        else:
            out.append(np.unique(hashes[a:b]))
    return out


def _tokens(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(documents, coordinates): the coordinate above 32 bits of its least hash."""
    flat = np.concatenate(sets)
    first = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
    seeds = mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(sets), coordinates), np.int64)
    for k in range(coordinates):
        least = np.minimum.reduceat(mix(flat ^ seeds[k]), first)
        out[:, k] = (least >> np.uint64(32)).astype(np.int64) | (k << 32)
    return out


def signatures(docs: DataFrame, n: int = WORDS, coordinates: int = COORDINATES) -> DataFrame:
    """docs(doc_id, text) -> doc_id, row keys, n_shingles, shared (equal for equal sets, null for empty ones), tokens."""

    def make():
        def compute(batch):
            sizes, shared, tokens = [], [], []
            for texts in text_chunks(batch.column("text")):
                sets = _sets(texts, n)
                full = [k for k, s in enumerate(sets) if len(s)]
                made = _tokens([sets[k] for k in full], coordinates) if full else ()
                own, lists = [None] * len(sets), [None] * len(sets)
                for k, row in zip(full, made):
                    own[k], lists[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest(), row
                sizes += [len(s) for s in sets]
                shared += own
                tokens += lists
            return [pa.array(sizes, pa.int64()), pa.array(shared, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))]

        return compute

    fields = [("n_shingles", T.LongType()), ("shared", T.BinaryType()), ("tokens", T.ArrayType(T.LongType()))]
    return extended(with_row_keys(docs.select("doc_id", "text"), "doc_id", "text"), fields, make).drop("text")


def _shingle_sets(spark: SparkSession, docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(rep, shingles) of the rows of docs whose row keys are in wanted(ROW_KEYS, rep).

    A bitmap of SLOTS bits, whatever their number, thins docs before the join on both keys.
    """
    slot = f"cast(pmod({ROW_KEYS[0]}, {SLOTS}) as int)"
    bits = wanted.selectExpr(f"cast(floor({slot} / 64) as int) as word", f"shiftleft(1L, {slot} % 64) as bit").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(SLOTS // 64, np.int64)  # its rows at most
    words[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    shared = spark.sparkContext.broadcast(words)
    keyed = with_row_keys(docs.select("doc_id", "text"), "doc_id", "text").select("text", *ROW_KEYS, F.expr(slot).alias("slot"))

    def thin(batches):
        near = shared.value
        for batch in batches:
            at = batch.column("slot").to_numpy()
            stay = (near[at >> 6] >> (at & 63)) & 1
            yield batch.filter(pa.array(stay.astype(bool))).select(["text", *ROW_KEYS])

    some = keyed.mapInArrow(thin, "text string, " + ", ".join(f"{k} long" for k in ROW_KEYS))
    found = some.join(wanted, list(ROW_KEYS)).select("rep", "text")

    def make():
        return lambda batch: [pa.array([s.view(np.int64) for texts in text_chunks(batch.column("text")) for s in _sets(texts, n)], pa.list_(pa.int64()))]

    # repeated rows have one key
    return extended(found, [("shingles", T.ArrayType(T.LongType()))], make).drop("text").dropDuplicates(["rep"])


def _linked(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, b) with enough collisions whose full sets reach the threshold."""
    side = lambda table, column, x: table.select(F.col("rep").alias(x), F.col(column).alias(f"{column}_{x}"))
    counted = pairs.join(side(prefixes, "tokens", "a"), "a").join(side(prefixes, "tokens", "b"), "b")
    counted = counted.filter(F.size(F.array_intersect("tokens_a", "tokens_b")) >= matches).select("a", "b")
    both = counted.join(side(sets, "shingles", "a"), "a").join(side(sets, "shingles", "b"), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both.filter(100 * common >= percent * (F.size("shingles_a") + F.size("shingles_b") - common)).select("a", "b")


def _in_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by products of 0/1 matrices."""
    sizes = [len(s) for s in left + right]
    _, ids, counts = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    several = counts[ids] > 1
    _, ids = np.unique(ids[several], return_inverse=True)
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[several][order]
    out = np.zeros((len(left), len(right)), np.float32)
    step = 1024
    for low in range(0, int(ids.max(initial=-1)) + 1, step):
        a, b = np.searchsorted(ids, [low, low + step])
        part = np.zeros((len(sizes), step), np.float32)
        part[owner[a:b], ids[a:b] - low] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out.astype(np.int64)


def links_apart(tokens: np.ndarray, sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, matches: int, percent: int) -> list[tuple[int, int]]:
    """Links between the left (side 0) and right rows of different components: a spanning forest of them.

    Pairs with many collisions come first, and pairs that earlier ones have connected are skipped.
    """
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    counts = np.zeros((len(left), len(right)), np.uint8)
    for k in range(tokens.shape[1]):
        counts += tokens[left, k, None] == tokens[None, right, k]
    counts[label[left][:, None] == label[right][None, :]] = 0
    i, j = np.nonzero(counts >= matches)
    order = np.argsort(-counts[i, j].astype(np.int16), kind="stable")
    i, j = i[order], j[order]
    reaches = lambda both, a, b: 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
    if len(i) > 4 * (len(left) + len(right)):  # many pairs: all intersections at once
        used_i, used_j = np.unique(i), np.unique(j)
        common = _in_common([sets[k] for k in left[used_i]], [sets[k] for k in right[used_j]])
        both = common[np.searchsorted(used_i, i), np.searchsorted(used_j, j)]
        sizes = np.array([len(s) for s in sets])
        stay = 100 * both >= percent * (sizes[left[i]] + sizes[right[j]] - both)
        i, j, verified = i[stay], j[stay], True
    else:
        verified = False
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while x in parent:
            x = parent[x]
        return x

    out = []
    for a, b in zip(left[i].tolist(), right[j].tolist()):
        x, y = find(int(label[a])), find(int(label[b]))
        if x != y and (verified or reaches(len(np.intersect1d(sets[a], sets[b], assume_unique=True)), a, b)):
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _settled(spark: SparkSession, postings: DataFrame, prefixes: DataFrame, sets: DataFrame, labels: DataFrame, matches: int, percent: int, left: int, right: int) -> DataFrame:
    """Links (a, b) between components within posting lists, as far as they connect more; postings(token, rep)."""
    known = labels.select(F.col("node").alias("rep"), F.col("root").alias("label"))
    rows = postings.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("rep").alias("b")).filter("low != high").select("token", "b")
    # what unsettled lists hold together is compared once, whatever the number of its lists
    near = components(spark, postings.join(mixed, "token").selectExpr("rep as a", "b").filter("a != b"))
    members = near.select(F.col("node").alias("rep"), F.col("root").alias("g")).join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    members = staged(spark, members.join(prefixes.select("rep", "n_shingles"), "rep"), "members")
    parts = members.groupBy("g", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    sums = parts.groupBy("g").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "size", "label")).alias("most"))
    load = lambda n, size, most: F.greatest(F.ceil(n / most), F.ceil(size / (most * AVERAGE)), F.lit(1)).cast("int")
    groups = sums.select(
        "g", F.col("most.label").alias("main"), "n", "size", load(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size"), left).alias("lefts"), load(F.col("n"), F.col("size"), right).alias("rights")
    )
    small = (F.col("lefts") == 1) & (F.col("rights") == 1)
    # small ones share groups; a large one is cut into (left block, right block)
    total = groups.filter(small).agg(load(F.sum("n"), F.sum("size"), right).alias("n")).first().n or 1
    own = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_right = F.transform(every("lefts"), lambda i: F.struct(i.alias("i"), own(2, "rights").alias("j"), F.lit(1).alias("side")))
    as_left = F.transform(every("rights"), lambda j: F.struct(own(1, "lefts").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    at = F.when(F.col("label") != F.col("main"), F.concat(as_left, as_right)).otherwise(as_right)
    task = F.when(small, F.struct(F.lit(-1).cast("long").alias("c"), F.pmod(F.xxhash64("g"), F.lit(total)).cast("int").alias("i")))
    placed = members.join(groups.select("g", "main", "lefts", "rights"), "g").select("rep", "g", "label", task.alias("task"), at.alias("at"))
    full = placed.join(prefixes.select("rep", "tokens"), "rep").join(sets, "rep").withColumn("at", F.explode("at"))
    dealt = full.select(
        F.coalesce("task.c", "g").alias("c"), F.coalesce("task.i", "at.i").alias("i"), F.when(F.col("task").isNull(), F.col("at.j")).otherwise(0).alias("j"), "g", "rep", "label", "tokens", "shingles", F.col("at.side").alias("side")
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        of, side, rep, label = (group.column(c).to_numpy() for c in ("g", "side", "rep", "label"))
        tokens = group.column("tokens").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        lists = group.column("shingles").combine_chunks()
        bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        order = np.argsort(of, kind="stable")
        found = []
        for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            found += [(rep[rows[a]], rep[rows[b]]) for a, b in links_apart(tokens[rows], [sets[k] for k in rows], label[rows], side[rows], matches, percent)]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("c", "i", "j").applyInArrow(compare, "a long, b long")


def near_components(
    spark: SparkSession, docs: DataFrame, n: int = WORDS, percent: int = PERCENT, coordinates: int = COORDINATES, recall: float = RECALL, left: int = LEFT, right: int = RIGHT
) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, one row each."""
    matches = least_matches(percent, coordinates, recall)
    signed = staged(spark, signatures(docs, n, coordinates), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", *ROW_KEYS))
    reps = signed.filter("shared is not null").groupBy("shared").agg(first.alias("one"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"))
    # written with its numbers, which then hold for good
    reps = staged(spark, reps.select("shared", "one.*", "n_shingles", "tokens").drop("z").withColumn("rep", F.monotonically_increasing_id()), "reps")
    posts = reps.select("rep", F.explode("tokens").alias("token"))
    counts = posts.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    common = posts.join(counts, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("order"))
    # all but the last matches - 1 of a representative's tokens are its prefix, and those it has alone come first
    prefix = F.transform(F.slice("order", 1, F.greatest(F.size("order") - (matches - 1), F.lit(0))), lambda x: x["token"])
    prefixes = common.filter(F.size("order") >= matches).select("rep", prefix.alias("prefix")).join(reps, "rep")
    prefixes = staged(spark, prefixes, "prefixes")
    sets = staged(spark, _shingle_sets(spark, docs, prefixes.select(*ROW_KEYS, "rep"), n), "sets")
    postings = prefixes.select("rep", F.explode("prefix").alias("token"))
    pivots = postings.groupBy("token").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).filter("b != most").drop("most")
    stars = postings.join(pivots, "token").filter("rep != b").select(F.col("rep").alias("a"), "b").distinct()
    links = staged(spark, _linked(stars, prefixes, sets, matches, percent), "links")
    labels = components(spark, links)
    more = staged(spark, _settled(spark, postings, prefixes, sets, labels, matches, percent, left, right), "links")
    labels = components(spark, links.union(more))
    named = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("shared", "doc_id", F.coalesce("root", "rep").alias("root"))
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classed = named.join(ids, "root").select("shared", "component_id")
    out = signed.select("doc_id", "n_shingles", "shared").join(classed, "shared", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("shared").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op11_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document, and whether it is the one that stays."""
    rows = near_components(spark, table(spark, sf_dir, "documents"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
