"""Vector code compression: integer product codes whose assignments are kept by adaptive distance bounds.

Vectors become integers (floor of ``SCALE`` times a component) and are cut into ``PARTS`` parts; each part
position has a codebook of ``ENTRIES`` entries. A round assigns every part to its nearest entry and then
moves each entry to the floored mean of its parts. All distances that decide are exact integers.

Bounds spare most distances (Drake and Hamerly). With every part stay its b closest entries, nearest first,
a lower bound on the distance to each, and one outer bound for all other entries. When entries move, a bound
shrinks by the way its entry went, the outer one by the longest way of any. A round then computes the
distance to the assigned entry, to those of the b whose bound does not exceed it (by integers, so ties go to
the lower index), and to all entries only where the outer bound fails. How many of the b were needed is
counted, and b shrinks to what nearly all parts need; bounds cut off join the outer one.

Vectors and bounds are written to the shared folder after every round, so a lost executor costs a retry of
its tasks. A task adds up its parts per entry and writes those sums beside its rows: ``PARTS * ENTRIES``
short rows a task, summed by Spark. The driver holds codebooks only.

Dropped are null vectors, those with null or non-finite components, and those that can't be cut like the
kept vector of the least vec_id (another length, or none that ``PARTS`` divides). Null ids come last and may
name no first entry before others do; repeated rows are rows of their own; a null label is a label. Fewer
vectors than ``ENTRIES`` make as many entries. Components beyond 2**28 after scaling raise an error, since
their squares don't fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import staged, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Closest entries that are kept at first, and at least
KEPT, LEAST_KEPT = 16, 3
#: The share of parts whose needs b has to cover
COVERED = 0.99
LARGEST = 1 << 28
BLOCK = 4096
#: Bounds are floats: what lies so near, relatively, is settled by integers
MARGIN = 1e-9

_STATE = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("label", T.LongType()),
        T.StructField("q", T.BinaryType()),  # int32 components; null in rows of sums
        T.StructField("ids", T.BinaryType()),  # PARTS x b entries, the assigned one first
        T.StructField("low", T.BinaryType()),  # PARTS x b bounds and then PARTS outer bounds
        T.StructField("codes", T.ArrayType(T.IntegerType())),
        T.StructField("errors", T.ArrayType(T.LongType())),
        T.StructField("entry", T.IntegerType()),  # part * ENTRIES + entry, in rows of sums; -1: how many needed how much
        T.StructField("count", T.LongType()),
        T.StructField("sums", T.ArrayType(T.LongType())),
    ]
)
_ARROW = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("label", pa.int64()),
        ("q", pa.binary()),
        ("ids", pa.binary()),
        ("low", pa.binary()),
        ("codes", pa.list_(pa.int32())),
        ("errors", pa.list_(pa.int64())),
        ("entry", pa.int32()),
        ("count", pa.int64()),
        ("sums", pa.list_(pa.int64())),
    ]
)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of x to every entry, all int64."""
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:  # whole numbers that doubles hold
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        out += (x[:, k, None] - entries[None, :, k]) ** 2
    return out


def search(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(b closest entries, their distances, outer distance, squared distance of the nearest) per row; ties to the lower index."""
    d2 = squared(x, entries)
    rows = np.arange(len(x))
    nearest = d2.argmin(1)
    best = d2[rows, nearest]
    order = d2.copy()
    order[rows, nearest] = -1
    some = min(b, len(entries))
    if some < len(entries):
        ids = np.argpartition(order, some, axis=1)[:, : some + 1]
    else:
        ids = np.broadcast_to(np.arange(len(entries)), d2.shape)
    ids = np.take_along_axis(ids, np.argsort(np.take_along_axis(order, ids, 1), axis=1, kind="stable"), 1)
    near = np.sqrt(np.take_along_axis(d2, ids, 1).astype(np.float64))
    outer = near[:, some] if ids.shape[1] > some else np.full(len(x), np.inf)
    return ids[:, :some], near[:, :some], outer, best


def reassign(x, entries, moved, ids, low, outer):
    """One round for the parts x: new (ids, low, outer, squared distance), and how many kept entries each needed (-1: all)."""
    low = low - moved[ids]
    outer = outer - moved.max(initial=0.0)
    rows = np.arange(len(x))
    best = ((x - entries[ids[:, 0]]) ** 2).sum(1)
    now = np.sqrt(best.astype(np.float64))
    limit = now * (1 + MARGIN) + MARGIN
    low[:, 0] = now
    near = low <= limit[:, None]
    near[:, 0] = False
    whole = outer <= limit
    near &= ~whole[:, None]
    at, j = np.nonzero(near)
    d2 = ((x[at] - entries[ids[at, j]]) ** 2).sum(1)
    low[at, j] = np.sqrt(d2.astype(np.float64))
    exact = np.full(ids.shape, np.iinfo(np.int64).max)
    exact[:, 0] = best
    exact[at, j] = d2
    best = exact.min(1)
    # the lowest index among the nearest ones
    nearest = np.where(exact == best[:, None], ids, len(entries)).min(1)
    place = (ids == nearest[:, None]).argmax(1)
    low[rows, place] = -1
    order = np.argsort(low, axis=1, kind="stable")
    ids, low = np.take_along_axis(ids, order, 1), np.take_along_axis(low, order, 1)
    low[:, 0] = np.sqrt(best.astype(np.float64))
    needed = near.sum(1)
    if whole.any():
        ids[whole], low[whole], outer[whole], best[whole] = search(x[whole], entries, ids.shape[1])
        needed[whole] = -1
    return ids, low, outer, best, needed


def _assign(rows: DataFrame, codebooks: np.ndarray, moved: np.ndarray | None, b: int) -> DataFrame:
    """rows with new codes, errors and bounds, and rows with each task's sums per entry and needs."""
    shared = rows.sparkSession.sparkContext.broadcast((codebooks, moved))  # PARTS x ENTRIES entries
    parts, entries, width = codebooks.shape
    b = min(b, entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, ways = shared.value
        sums, counts, needs = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64), np.zeros(entries + 2, np.int64)
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                n = batch.num_rows
                q = np.frombuffer(b"".join(batch.column("q").to_pylist()), np.int32).reshape(n, parts, width).astype(np.int64)
                ids, low, outer, errors = np.zeros((n, parts, b), np.uint8), np.zeros((n, parts, b)), np.zeros((n, parts)), np.zeros((n, parts), np.int64)
                if ways is not None:
                    old_ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.uint8).reshape(n, parts, -1).astype(np.int64)
                    bounds = np.frombuffer(b"".join(batch.column("low").to_pylist())).reshape(n, parts, -1)
                for p in range(parts):
                    x = q[:, p]
                    if ways is None:
                        new_ids, new_low, outer[:, p], errors[:, p] = search(x, books[p], b)
                    else:
                        # bounds beyond the b that are kept now join the outer one
                        cut = np.minimum(bounds[:, p, -1], (bounds[:, p, b:-1] - ways[p][old_ids[:, p, b:]]).min(1, initial=np.inf) + ways[p].max(initial=0.0))
                        new_ids, new_low, outer[:, p], errors[:, p], needed = reassign(x, books[p], ways[p], old_ids[:, p, :b], bounds[:, p, :b], cut)
                        needs += np.bincount(needed + 1, minlength=len(needs))
                    ids[:, p], low[:, p] = new_ids, new_low
                    np.add.at(sums[p], ids[:, p, 0], x)
                    counts[p] += np.bincount(ids[:, p, 0], minlength=entries)
                kept = np.concatenate([low, outer[:, :, None]], 2)
                blank = pa.nulls(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"), batch.column("label"), batch.column("q"), pa.array([r.tobytes() for r in ids], pa.binary()),
                        pa.array([r.tobytes() for r in kept], pa.binary()), pa.array(list(ids[:, :, 0].astype(np.int32)), _ARROW.field("codes").type),
                        pa.array(list(errors), _ARROW.field("errors").type), blank.cast(pa.int32()), blank.cast(pa.int64()), blank.cast(_ARROW.field("sums").type),
                    ],
                    schema=_ARROW,
                )
        used = np.argwhere(counts)
        entry = [-1, *(used[:, 0] * ENTRIES + used[:, 1]).tolist()]
        blank = pa.nulls(len(entry))
        number = pa.array([0, *counts[used[:, 0], used[:, 1]].tolist()], pa.int64())
        total = pa.array([needs, *sums[used[:, 0], used[:, 1]]], _ARROW.field("sums").type)
        yield pa.RecordBatch.from_arrays([*[blank.cast(f.type) for f in _ARROW][:7], pa.array(entry, pa.int32()), number, total], schema=_ARROW)

    return rows.mapInArrow(run, _STATE)


def _totals(state: DataFrame) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Counts and summed components of every entry, -1 standing for the needs; PARTS * ENTRIES short rows."""
    each = state.filter("entry is not null").select("entry", "count", F.posexplode("sums").alias("k", "x"))
    # a task's count stands beside every component
    found = each.groupBy("entry", "k").agg(F.sum("x").alias("x"), F.sum("count").alias("n")).toArrow().to_pydict()
    counts, sums = {}, {}
    for entry, k, x, n in sorted(zip(found["entry"], found["k"], found["x"], found["n"])):
        counts[entry] = n
        sums.setdefault(entry, []).append(x)
    return counts, sums


def _enough(needs: list[int], b: int) -> int:
    """How many entries to keep so that COVERED of the parts that kept ones settled find theirs among them."""
    settled = np.cumsum(needs[1:])
    if not len(settled) or not settled[-1]:
        return b
    return min(b, max(LEAST_KEPT, int(np.searchsorted(settled, COVERED * settled[-1])) + 2))


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vectors(vec_id, embedding, label) -> vec_id, label, v: floored components of the rows that can be coded."""
    sound = F.col("embedding").isNotNull() & F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('infinity'))")
    cut = (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0)
    floors = F.expr(f"transform(embedding, x -> floor({SCALE} * cast(x as double)))")
    return vectors.filter(sound & cut).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), floors.alias("v"))


def _packed(ints: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(v, np.int64) for v in batch.column("v").to_pylist()]
            if any(r.max() > LARGEST or r.min() < -LARGEST for r in rows):
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            q = pa.array([r.astype(np.int32).tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), q], ["vec_id", "label", "q"])

    return ints.filter(F.size("v") == width).mapInArrow(run, "vec_id long, label long, q binary")


def coded(spark: SparkSession, vectors: DataFrame, rounds: int = ROUNDS, kept: int = KEPT) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, errors: both per part) of every vector that can be coded, and the final codebooks."""
    ints = integer_vectors(vectors)
    firsts = ints.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    if not firsts:
        return spark.createDataFrame([], "vec_id long, label long, codes array<int>, errors array<long>"), np.zeros((PARTS, 0, 0), np.int64)
    width = len(firsts[0].v)
    rows = staged(spark, _packed(ints, width), "vectors")
    # ties in vec_id go by content, so that reruns agree
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(ENTRIES).toArrow().column("q").to_pylist()
    books = np.stack([np.frombuffer(q, np.int32).reshape(PARTS, -1) for q in start], 1).astype(np.int64)
    moved, b = None, kept
    for number in range(rounds + 1):
        state = staged(spark, _assign(rows, books, moved, b), "assigned")
        rows = state.filter("entry is null")
        if number == rounds:
            return rows.select("vec_id", "label", "codes", "errors"), books
        counts, sums = _totals(state)
        if moved is not None:
            b = _enough(sums[-1], b)
        after = books.copy()
        for entry, total in sums.items():
            if entry >= 0:
                after[entry // ENTRIES, entry % ENTRIES] = [x // counts[entry] for x in total]
        ways = ((after - books) ** 2).sum(2)
        moved = np.sqrt(ways.astype(np.float64)) * (1 + MARGIN)
        books = after
    raise AssertionError


def codebooks_digest(books: np.ndarray) -> str:
    """sha256 of all components, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op13_bounded_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors."""
    rows, books = coded(spark, table(spark, sf_dir, "embeddings"))
    one = rows.select("vec_id", "label", F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"), F.expr("aggregate(errors, 0L, (s, e) -> s + e)").alias("error"))
    by_label = one.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    joined = one.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
