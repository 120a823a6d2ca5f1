"""Removal of repeated byte strings with suffix arrays built by the difference-cover algorithm.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier (smaller doc_id, or the same
document, earlier start) is removed.

Suffixes are spread over tasks without cutting a match. Each possible string has an anchor: of the
``LENGTH - K + 1`` grams of K bytes in it, the one with the least hash (the first on a tie). Equal strings
have equal anchors at equal places, so only strings with the same anchor gram need comparing. Consecutive
starts with the same anchor are a cell; its content is what its strings cover. Then

1. a pass counts anchor grams, and a bitmap of fixed size keeps those seen twice or more (and a few more);
2. a second pass emits the cells of these. Equal contents collapse to their first occurrence before
   anything is compared, so copies cost a row each and no more;
3. different contents of an anchor gram meet in a task's group of about ``GROUP`` contents. Their strings,
   with the shared gram as one letter, get a suffix array by DC3: sort the sampled triples, recurse on
   their names, merge the remaining suffixes. Neighbours that share a full prefix are equal strings, and
   all but the earliest are marked;
4. marked starts go back to their documents.

A gram with more than ``HOT`` different contents is not gathered: its strings are grouped one by one by a
128-bit hash, which gives the same marks.

Texts are UTF-8 bytes; null is empty. A null doc_id comes after all others. Rows that share a doc_id count
as one document: equal starts in two of them are neither's copy. Matches never cross rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import extended, rows_of, staged, table
from scfsweep.llm.words import CHUNK_BYTES, mix, text_chunks

LENGTH = 100
K = 40
BITS = 26
GROUP = 8_000
HOT = 200_000

KEY = "xxhash64(doc_id, text)"

_BASE = 0x9E3779B97F4A7C15
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, for n positions."""
    if len(_tables[0]) < n:
        for j, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _tables[j] = np.multiply.accumulate(steps)
    return _tables[0][:n], _tables[1][:n]


def _window_codes(data: np.ndarray, window: int) -> np.ndarray:
    """For every start a random number of the ``window`` bytes there.

    Summed with powers, numbers of single bytes make strings of some structures collide, since the modulus
    is a power of two; numbers of windows follow no such structure.
    """
    count = max(len(data) - window + 1, 0)
    codes = np.zeros(count, np.uint64)
    for j in range(window):
        codes = (codes << np.uint64(8)) | data[j : j + count]
    return mix(mix((codes + np.uint64(1)) * np.uint64(_BASE)))


class Anchors:
    """Cells of the rows of a chunk: row, first and last start, anchor position, gram hash."""

    def __init__(self, texts, length: int, k: int):
        n, self.window = len(texts.data), min(k, 8)
        codes = _window_codes(texts.data, self.window)
        power, self.inverse = _powers(n + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * power[: len(codes)], out=self.sums[1:])
        starts = n - length + 1
        if starts <= 0:
            self.first = self.last = self.at = self.row = np.zeros(0, np.int64)
            self.gram = np.zeros(0, np.uint64)
            return
        gram = self.hash(np.arange(n - k + 1), np.arange(k, n + 1))
        value, at, span, width = gram, np.arange(len(gram), dtype=np.int32), 1, length - k + 1
        while span < width:
            step = min(span, width - span)
            later = value[step:] < value[:-step]
            at = np.where(later, at[step:], at[:-step])
            value = np.where(later, value[step:], value[:-step])
            span += step
        ends = np.repeat(texts.offsets[1:], np.diff(texts.offsets))
        valid = np.flatnonzero(np.arange(starts) + length <= ends[:starts])
        at = at[valid].astype(np.int64)
        begin = np.flatnonzero(np.append(True, (np.diff(at) != 0) | (np.diff(valid) != 1))) if len(at) else np.zeros(0, np.int64)
        self.first = valid[begin]
        self.last = valid[np.append(begin[1:], len(valid)) - 1] if len(at) else self.first
        self.at = at[begin]
        self.gram = gram[self.at]
        self.row = np.searchsorted(texts.offsets, self.first, "right") - 1

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of strings of k bytes or more."""
        return mix((self.sums[end - self.window + 1] - self.sums[start]) * self.inverse[start])


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """data[start:start + size] of all, end to end, and where each begins."""
    bounds = np.append(0, np.cumsum(size))
    return data[np.repeat(start - bounds[:-1], size) + np.arange(bounds[-1])], bounds


def _binary(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def repeated_grams(docs: DataFrame, length: int, k: int) -> np.ndarray:
    """A bitmap of 2 ** BITS bits that holds every anchor gram with two cells or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch.column("text")):
                gram, n = np.unique(Anchors(texts, length, k).gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((gram >> np.uint64(16)).astype(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], ["gram", "n"])

    grams = docs.select("text").mapInArrow(run, "gram long, n int")
    twice = grams.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1")
    # 2 ** (BITS - 6) rows at most
    slots = twice.selectExpr(f"gram & {(1 << BITS) - 1} as slot").groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    found = slots.toArrow()
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bitmap


_CELL = "key long, doc_id long, a int, n int, u int, gram long, content long, bytes binary"


def cells(spark: SparkSession, docs: DataFrame, bitmap: np.ndarray, length: int, k: int) -> DataFrame:
    """Cells whose gram is in the bitmap: document, first start a, number of starts n, bytes before the gram u,
    hash of the content. The first with some content in a batch also holds its bytes, without the gram."""
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            order = np.argsort(np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))))
            keys, parts = batch.column("key").to_numpy(), []
            for texts in text_chunks(batch.column("text")):
                c = Anchors(texts, length, k)
                slot = (c.gram >> np.uint64(16)) & np.uint64((1 << BITS) - 1)
                some = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                first, last, at = c.first[some], c.last[some], c.at[some]
                content = mix(c.hash(first, last + length) + (at - first).astype(np.uint64)) ^ c.gram[some]
                left, lb = _slices(texts.data, first, at - first)
                right, rb = _slices(texts.data, at + k, last + length - at - k)
                parts.append((texts.first + c.row[some], first - texts.offsets[c.row[some]], last - first + 1, at - first, c.gram[some], content, left, np.diff(lb), right, np.diff(rb)))
            if not parts:
                continue
            row, a, n, u, gram, content, left, ln, right, rn = (np.concatenate(x) for x in zip(*parts))
            ranked = np.lexsort((a, order[row]))
            _, one = np.unique(content[ranked], return_index=True)
            chosen = np.zeros(len(row), bool)
            chosen[ranked[one]] = True
            both = np.concatenate([left, right])
            lb, rb = np.append(0, np.cumsum(ln))[:-1], np.append(0, np.cumsum(rn))[:-1] + len(left)
            # the bytes are put together piece by piece: their places take eight times their room
            for low in range(0, len(row), 1 << 14):
                part = slice(low, low + (1 << 14))
                taken = chosen[part]
                sizes = np.column_stack([ln[part], rn[part]]) * taken[:, None]
                flat, _ = _slices(both, np.column_stack([lb[part], rb[part]]).ravel(), sizes.ravel())
                binary = pa.compute.if_else(pa.array(taken), _binary(flat, np.append(0, np.cumsum(sizes.sum(axis=1)))), pa.scalar(None, pa.binary()))
                numbers = [x[part].astype(np.int32) for x in (a, n, u)] + [x[part].view(np.int64) for x in (gram, content)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row[part]]), ids.take(pa.array(row[part])), *map(pa.array, numbers), binary],
                    ["key", "doc_id", "a", "n", "u", "gram", "content", "bytes"],
                )

    return docs.selectExpr("doc_id", "text", f"{KEY} as key").mapInArrow(run, _CELL)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """DC3: the order of all suffixes of s, whose letters are at least 1."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.append(s.astype(np.int64), [0, 0, 0])
    # a sampled position past the end, where needed, keeps the two halves of the sample apart
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n + 1, 3)[: len(np.arange(2, n, 3))]])
    base = int(t.max()) + 1
    if base < 1 << 21:
        names = np.unique((t[sample] * base + t[sample + 1]) * base + t[sample + 2], return_inverse=True)[1]
    else:
        pairs = np.unique(t[sample] * base + t[sample + 1], return_inverse=True)[1]
        names = np.unique(pairs * base + t[sample + 2], return_inverse=True)[1]
    names = names + 1
    if names.max() == len(sample):
        order = np.argsort(names)
    else:
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    size = len(rank) + 1
    rest = rest[np.argsort(t[rest] * size + rank[rest + 1])]
    # how many sampled suffixes are less: those at 1 mod 3 by one letter and a rank, those at 2 by two letters
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    less = np.searchsorted(t[ones] * size + rank[ones + 1], t[rest] * size + rank[rest + 1])
    pair = lambda i: t[i] * base + t[i + 1]
    _, where = np.unique(np.concatenate([pair(twos), pair(rest)]), return_inverse=True)
    less = less + np.searchsorted(where[: len(twos)] * size + rank[twos + 2], where[len(twos) :] * size + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = less + np.arange(len(rest))
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = sampled
    return out


def equal_starts(lefts: list[bytes], rights: list[bytes], grams: np.ndarray, counts: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(content, start, class) of all starts; equal classes are equal strings of ``letters`` letters."""
    sizes = np.array([len(a) + 1 + len(b) for a, b in zip(lefts, rights)])
    begin = np.append(0, np.cumsum(sizes))
    s = np.empty(begin[-1] + letters, np.int64)
    s[-letters:] = 1
    raw = np.frombuffer(b"".join(x for a, b in zip(lefts, rights) for x in (a, b"\0", b)), np.uint8)
    s[: begin[-1]] = raw.astype(np.int64) + 2
    middle = begin[:-1] + np.array([len(a) for a in lefts])
    s[middle] = 258 + np.unique(grams, return_inverse=True)[1]
    which = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(which)) - np.repeat(np.append(0, np.cumsum(counts))[:-1], counts)
    number = np.full(len(s), -1)
    number[begin[which] + start] = np.arange(len(which))
    order = suffix_array(s)
    order = order[number[order] >= 0]
    new = np.ones(len(order), bool)
    for low in range(1, len(order), 1 << 15):
        a, b = order[low - 1 : low - 1 + (1 << 15)], order[low : low + (1 << 15)]
        a = a[: len(b)]
        same = np.ones(len(b), bool)
        for k in range(letters):
            same &= s[a + k] == s[b + k]
        new[low : low + len(b)] = ~same
    classes = np.empty(len(which), np.int64)
    classes[number[order]] = np.cumsum(new)
    return which, start, classes


_VERDICT = "gram long, content long, one_id long, one_null boolean, one_a int, runs array<struct<s: int, e: int>>"


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"s": int(a), "e": int(b)} for a, b in edges.reshape(-1, 2)]


def _verdicts(group: pa.Table, length: int, k: int) -> pa.Table:
    """Per content its first occurrence, and which of that one's starts are repeats of other contents'."""
    group = group.combine_chunks()
    null = group.column("doc_id").is_null().to_numpy().astype(np.int8)
    ids, a = group.column("doc_id").fill_null(0).to_numpy(), group.column("a").to_numpy()
    order = np.lexsort((a, ids, null))
    content = group.column("content").to_numpy()
    first = order[np.unique(content[order], return_index=True)[1]]
    gram = group.column("gram").to_numpy()[first]
    content, null, ids, a = content[first], null[first], ids[first], a[first].astype(np.int64)
    counts, u = group.column("n").to_numpy()[first], group.column("u").to_numpy()[first].tolist()
    marks: list[list] = [[] for _ in first]
    _, which, several = np.unique(gram, return_inverse=True, return_counts=True)
    many = np.flatnonzero(several[which] > 1)
    if len(many):
        raw = group.column("bytes").take(pa.array(first[many])).to_pylist()
        lefts = [x[: u[r]] for x, r in zip(raw, many)]
        rights = [x[u[r] :] for x, r in zip(raw, many)]
        at, start, classes = equal_starts(lefts, rights, gram[many], counts[many], length - k + 1)
        row = many[at]
        place = a[row] + start
        order = np.lexsort((place, ids[row], null[row], classes))
        head = order[np.append(0, np.flatnonzero(np.diff(classes[order])) + 1)]
        least = head[classes - 1]
        late = (null[row] != null[row[least]]) | (ids[row] != ids[row[least]]) | (place != place[least])
        bounds = np.append(0, np.cumsum(counts[many]))
        for k_, r in enumerate(many.tolist()):
            flags = late[bounds[k_] : bounds[k_ + 1]]
            if flags.any():
                marks[r] = _runs(flags)
    runs = pa.array(marks, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))
    return pa.table({"gram": gram, "content": content, "one_id": ids, "one_null": null.astype(bool), "one_a": a.astype(np.int32), "runs": runs})


def _hot_strings(length: int, k: int):
    """Cells with bytes -> a row per start, with a hash of its string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"gram": [], "content": [], "doc_id": [], "place": [], "start": [], "string": []}
            for r in batch.to_pylist():
                for t in range(r["n"]):
                    o = r["u"] - t
                    string = r["bytes"][t : r["u"]] + b"|" + r["bytes"][r["u"] : r["u"] + length - k - o]
                    digest = hashlib.blake2b(b"%d:%d:" % (r["gram"], o) + string, digest_size=16).digest()
                    for name, v in zip(rows, (r["gram"], r["content"], r["doc_id"], r["a"] + t, t, digest)):
                        rows[name].append(v)
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("start", pa.int32()), ("string", pa.binary())]))

    return run


def _hot_verdicts(contents: DataFrame, length: int, k: int) -> DataFrame:
    """The same verdicts for grams with very many contents, by grouping strings one by one."""
    at = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "place")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "a")).alias("one")
    firsts = contents.groupBy("gram", "content").agg(one, F.first("n").alias("n"), F.first("u").alias("u"), F.first("bytes").alias("bytes"))
    firsts = firsts.select("gram", "content", F.col("one.doc_id").alias("doc_id"), F.col("one.a").alias("a"), "n", "u", "bytes")
    strings = firsts.mapInArrow(_hot_strings(length, k), "gram long, content long, doc_id long, place int, start int, string binary")
    least = strings.groupBy("string").agg(F.min(at).alias("least"))
    late = strings.join(least, "string").filter(at != F.col("least")).groupBy("gram", "content").agg(
        F.collect_list(F.struct(F.col("start").alias("s"), (F.col("start") + 1).alias("e"))).alias("runs")
    )
    every = firsts.select("gram", "content", F.coalesce("doc_id", F.lit(0)).alias("one_id"), F.col("doc_id").isNull().alias("one_null"), F.col("a").alias("one_a"))
    return every.join(late, ["gram", "content"], "left").withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<s: int, e: int>>")))


def _cut(length: int):
    """text and marked runs of starts -> bytes removed, runs of removed bytes, sha256 of what is left."""

    def make():
        def compute(batch):
            removed, spans, digests = [], [], []
            runs = batch.column("runs").to_pylist()
            for texts in text_chunks(batch.column("text")):
                for row in range(len(texts)):
                    data = texts.data[texts.offsets[row] : texts.offsets[row + 1]]
                    keep = np.ones(len(data), bool)
                    for r in runs[texts.first + row]:
                        keep[r["s"] : r["e"] + length - 1] = False
                    removed.append(len(data) - int(keep.sum()))
                    spans.append(len(_runs(~keep)))
                    digests.append(hashlib.sha256(data[keep].tobytes()).hexdigest())
            return [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]

        return compute

    return make


def repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, k: int = K, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row each."""
    if not 0 < k < length:
        raise ValueError("k must be below length")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = staged(spark, cells(spark, docs, repeated_grams(docs, length, k), length, k), "cells")
    contents = found.filter("bytes is not null")
    crowds = contents.groupBy("gram").agg(F.count("*").alias("c")).filter(f"c > {hot}").select("gram")
    crowds = staged(spark, crowds, "crowds")
    groups = max(1, -(-contents.count() // group))
    few = contents.join(crowds, "gram", "left_anti") if crowds.limit(1).count() else contents
    named = few.drop("key").withColumn("g", F.expr(f"pmod(xxhash64(gram), {groups})"))
    verdicts = named.groupBy("g").applyInArrow(lambda t: _verdicts(t, length, k), _VERDICT)
    if crowds.limit(1).count():
        verdicts = verdicts.unionByName(_hot_verdicts(contents.join(crowds, "gram", "left_semi"), length, k))
    lean = found.select("key", F.col("doc_id"), "a", "n", "gram", "content")
    judged = lean.join(verdicts, ["gram", "content"])
    first = (F.col("doc_id").isNull() == F.col("one_null")) & (F.coalesce("doc_id", F.lit(0)) == F.col("one_id")) & (F.col("a") == F.col("one_a"))
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    runs = judged.select("key", "a", F.when(first, F.col("runs")).otherwise(whole).alias("runs")).filter(F.size("runs") > 0)
    moved = F.transform("runs", lambda r: F.struct((r["s"] + F.col("a")).alias("s"), (r["e"] + F.col("a")).alias("e")))
    marked = staged(spark, runs.select("key", moved.alias("runs")).groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("runs")), "marked")
    keyed = docs.selectExpr("doc_id", "text", f"{KEY} as key")
    texts = rows_of(spark, keyed.select("key", "text"), marked, "key").dropDuplicates(["key"]).join(marked, "key")
    fields = [("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.StringType())]
    cut = staged(spark, extended(texts, fields, _cut(length)).select("key", "n_removed", "n_spans", "kept"), "cut")
    text = F.coalesce("text", F.lit(""))
    lean = keyed.select("doc_id", "key", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("own"))
    zero = F.lit(0).cast("long")
    return lean.join(cut, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept", "own").alias("kept_sha256")
    )


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes in all documents."""
    return repeats(spark, table(spark, sf_dir, "documents"))
