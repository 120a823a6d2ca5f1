"""Benchmark decontamination by winnowing.

Every k words have a hash. Of each window of w neighbouring hashes the least is a fingerprint (on a tie the
one that an earlier window has chosen, else the last), so two texts that share w + k - 1 words in a row share a fingerprint at the same place of
that span. Fingerprints of both tables are joined; each pair is extended, word by word, as far as the
texts agree within reach of the span, which settles it exactly. An item shorter than a span is a
fingerprint itself and is looked for at its own length. Fingerprints with equal words around them collapse
before the join, in a document to one with its places and in the benchmark to one with its items, so a word
repeated n times or a passage of n items costs no n * n rows.

Documents far outnumber items, so a bitmap of the items' hashes (a fixed number of slots, whatever the
size of the benchmark) drops most document fingerprints before the join. It only ever lets too many pass.

Null or empty texts have no words; an item without words matches nothing; a null item_id is found but
not listed; repeated rows are judged each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import ROW, ROW_KEYS, extended, staged, table, with_row_keys, without
from scfsweep.llm.words import ALNUM, LOWER, Words, find_words, ngrams, text_chunks

SPAN = 10
K = 5
SLOTS = 1 << 22

_HIT = T.StructType(
    [
        T.StructField("n", T.IntegerType()),
        T.StructField("fp", T.LongType()),
        T.StructField("pos", T.ArrayType(T.IntegerType())),
        T.StructField("mid", T.StringType()),
        T.StructField("left", T.ArrayType(T.StringType())),
        T.StructField("right", T.ArrayType(T.StringType())),
    ]
)


def winnow(words: Words, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and hash of each row's fingerprints."""
    first, hashes = ngrams(words, k)
    if not len(first):
        return first, hashes
    full = np.full(len(words.hashes), np.iinfo(np.uint64).max)
    full[first] = hashes
    begin = np.flatnonzero(np.arange(len(full)) + w + k - 1 <= words.last)
    least, last = full[begin], begin.copy()
    for j in range(1, w):
        other = full[begin + j]
        lower = other <= least
        last[lower] = begin[lower] + j
        least = np.minimum(least, other)
    # robust winnowing: of equal hashes keep the one chosen before as long as windows hold it
    at = last.copy()
    for i in np.flatnonzero((np.diff(last) != 0) & (np.diff(least.view(np.int64)) == 0) & (np.diff(begin) == 1)) + 1 if len(last) else ():
        if at[i - 1] >= begin[i]:
            at[i] = at[i - 1]
    chosen = np.zeros(len(full), bool)
    chosen[at] = True
    at = np.flatnonzero(chosen)
    return at, full[at]


def _hits(words: Words, text: bytes, rows: np.ndarray, n: int, at: np.ndarray, hashes: np.ndarray, k: int, reach: int) -> list:
    """(row, hit) for each fingerprint: its words, up to ``reach`` words on either side, and all its places in the row."""
    out, known = [], {}
    for p, h in zip(at.tolist(), hashes.view(np.int64).tolist()):
        row = int(rows[p])
        low, high = int(words.bounds[row]), int(words.bounds[row + 1])
        a, b = max(low, p - reach), min(high, p + k + reach)
        got = [text[s:e].decode("utf-8", "replace") for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist())]
        m = p - a
        same = (row, m, " ".join(got))
        if same in known:
            known[same].append(p - low)
            continue
        known[same] = [p - low]
        out.append((row, {"n": n, "fp": h, "pos": known[same], "mid": " ".join(got[m : m + k]), "left": got[:m][::-1], "right": got[m + k :]}))
    return out


def _finder(span: int, k: int, lengths: list[int] | None, slots: np.ndarray | None):
    """A function of a text column: (n_words, hits) per row. With lengths None the rows are items."""
    w = span - k + 1

    def find(column: pa.Array) -> tuple[list, list]:
        counts, found = [], []
        for texts in text_chunks(column):
            words = find_words(texts, ALNUM, lower=True)
            rows, n_words = words.rows, words.counts
            picks = [(0, k, span - k, *winnow(words, k, w))]
            for n in range(1, span) if lengths is None else lengths:
                at, hashes = ngrams(words, n)
                if lengths is None:
                    whole = n_words[rows[at]] == n
                    at, hashes = at[whole], hashes[whole]
                picks.append((n, n, 0, at, hashes))
            hits = [[] for _ in range(len(texts))]
            text = None
            for n, size, reach, at, hashes in picks:
                if slots is not None:
                    near = slots[(hashes % np.uint64(len(slots))).astype(np.int64)]
                    at, hashes = at[near], hashes[near]
                if len(at):
                    text = text or LOWER[texts.data].tobytes()
                    for row, hit in _hits(words, text, rows, n, at, hashes, size, reach):
                        hits[row].append(hit)
            counts += n_words.tolist()
            found += hits
        return counts, found

    return find


def _with_hits(df: DataFrame, span: int, k: int, lengths, slots, number_rows: bool) -> DataFrame:
    hit_type = pa.list_(
        pa.struct([("n", pa.int32()), ("fp", pa.int64()), ("pos", pa.list_(pa.int32())), ("mid", pa.string()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])
    )

    def make():
        find = _finder(span, k, lengths, slots.value if slots is not None else None)

        def compute(batch):
            counts, hits = find(batch.column("text"))
            return [pa.array(counts, pa.int64()), pa.array(hits, hit_type)]

        return compute

    return extended(df, [("n_words", T.LongType()), ("hits", T.ArrayType(_HIT))], make, number_rows)


def _equal_ahead(ours: str, theirs: str) -> str:
    """SQL: how many leading words of two arrays agree."""
    return (
        f"aggregate(zip_with({ours}, {theirs}, (x, y) -> coalesce(x = y, false)), named_struct('n', 0, 'on', true), "
        "(s, e) -> named_struct('n', s.n + if(s.on and e, 1, 0), 'on', s.on and e), s -> s.n)"
    )


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_hit, items: array<string>) per row of docs(doc_id, text), against items(item_id, text).

    A word is hit when it lies in ``span`` words in a row that an item has too, or in a whole shorter item.
    docs' columns ``keep`` stay.
    """
    if not 0 < k <= span:
        raise ValueError("k must lie between 1 and span")
    found = _with_hits(items.select("item_id", "text"), span, k, None, None, False).select("item_id", F.explode("hits").alias("h"))
    context = ("n", "fp", "mid", "left", "right")
    marks = staged(spark, with_row_keys(found.select("item_id", *[F.col(f"h.{c}").alias(c) for c in context]), *context), "marks")
    contexts = marks.dropDuplicates(list(ROW_KEYS)).select(F.struct(*context).alias("h"), *[F.col(c).alias(f"of{c}") for c in ROW_KEYS])
    slots = np.zeros(SLOTS, bool)
    # SLOTS numbers at most, whatever the benchmark holds
    taken = marks.selectExpr(f"cast(pmod(fp, {SLOTS}) as int) as slot").distinct().toArrow()["slot"]
    slots[taken.to_numpy()] = True
    lengths = sorted(r.n for r in marks.filter("n > 0").select("n").distinct().collect())
    shared = spark.sparkContext.broadcast(slots)
    found = staged(spark, _with_hits(docs.select("doc_id", "text", *keep), span, k, lengths, shared, True).drop("text"), "fingerprints")
    ours = found.select(ROW, F.explode("hits").alias("d"))
    both = ours.join(contexts, (F.col("d.n") == F.col("h.n")) & (F.col("d.fp") == F.col("h.fp")) & (F.col("d.mid") == F.col("h.mid")))
    spread = both.selectExpr(
        ROW,
        *[f"of{c}" for c in ROW_KEYS],
        "d.n as n",
        "d.pos as pos",
        f"if(d.n > 0, d.n, {k}) as size",
        f"{_equal_ahead('d.left', 'h.left')} as l",
        f"{_equal_ahead('d.right', 'h.right')} as r",
        "d.n > 0 as whole",
    ).filter(F.col("whole") | (F.col("l") + F.col("r") + k >= span))
    # all spans at a place hold its fingerprint, so together they are one run of words
    places = spread.groupBy(ROW, "n", "pos").agg(F.max("l").alias("l"), F.max(F.expr("size + r")).alias("r"))
    runs = F.transform("pos", lambda p: F.struct((p - F.col("l")).alias("a"), (p + F.col("r")).alias("b")))
    per_doc = places.groupBy(ROW).agg(F.array_sort(F.flatten(F.collect_list(runs))).alias("runs"))
    named = spread.select(ROW, *[F.col(f"of{c}").alias(c) for c in ROW_KEYS]).distinct().join(marks.select("item_id", *ROW_KEYS).distinct(), list(ROW_KEYS))
    ids = named.groupBy(ROW).agg(F.collect_set("item_id").alias("ids"))
    n_hit = F.expr(
        "aggregate(runs, named_struct('n', 0L, 'to', 0), (s, x) -> named_struct('n', s.n + greatest(0, x.b - greatest(x.a, s.to)), "
        "'to', greatest(s.to, x.b)), s -> s.n)"
    )
    per_doc = per_doc.join(ids, ROW).select(ROW, n_hit.alias("n_hit"), F.transform("ids", lambda i: i.cast("string")).alias("items"))
    return found.drop("hits").join(per_doc, ROW, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), ROW, *keep
    )


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    rows = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows that hold a benchmark span; all columns stay."""
    keyed = with_row_keys(docs, "text")  # which alone decides
    bad = contamination(spark, keyed, table(spark, sf_dir, "benchmark"), keep=ROW_KEYS).filter("n_hit > 0")
    return without(keyed, bad)
