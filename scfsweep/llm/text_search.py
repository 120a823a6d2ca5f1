"""Ranked lexical search by one Aho-Corasick scan of the documents, without an index of them.

All terms of all items form one automaton that goes to every task. Text bytes that are no part of a term
become one guard character, every term stands between two guards, and neighbouring terms share theirs: so
a match is always a whole term, and a scan yields the term frequencies of a document straight from its
text. What it found, (document, length, terms, frequencies), is written once and read twice: to count the
documents of each term, and to score. Outputs of the automaton map to the items that ask for the term.

Scores are whole numbers. A task keeps the ``TOP`` best documents of each item while it reads, so that
so many rows an item reach the shuffle from every task and never more.

Automata are bounded: items whose terms together take more than ``MAX_TERM_BYTES`` are dealt to groups by
a hash, and every group has an automaton and a scan of its own.

Null texts have no terms; they count for nothing. An item without terms finds nothing; an item that stands
there twice is answered twice. Null ids come last among equal scores, and equal ids in any order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import extended, staged, table
from scfsweep.llm.words import ALNUM, LOWER, find_runs, text_chunks

TOP = 20
#: Bytes of terms in one automaton, which takes some fifty times as much memory
MAX_TERM_BYTES = 1 << 21
#: Document-item additions at a time
BLOCK = 1 << 20

TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = ord(" ")
_GUARDED = np.where(ALNUM[LOWER], LOWER, _GUARD).astype(np.uint8)


def item_terms(items: DataFrame) -> DataFrame:
    """items(item_id, text) -> item_id, terms, bytes: of their different terms. Repeats stay in terms."""
    found = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(TERM_PATTERN), F.lit(0))
    size = F.aggregate(F.array_distinct("terms"), F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t))
    return items.select("item_id", found.alias("terms")).withColumn("bytes", size).filter("size(terms) > 0")


def _automaton(terms: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        found.add_word(f" {term} ", k)
    found.make_automaton()
    return found


def counted(docs: DataFrame, terms: list[str]) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_terms, terms, tfs: of each document its length, and which of the terms it has how often."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def make():
        scan = _automaton(shared.value)

        def compute(batch):
            lengths, found, tfs = [], [], []
            for texts in text_chunks(batch.column("text")):
                start, _ = find_runs(ALNUM[LOWER[texts.data]], texts.offsets)
                lengths.append(np.diff(np.searchsorted(start, texts.offsets)))
                guarded = _GUARDED[texts.data].tobytes()
                for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist()):
                    hits = [k for _, k in scan.iter(f" {guarded[a:b].decode()} ")] if len(shared.value) else []
                    own, n = np.unique(np.array(hits, np.int32), return_counts=True)
                    found.append(own)
                    tfs.append(n.astype(np.int32))
            return [pa.array(np.concatenate(lengths) if lengths else [], pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]

        return compute

    whole = T.ArrayType(T.IntegerType())
    return extended(docs.select("doc_id", "text"), [("n_terms", T.LongType()), ("terms", whole), ("tfs", whole)], make).drop("text")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The ``top`` best (score, doc_id) of every item so far; null ids after all others."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items, np.int64)
        self.item, self.score, self.doc, self.null = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        """scores has a row for each document and a column for each item."""
        row, item = np.nonzero((scores > 0) & (scores >= self.least[None, :]))
        item, score = np.append(self.item, item), np.append(self.score, scores[row, item])
        doc, null = np.append(self.doc, docs[row]), np.append(self.null, null[row])
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.top - 1
        self.least[item[full]] = score[full]
        stay = place < self.top
        self.item, self.score, self.doc, self.null = item[stay], score[stay], doc[stay], null[stay]


def scored(found: DataFrame, weights: list[int], wanted: list[list[tuple[int, int]]], n_docs: int, all_terms: int, n_items: int, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): every task's best documents. wanted has (item, repeats) of each term."""
    each = [len(w) for w in wanted]
    first = np.append(0, np.cumsum(each)).astype(np.int64)
    flat = np.array([x for w in wanted for x in w], np.int64).reshape(-1, 2)
    shared = found.sparkSession.sparkContext.broadcast((np.array(weights, np.int64), first, flat[:, 0].copy(), flat[:, 1].copy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, first, item, repeats = shared.value
        best = _Best(n_items, top)
        for batch in batches:
            ids = batch.column("doc_id")
            null = np.array(ids.is_null()).astype(np.int64)
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            lists = batch.column("terms")
            bounds = lists.offsets.to_numpy().astype(np.int64)
            terms = lists.flatten().to_numpy().astype(np.int64)
            bounds -= bounds[0]
            tfs = batch.column("tfs").flatten().to_numpy().astype(np.int64)
            m = 100 - 25 + (25 * batch.column("n_terms").to_numpy() * n_docs) // all_terms
            doc = np.repeat(np.arange(len(ids)), np.diff(bounds))
            gain = weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m[doc]))
            size = first[terms + 1] - first[terms]
            work = np.append(0, np.cumsum(size))[bounds] + n_items * np.arange(len(bounds))
            at = 0
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(work, work[at] + BLOCK, "right")) - 1)
                a, b = bounds[at], bounds[to]
                out = np.zeros((to - at, n_items), np.int64)
                n = size[a:b]
                entry = np.repeat(first[terms[a:b]] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                np.add.at(out.reshape(-1), np.repeat(doc[a:b] - at, n) * n_items + item[entry], np.repeat(gain[a:b], n) * repeats[entry])
                best.add(out, ids[at:to], null[at:to])
                at = to
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, mask=best.null.astype(bool)), pa.array(best.score)], ["item", "doc_id", "score"]
        )

    return found.mapInArrow(run, "item long, doc_id long, score long")


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP, max_term_bytes: int = MAX_TERM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of docs(doc_id, text) for each row of items(item_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = staged(spark, item_terms(items).withColumn("item", F.monotonically_increasing_id()), "items")
    total = kept.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first().b
    groups = max(1, -(-total // max_term_bytes))
    out = []
    for group in range(groups):
        own = kept.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == group)
        # max_term_bytes of terms, about
        asked = own.select("item", F.explode("terms").alias("term")).groupBy("item", "term").agg(F.count("*").alias("n")).toArrow().to_pydict()
        terms = sorted(set(asked["term"]))
        if not terms:
            continue
        places = {term: k for k, term in enumerate(terms)}
        numbers = {item: k for k, item in enumerate(sorted(set(asked["item"])))}
        wanted = [[] for _ in terms]
        for item, term, n in zip(asked["item"], asked["term"], asked["n"]):
            wanted[places[term]].append((numbers[item], n))
        found = staged(spark, counted(docs, terms), "found")
        sums = found.filter("n_terms > 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("all")).first()
        if not sums.n:
            break
        holding = found.select(F.explode("terms").alias("k")).groupBy("k").agg(F.count("*").alias("df")).toArrow().to_pydict()
        df = dict(zip(holding["k"], holding["df"]))
        weights = [term_weight(sums.n, df.get(k, 0)) for k in range(len(terms))]
        best = scored(found.filter("size(terms) > 0"), weights, wanted, sums.n, sums["all"], len(numbers), top)
        real = spark.createDataFrame(pa.table({"item": list(range(len(numbers))), "number": sorted(numbers)}))
        out.append(best.join(F.broadcast(real), "item").select(F.col("number").alias("item"), "doc_id", "score"))
    if not out:
        return items.select("item_id").limit(0).selectExpr("item_id", "1 as rank", "0L as doc_id", "0L as score")
    rows = out[0]
    for more in out[1:]:
        rows = rows.union(more)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    ranked = rows.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(kept.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_term_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of all for every benchmark item."""
    return search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
