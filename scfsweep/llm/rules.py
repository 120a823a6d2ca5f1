"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: one bit per rule that fails, beside the measurements it rests
on. A policy is a version and a mask of rules; applying one, or comparing several, only reads the stored
bits. An ablation (what would pass without a rule) counts bit patterns and never reads a text again.

Words are runs of anything but the six blanks of ASCII. Null and empty texts have no word: they fail the
rule on length, and no rule that is a share of words. Repeated rows get a line each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scfsweep.llm.common import extended, table
from scfsweep.llm.words import PRINTED, find_words, mix, ngrams, text_chunks

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: name -> SQL that is true where a document fails; the bit is the place in this list
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "short_words": "2 * word_chars < 3 * n_words",
    "duplicate_lines": "n_dup_lines > 50",
}
BASE = ("few_words", "repeated_words")
#: version -> rules that reject
POLICIES = {"base-1": BASE, "clean-1": (*BASE, "many_symbols"), "clean-2": (*BASE, "many_symbols", "long_words", "short_words")}
DEFAULT_POLICY = "clean-2"

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False
WINDOW = 5


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _by_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that are equal only for equal hashes of one row."""
    return mix(hashes + (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))


def repeated_words(words) -> np.ndarray:
    """Per row: words in windows of five that the row has twice or more."""
    at, hashes = ngrams(words, WINDOW)
    if not len(at):
        return np.zeros(len(words.bounds) - 1, np.int64)
    keys = _by_row(words.rows[at], hashes)
    order = np.argsort(keys)
    same = np.diff(keys[order]) == 0
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    depth = np.zeros(len(words.hashes) + 1, np.int64)
    begin = at[twice]
    np.add.at(depth, begin, 1)
    np.add.at(depth, begin + WINDOW, -1)
    return _per_row(np.cumsum(depth[:-1]) > 0, words.bounds)


def measure(texts) -> list[np.ndarray]:
    """MEASURES per row."""
    words = find_words(texts, PRINTED)
    chars = PRINTED[texts.data] & ((texts.data & 0xC0) != 0x80)
    lines = find_words(texts, _NOT_NEWLINE)
    with_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    rows = lines.rows[with_word]
    _, first = np.unique(_by_row(rows, lines.hashes[with_word]), return_index=True)
    n = len(texts)
    repeats = np.bincount(rows, minlength=n) - np.bincount(rows[first], minlength=n)
    return [words.counts, _per_row(chars, texts.offsets), _per_row(_SYMBOLS[texts.data], texts.offsets), repeats, repeated_words(words)]


def ledger(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, the measurements, and the rules that failed as bits of ``failed``."""

    def make():
        def compute(batch):
            parts = [measure(texts) for texts in text_chunks(batch.column("text"))]
            return [pa.array(np.concatenate([p[k] for p in parts]) if parts else [], pa.int64()) for k in range(len(MEASURES))]

        return compute

    measured = extended(docs.select("doc_id", "text"), [(m, T.LongType()) for m in MEASURES], make)
    bits = [f"if({rule}, {1 << k}L, 0L)" for k, rule in enumerate(RULES.values())]
    return measured.select("doc_id", *MEASURES, F.expr(" | ".join(bits)).alias("failed"))


def mask_of(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def passes(policy: str) -> F.Column:
    """True where a row of the ledger passes the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """(policy, rule, n_failed, n_only): documents that fail the rule, and that would pass without it."""
    mask = mask_of(POLICIES[policy])
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    named = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r])).cast("long").alias("bit")) for r in POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(named).alias("x"))
    count = lambda hit: F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0).cast("long"))
    return each.groupBy(F.lit(policy).alias("policy"), F.col("x.rule").alias("rule")).agg(
        count(F.col("bits").bitwiseAND(F.col("x.bit")) != 0).alias("n_failed"), count(F.col("bits") == F.col("x.bit")).alias("n_only")
    )


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, judged by the default policy."""
    base = mask_of(BASE)
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", *MEASURES, (F.col("failed").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"), passes(DEFAULT_POLICY).alias("kept"), "failed"
    )
