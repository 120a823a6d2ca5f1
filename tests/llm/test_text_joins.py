"""Signature-coordinate join, document scan and vector codes against plain Python."""

import hashlib
import math
from collections import Counter

import brute_texts as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from scfsweep.llm import signature_join, text_search, vector_codes, words


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def variants(seed, n, length, edits):
    """n texts of one template with some words of each replaced."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 10**6, length)]
    out = []
    for k in range(n):
        text = list(base)
        for at in rng.integers(0, length, edits(k)):
            text[at] = f"v{k}x{at}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def families():
    rows = [(k, t) for k, t in enumerate(variants(1, 80, 300, lambda k: k % 14))]
    rows += [(100 + k, t) for k, t in enumerate(variants(2, 40, 40, lambda k: k % 3))]
    passage = " ".join(variants(3, 1, 120, lambda k: 0))
    rows += [(200 + k, f"{passage} {t}") for k, t in enumerate(variants(4, 30, 100, lambda k: 90))]
    return rows


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 5)])
def test_components(spark, odd_rows, families, blocks):
    rows = pairs(odd_rows) + [(1000 + k, t) for k, t in families]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = signature_join.near_components(spark, docs, left=blocks[0], right=blocks[1])
    assert Counter(map(tuple, got.collect())) == Counter(brute.blank_components(rows))


def test_components_that_only_later_merges_find(spark):
    """A chain a-b-c-...: each text is near to the next one alone, so no star holds it."""
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(base[:200 - 0] if not k else [f"z{j}" for j in range(5 * k)] + base[5 * k :])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = signature_join.near_components(spark, docs, left=2, right=3)
    assert Counter(map(tuple, got.collect())) == Counter(brute.blank_components(rows))


def test_components_of_nothing_and_clashes(spark, none, odd):
    assert signature_join.near_components(spark, none).count() == 0
    clash = odd.withColumnRenamed("n_chars", "rep").withColumnRenamed("lang", "tokens").withColumnRenamed("source", "shared")
    assert signature_join.near_components(spark, clash).count() == odd.count()


def test_matches_keep_the_recall():
    for percent, k in ((80, 48), (90, 32), (50, 64)):
        t, p = signature_join.least_matches(percent, k), percent / 100
        below = sum(math.comb(k, j) * p**j * (1 - p) ** (k - j) for j in range(t))
        assert below <= 1e-4 < below + math.comb(k, t) * p**t * (1 - p) ** (k - t)


def test_hashes_of_structured_words():
    """Words of the Thue-Morse kind, far places, word order, and stems."""
    import pyarrow as pa

    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    (texts,) = words.text_chunks(pa.array([f"{a} {b} {a}", "", "x", f"{a[:-1]}b", "of to the of", "to of the of"]))
    found = words.find_words(texts, words.PRINTED, stems=(3,))
    hashes = found.hashes.tolist()
    assert hashes[0] == hashes[2] and len(set(hashes)) == 7
    assert found.stems[0][0] == found.stems[0][2] == found.stems[0][4] != found.stems[0][1]
    _, grams = words.ngrams(found, 4)
    assert len(grams) == 2 == len(set(grams.tolist()))


@pytest.fixture(scope="module")
def asked(odd_rows):
    return [(1, "the Fox the fox QUICK"), (1, "the Fox the fox QUICK"), (2, None), (3, "..."), (None, "one two word5x5 ñandú"), (4, "unseen"), (5, "two"), (6, "数据 straße")]


@pytest.mark.parametrize("size", [1 << 21, 8])
def test_search(spark, odd, odd_rows, asked, size):
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("score", F.lit(1))
    got = text_search.search(spark, odd.withColumnRenamed("n_chars", "terms").withColumnRenamed("lang", "item"), items, top=4, max_term_bytes=size)
    assert Counter(map(tuple, got.collect())) == Counter(brute.search(pairs(odd_rows), asked, 4))


def test_search_of_nothing(spark, odd, none, asked):
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert text_search.search(spark, none, items).count() == 0
    assert text_search.search(spark, odd, items.limit(0)).count() == 0
    blank = odd.withColumn("text", F.lit(None).cast("string"))
    assert text_search.search(spark, blank, items).count() == 0


def vectors(n, d=8, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, d))
    rows = []
    for k in range(n):
        v = centers[k % 5] + rng.normal(size=d) * 0.3
        rows.append((k * 3 % n, [float(np.float32(x)) for x in v], k % 4 if k % 7 else None))
    return rows


@pytest.mark.parametrize("kept", [16, 2])
def test_codes(spark, kept):
    rows = vectors(700)
    rows += [(None, rows[0][1], 1), (5, rows[5][1], 1), (800, None, 1), (801, [1.0, None] * 4, 1), (802, [math.inf] * 8, 1), (803, [math.nan] * 8, 2), (804, [1.0] * 4, 2), (805, [], 2), (806, [1.0] * 7, 2)]
    rows += [(900 + k, rows[k][1], 9) for k in range(50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got, books = vector_codes.coded(spark, table, kept=kept)
    expected, expected_books = brute.codes(rows, 8)
    assert books.tolist() == expected_books
    assert Counter((r.vec_id, r.label, tuple(r.codes), tuple(r.errors)) for r in got.collect()) == Counter(expected)


def test_codes_of_few_and_none(spark):
    table = spark.createDataFrame(vectors(5), "vec_id long, embedding array<float>, label int")
    got, books = vector_codes.coded(spark, table)
    assert books.shape == (4, 5, 2) and all(sum(r.errors) == 0 for r in got.collect())
    none, books = vector_codes.coded(spark, table.limit(0))
    assert none.count() == 0 and vector_codes.codebooks_digest(books) == hashlib.sha256(b"").hexdigest()


def test_large_components_are_refused(spark):
    table = spark.createDataFrame([(1, [1e9, 0.0, 0.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="beyond"):
        vector_codes.coded(spark, table)
