"""Decontamination, repeated strings and near duplicates against plain Python."""

from collections import Counter

import brute_texts as brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scfsweep.llm import decontaminate, near_duplicates, suffix_dedup


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{k}" for k in rng.integers(0, 50_000, n)]


@pytest.fixture(scope="module")
def family():
    """Texts that share passages, and near copies with a few words changed."""
    base = sentence(0, 400)
    passage = sentence(1, 60)
    rows = []
    for k in range(60):
        text = list(base)
        for at in np.random.default_rng(100 + k).integers(0, 400, k % 9):
            text[at] = f"new{k}"
        rows.append((k, " ".join(text)))
    for k in range(60, 90):
        own = sentence(k, 80)
        rows.append((k, " ".join(own[: k % 40] + passage + own[k % 40 :])))
    return rows


def test_contamination(spark, odd, odd_rows):
    plain = odd_rows[0][1]
    items = [(1, "x y " + " ".join(plain.split()[3:15]).upper()), (2, "one, TWO"), (3, None), (4, ""), (20, " ".join(plain.split()[8:19])), (None, plain), (5, "unseen words")]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(spark, odd.withColumnRenamed("n_chars", "hits"), table)
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in rows.collect())
    named = [(i, t) for i, t in items if i is not None]
    expected = brute.contamination(pairs(odd_rows), named)
    whole = brute.contamination(pairs(odd_rows), items)
    assert got == Counter((a[0], a[1], b[2], a[3]) for a, b in zip(expected, whole))


def test_contamination_of_nothing(spark, odd, none):
    table = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(spark, odd, table).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(spark, none, table).count() == 0


@pytest.mark.parametrize("k", [1, 4, 10])
def test_any_fingerprint_length_finds_every_span(spark, family, k):
    docs = spark.createDataFrame(family, "doc_id long, text string")
    items = [(1, " ".join(sentence(1, 60)[7:33])), (2, " ".join(sentence(0, 400)[100:110]))]
    rows = decontaminate.contamination(spark, docs, spark.createDataFrame(items, "item_id long, text string"), k=k)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in rows.collect()) == Counter(brute.contamination(family, items))


@given(st.lists(st.integers(1, 3), max_size=60))
@settings(max_examples=200, deadline=None)
def test_suffix_array(letters):
    s = np.array(letters, np.int64)
    assert suffix_dedup.suffix_array(s).tolist() == sorted(range(len(letters)), key=lambda k: letters[k:])


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"group": 3}])
def test_repeats(spark, odd, odd_rows, family, options):
    rows = pairs(odd_rows) + [(100 + k, t) for k, t in family] + [(300, "ab" * 400), (301, "ab" * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.repeats(spark, docs, **options)
    assert Counter(map(tuple, got.collect())) == Counter(brute.repeats(rows))


@pytest.mark.parametrize("length, k", [(12, 3), (100, 40)])
def test_equal_grams_have_equal_hashes_only(length, k):
    import pyarrow as pa

    from scfsweep.llm.words import text_chunks

    # "ab" by the Thue-Morse rule and its inverse collide under sums of single bytes' numbers
    rule = ["ab"[bin(i).count("1") % 2] for i in range(4096)]
    texts = ["".join(rule), "".join(rule).translate(str.maketrans("ab", "ba")), "short", " ".join(sentence(3, 300))]
    data = "".join(texts).encode()
    found = suffix_dedup.Anchors(next(text_chunks(pa.array(texts))), length, k)
    grams = [data[at : at + k] for at in found.at]
    assert len(set(found.gram.tolist())) == len(set(grams)) == len(set(zip(grams, found.gram.tolist())))
    whole = found.hash(np.array([0, 4096, 0]), np.array([4096, 8192, 4096]))
    assert whole[0] == whole[2] != whole[1]
    assert not len(suffix_dedup.Anchors(next(text_chunks(pa.array(["", "ab"]))), length, k).first)


def test_repeats_of_nothing(spark, none):
    assert suffix_dedup.repeats(spark, none).count() == 0


def test_near_duplicates(spark, odd_rows, family):
    rows = pairs(odd_rows) + [(100 + k, t) for k, t in family]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = Counter(brute.links(rows))
    for block in (512, 8):
        got = near_duplicates.near_duplicates(spark, docs, block=block).select("doc_id", "class_id", "n_links")
        assert Counter(map(tuple, got.collect())) == expected


def test_near_duplicates_of_nothing(spark, none):
    assert near_duplicates.near_duplicates(spark, none).count() == 0
    assert near_duplicates.drop_near_duplicates(spark, none, "").count() == 0


def test_one_of_each_class_stays(spark, odd, odd_rows):
    kept = near_duplicates.drop_near_duplicates(spark, odd.withColumnRenamed("n_chars", "key"), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "key"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, 7, 10])


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = near_duplicates.choose_bands(threshold, 0.999, 400)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999 and bands * rows <= 400
    with pytest.raises(ValueError):
        near_duplicates.choose_bands(0.1, 0.9999, 10)


def test_rows_of_few_and_many_keys(spark, odd):
    from scfsweep.llm.common import rows_of

    keys = spark.createDataFrame([(1,), (9,), (None,), (9,), (77,)], "doc_id long")
    for most in (10, 2):
        got = rows_of(spark, odd, keys, "doc_id", most)
        assert got.columns == odd.columns and Counter(r.doc_id for r in got.collect()) == Counter([1, 9, 9])
    assert rows_of(spark, odd, keys.filter("false"), "doc_id").count() == 0


def test_rows_of_some_keys_and_what_is_made_of_them(spark, odd):
    from scfsweep.llm.common import rows_of

    def ids(batches):
        for batch in batches:
            yield batch.select(["doc_id"])

    keys = spark.createDataFrame([(1,), (9,), (None,), (9,), (77,)], "doc_id long")
    for most in (10, 2):
        got = rows_of(spark, odd, keys, "doc_id", most, then=(ids, "doc_id long"))
        assert Counter(tuple(r) for r in got.collect()) == Counter([(1,), (9,), (9,)])


def test_repeated_words_and_shared_passages_cost_no_squares(spark):
    """A word 20,000 times on both sides, and a passage that many items and documents share."""
    import time

    from pyspark.sql import functions as F

    passage = sentence(5, 40)
    docs = [(1, "a " * 20_000), (2, "a b " * 10_000), (3, "a " * 9 + "c")] + [(10 + k, " ".join([f"x{k}", *passage, f"y{k}"])) for k in range(300)]
    items = [(1, "a " * 20_000), (2, "b a " * 500)] + [(10 + k, " ".join([f"p{k}", *passage[5:35], f"q{k}"])) for k in range(300)]
    began = time.time()
    rows = decontaminate.contamination(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_hit, r.n) for r in rows.select("doc_id", "n_hit", F.size("items").alias("n")).collect()}
    assert time.time() - began < 60
    assert got[1] == (20_000, 1) and got[2] == (20_000, 1) and got[3] == (0, 0)
    assert all(got[10 + k] == (30, 300) for k in range(300))
