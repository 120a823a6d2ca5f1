"""Rules, mixing, sharding and the pipeline."""

import os
import zlib
from collections import Counter, defaultdict

import brute_texts as brute
import pytest

import corpus_pipeline
from scfsweep.llm import mixing, near_duplicates, queries, rules, sharding
from scfsweep.llm.common import repeated, staged

SF_DIR = os.environ.get("PIPELINE_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_ledger(spark, odd, odd_rows):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    more = [(53, f"{a}\n{b}\n{a}", None, None, None), (54, f"{a} 1 2 3 4 {b} 1 2 3 4", None, None, None), (55, "to the of in at x the to of in at", None, None, None)]
    more += [(50, "a b c d e " * 4, None, None, None), (51, "one line here\n \none line here\nother", None, None, None), (52, "# $ % é ñ\u00a0x\u2003y", None, None, None)]
    rows = odd_rows + more
    table = spark.createDataFrame(rows, odd.schema).withColumnRenamed("n_chars", "n_words")
    got = Counter((r.doc_id, *(r[m] for m in rules.MEASURES)) for r in rules.ledger(table).collect())
    assert got == Counter((r[0], *brute.measures(r[1])) for r in rows)


def test_policies_and_ablations(spark, odd, none):
    ledger = rules.ledger(odd)
    rows = ledger.collect()
    for policy, names in rules.POLICIES.items():
        mask = rules.mask_of(names)
        assert ledger.filter(rules.passes(policy)).count() == sum(r.failed & mask == 0 for r in rows)
        for r in rules.ablations(ledger, policy).collect():
            bit = rules.mask_of([r.rule])
            assert (r.n_failed, r.n_only) == (sum(bool(x.failed & bit) for x in rows), sum(x.failed & mask == bit for x in rows))
    assert rules.ledger(none).count() == 0


def level(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by sharing out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def test_mix(spark, odd):
    rows = [(k, "w " * (1 + k * 7919 % 400), "en", f"s{k % 5}" if k % 3 else "hot", 0) for k in range(1500)] + [(5000, None, None, None, 0), (5001, "x y", None, None, 0)]
    rows += [(6000 + k, "same text here", "en", "hot", 0) for k in range(700)]
    docs = spark.createDataFrame(rows, odd.schema).repartition(5)
    got = mixing.mix(spark, docs.withColumnRenamed("n_chars", "rate")).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    goals = level(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - goals[r.source]) < 1e-6 * (1 + r.target)
    for s in sizes:
        assert abs(taken[s] - goals[s]) <= max(3, 0.01 * goals[s]), s
    again = mixing.mix(spark, docs.repartition(2)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixed_rows(spark, odd, odd_rows, none):
    copies = Counter()
    for r in mixing.mix(spark, odd).collect():
        copies[r.doc_id] += r.copies
    got = mixing.mixed(spark, odd, "")
    assert got.columns == odd.columns
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == +copies
    assert {tuple(r) for r in rows} <= set(odd_rows)
    assert mixing.mix(spark, none).count() == 0 and mixing.mixed(spark, none, "").count() == 0


@pytest.mark.parametrize("name", ["key", "shared", "copies"])
def test_stages_keep_columns_of_any_name(spark, odd, name):
    docs = odd.withColumnRenamed("n_chars", name)
    for stage in (mixing.mixed, near_duplicates.drop_near_duplicates):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns and got.count()


def test_shards(spark, odd, odd_rows, none):
    rows = odd_rows + [(1000 + k, f"text {k % 3}", None, None, None) for k in range(500)] + [(7, "again", None, None, None)] * 50
    docs = spark.createDataFrame(rows, odd.schema).withColumnRenamed("n_chars", "shard")
    got = sharding.shard_rows(spark, docs).collect()
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.shard_rows(spark, docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert sharding.shard_rows(spark, none).count() == 0


def test_rows_alike_are_ranked_by_many_tasks(spark, odd):
    """Half of the rows are the same one: each gets a slot, and the copies of the mix come out whole."""
    some = spark.range(3000).selectExpr("if(id % 2 = 0, null, id) as doc_id", "if(id % 2 = 0, 'a b c', concat(repeat('w ', cast(id % 90 as int)), id)) as text")
    docs = some.selectExpr("doc_id", "text", "'en' as lang", "if(text = 'a b c' or doc_id % 3 = 0, 'hot', 'other') as source", "0L as n_chars").repartition(6)
    rows = docs.collect()
    placed = sharding.shard_rows(spark, docs).collect()
    assert Counter((r.doc_id, r.size) for r in placed) == Counter((r.doc_id, len(r.text) + 1) for r in rows)
    assert sorted((r.shard, r.slot) for r in placed) == [(s, k) for s in range(8) for k in range(375)]
    taken = Counter()
    for r in mixing.mix(spark, docs.select("doc_id", "text", "source")).collect():
        taken[r.doc_id] += r.copies
    got = mixing.mixed(spark, docs, "").collect()
    assert Counter(r.doc_id for r in got) == +taken and {tuple(r) for r in got} <= {tuple(r) for r in rows}


def test_repeated_rows_are_numbered(spark):
    counts = spark.createDataFrame([(1, 0), (2, 1), (3, 1024), (4, 1025), (5, 5000)], "id long, n long")
    got = repeated(counts, "n", "nth", "id")
    assert got.columns == ["id", "nth"]
    assert Counter(map(tuple, got.collect())) == Counter((k, i) for k, n in ((2, 1), (3, 1024), (4, 1025), (5, 5000)) for i in range(n))


def test_ring_against_one_row_at_a_time():
    nodes = [(1, 0), (3, 1), (4, 0), (6, 2)]
    counts = [5, 0, 3, 1, 0, 2, 0, 4]
    bounds = [6, 5, 4]
    runs = sharding.ring_walk(counts, nodes, bounds)
    used, expected = [0] * 3, []
    for cell, n in enumerate(counts):
        for _ in range(n):
            at = next((k for k, (c, _) in enumerate(nodes) if c >= cell), 0)
            while used[nodes[at % len(nodes)][1]] >= bounds[nodes[at % len(nodes)][1]]:
                at += 1
            shard = nodes[at % len(nodes)][1]
            expected.append((shard, used[shard]))
            used[shard] += 1
    ends = [r[0] for r in runs[1:]] + [sum(counts)]
    assert [(s, k + i) for (first, s, k), end in zip(runs, ends) for i in range(end - first)] == expected
    with pytest.raises(ValueError):
        sharding.ring_walk(counts, nodes, [1, 1, 1])


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = staged(spark, stage(spark, before, SF_DIR), name)
        assert after.columns == docs.columns
        assert 0.5 * before.count() < after.count() <= before.count(), name
        assert after.exceptAll(before).count() == 0
        before = after
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert Counter(r.doc_id for r in rows.collect()).keys() <= {r.doc_id for r in before.collect()}
    counts = [r["count"] for r in rows.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


@needs_tables
def test_stages_against_plain_python(spark):
    """What stages 2 to 5 decide, each on the rows that its predecessor kept."""
    stages = dict(corpus_pipeline.STAGES)
    after = lambda name, docs: staged(spark, stages[name](spark, docs, SF_DIR), name)
    pairs = lambda docs: [(r.doc_id, r.text) for r in docs.collect()]
    good = after("quality", spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    single = after("near_duplicates", good)
    rows = pairs(good)
    assert len({d for d, _ in rows}) == len(rows)
    assert Counter(pairs(single)) == Counter(r for r, (doc, least, _) in zip(rows, brute.links(rows)) if doc == least)
    clean = after("decontaminate", single)
    rows = pairs(single)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert Counter(pairs(clean)) == Counter(r for r, (_, _, n_hit, _) in zip(rows, brute.contamination(rows, items)) if not n_hit)
    mixture = after("mix", clean)
    n_words = lambda r: len(brute.PRINTED.findall(r.text or ""))
    sizes, longest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in clean.collect():
        sizes[r.source] += n_words(r)
        longest[r.source] = max(longest[r.source], n_words(r))
    for r in mixture.collect():
        taken[r.source] += n_words(r)
    goals = level(sizes)
    assert all(abs(taken[s] - goals[s]) <= max(longest[s], 0.01 * goals[s]) for s in sizes) and taken.keys() <= sizes.keys()
    assert set(Counter(pairs(mixture)).values()) <= {1, 2} and set(pairs(mixture)) <= set(pairs(clean))
    placed = stages["shard"](spark, mixture, SF_DIR).collect()
    of = lambda text: (text or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == Counter((d, len(of(t)) + 1, zlib.crc32(of(t))) for d, t in pairs(mixture))
    places = sorted((r.shard, r.slot) for r in placed)
    counts = Counter(s for s, _ in places)
    assert places == [(s, k) for s in range(8) for k in range(counts[s])] and max(counts.values()) - min(counts.values()) <= 1


def test_clean_rows_stay_beside_bad_ones_with_their_id(spark, odd, tmp_path):
    plain, junk = "the old stone bridge by the river near the town and the hills", "zq#x@ vv!kk~ jj^^ " * 40
    question = "what is the name of the largest lake in the far north of the country"
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(100, 160)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    trusted = [(k, f"{plain} {'and the ' * (k % 7)}{plain[: k % 40]}", "en", "a", 0) for k in range(100, 160)]
    clean = [(None, plain, "en", "a", 0), (7, plain + " too", "en", "a", 0), (7, None, "en", "a", 0)]
    for stage, text in ((corpus_pipeline.STAGES[0][1], junk), (corpus_pipeline.STAGES[2][1], "so " + question)):
        bad = [(None, text, "en", "a", 0), (7, text, "en", "b", 0)]
        docs = spark.createDataFrame(trusted + clean + bad, odd.schema).repartition(3)
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        assert Counter(map(tuple, got.collect())) == Counter(trusted + clean)


def test_each_operator_has_its_query():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{k}" for k in range(1, 14)}
    assert set(queries.oracle_sql()) <= set(queries.queries())
