"""What operators make the driver hold: rounds, jobs and plans don't exceed what the results need."""

import random
import uuid

from scfsweep.llm import graph, kneser_ney, mixing


def _roots(pairs):
    """The least node that each node reaches, by union-find."""
    up = {}

    def top(n):
        while up.setdefault(n, n) != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return sorted((n, top(n)) for n in up)


def _staged_names(monkeypatch):
    names, staged = [], graph.staged
    monkeypatch.setattr(graph, "staged", lambda spark, df, name: names.append(name) or staged(spark, df, name))
    return names


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    names = _staged_names(monkeypatch)
    pairs = [(1, k) for k in range(2, 40)] + [(100 + k, 100) for k in range(1, 5)] + [(7, 7), (2, 1)]
    got = graph.components(spark, spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == _roots(p for p in pairs if p[0] != p[1])
    assert names == ["edges"]
    none = graph.components(spark, spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0 and names == ["edges"] * 2


def test_components_end_with_the_round_that_makes_stars(spark, monkeypatch):
    names = _staged_names(monkeypatch)
    pairs = [(3, 2), (2, 1)]  # a path; one round makes it a star
    got = graph.components(spark, spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == _roots(pairs)
    assert names == ["edges", "large", "small"]


def test_components_of_any_graph(spark):
    dealt = random.Random(3)
    pairs = [(k, k + 1) for k in range(500, 540)] + [(dealt.randrange(200) - 100, dealt.randrange(200) - 100) for _ in range(110)]
    pairs += [(600 + k, 600) for k in range(20)] + [(601, 619), (700, 701), (702, 701), (702, 703)]
    got = graph.components(spark, spark.createDataFrame(pairs + [(None, 5), (6, None)], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == _roots(p for p in pairs if p[0] != p[1])


def test_stars_are_told_from_other_graphs(spark):
    of = lambda *pairs: graph.are_stars(spark.createDataFrame(pairs, "a long, b long"))
    assert of((2, 1), (3, 1), (5, 4))
    assert not of((2, 1), (3, 2))
    assert not of((3, 1), (3, 2))


def test_counts_of_counts_take_one_query(spark, monkeypatch):
    rows = [(k, "the quick brown fox " * (k % 7) + str(k * k), "en", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n long")
    given = []
    monkeypatch.setattr(kneser_ney, "discounts", lambda *n: given.append(n) or [0.5, 0.75, 0.9])
    counts = kneser_ney.count_windows(docs)
    group = f"model-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    kneser_ney.model(spark, counts)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    whole = {r.key: r.n for r in counts.collect()}
    for order in range(5, 0, -1):
        assert given[order - 1] == tuple(sum(n == k for n in whole.values()) for k in (1, 2, 3, 4))
        lower = {}
        for key in whole:
            lower.setdefault(key & ((1 << 8 * (order - 1)) - 1), set()).add(key)
        whole = {key: len(longer) for key, longer in lower.items()}
    assert jobs <= 40, jobs


def test_plan_of_a_mix_does_not_repeat_the_histogram(spark):
    rows = [(k, "w " * (k % 30 + 1), f"s{k % 5}") for k in range(300)]
    plan = mixing.planned(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan parquet") <= 4
