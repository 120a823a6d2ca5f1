"""Exact means, lines reduced in place, streams of logs and means, commits, bad lines, gaps in coverage."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import SCHEMA, sweep
from scfsweep.functions.exact import exact_mean
from scfsweep.operators import coverage, logs, merge
from scfsweep.operators import response as R
from scfsweep.operators import views as V
from scfsweep.plans.commits import append_once, committed, read_committed, start_table
from scfsweep.schema import RESULT_HEADER
from scfsweep.sources import log_lines, quarantine, sort_lines, tag_lines
from scfsweep.streaming import (
    log_picks_so_far,
    means_so_far,
    read_log_stream,
    read_result_stream,
    running_log_picks,
    running_mean_differences,
    snapshot_log_picks,
    snapshot_means,
)


def bag(df):
    return Counter(tuple(repr(x) for x in r) for r in df.collect())


def test_means_are_the_same_to_the_last_bit(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 6) for _ in range(3000)]
    rows = [(k % 3, v) for k, v in enumerate(values)] + [(3, None), (4, math.inf), (4, 1.0), (5, math.inf), (5, -math.inf), (6, 1e30), (6, 2.0), (7, math.nan)]
    table = spark.createDataFrame(rows, "g int, x double")
    found = [bag(table.repartition(n, "x").groupBy("g").agg(exact_mean(F.col("x")).alias("m"))) for n in (1, 3, 8)]
    assert found[0] == found[1] == found[2]
    means = {int(g): eval(m, {"inf": math.inf, "nan": math.nan}) for g, m in found[0]}
    for g in range(3):
        own = values[g::3]
        assert abs(means[g] - math.fsum(own) / len(own)) <= 1e-15 + 1e-15 * abs(means[g])
    assert means[3] is None and means[4] == math.inf and math.isnan(means[5]) and means[6] == 5e29 + 1 and math.isnan(means[7])


def a_log(seed, n, finished):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        out.append(f"  {k % 3 + 1}   {k % 2 + 1} Total: {rng.randint(0, 999) / 128}    Mz: 0")
        out.append("noise Total energy 1 2")
    return out + ["Finalisation time = 1.0 s"] * finished


def expected_picks(found):
    out = []
    for file, lines in found.items():
        series = {}
        for line in lines:
            words = line.split()
            if len(words) > 2 and words[2] == "Total:":
                series.setdefault((int(words[0]), int(words[1])), []).append(float(words[3]))
        done = any("Finalisation" in line for line in lines)
        for (species, spin), v in series.items():
            out.append((file, species, spin, v[0], v[1] if len(v) > 1 else None, v[-1], len(v), done))
    return Counter(tuple(repr(x) for x in r) for r in out)


LOGS = {"a.castep": a_log(1, 700, True), "b.castep": a_log(2, 3, False), "c.castep": ["Finalisation time = 2 s"], "d.castep": a_log(3, 40, True)}


@pytest.mark.parametrize("limit", [100_000, 8])
def test_lines_are_reduced_where_they_are_read(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(logs, "REDUCE_ROWS", limit)
    for name, lines in LOGS.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        tagged = tag_lines(log_lines(spark, str(tmp_path)))
        kept = logs.survivors(tagged)
        found = logs.pick_observations(tagged).withColumn("file", F.substring_index("file", "/", -1))
        assert bag(found.select("file", "species", "spin", "before_scf", "first_scf", "last_scf", "n_obs", "converged")) == expected_picks(LOGS)
        assert limit == 8 or kept.count() < tagged.count() / 3
        # survivors of survivors are the same
        again = logs.picked(logs.survivors(kept.repartition(2))).withColumn("file", F.substring_index("file", "/", -1))
        assert bag(again) == bag(found)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_logs_that_grow(spark, tmp_path):
    source, target, state, snapshots = (f"{tmp_path}/{n}" for n in ("in", "picks", "state", "snapshots"))
    os.makedirs(source)
    seen = {}
    # the middle piece of a log comes last
    for turn, piece in enumerate((0, 2, 1)):
        for name, lines in LOGS.items():
            third = len(lines) // 3 + 1
            part = lines[piece * third : (piece + 1) * third]
            with open(f"{source}/.{name}.{piece}", "w") as out:
                out.write("\n".join(part) + "\n")
            os.rename(f"{source}/.{name}.{piece}", f"{source}/{name}.{piece}")
            seen.setdefault(name, {})[piece] = part
        running_log_picks(read_log_stream(spark, source, files_per_batch=3), target, state)
        whole = {n: [line for k in sorted(p) for line in p[k]] for n, p in seen.items()}
        if turn == 1:
            snapshot_log_picks(spark, target, snapshots, first=True)
        found = log_picks_so_far(spark, target, snapshots if turn else None).withColumn("file", F.substring_index("file", "/", -1))
        assert bag(found) == expected_picks(whole)
    snapshot_log_picks(spark, target, snapshots)
    assert bag(log_picks_so_far(spark, target, snapshots)) == bag(log_picks_so_far(spark, target))


def test_means_by_differences(spark, tmp_path):
    source, target, state, snapshots = (f"{tmp_path}/{n}" for n in ("in", "means", "state", "snapshots"))
    os.makedirs(f"{source}/r1")
    rows = sweep("u", run="r1")
    # no change at all first, so that later rows move responses from infinity
    rows = [(*r[:4], 1.0, 1.0, 1.0, True) for r in rows[:6]] + rows
    for turn in range(4):
        with open(f"{source}/r1/.x{turn}", "w") as out:
            out.write(",".join(RESULT_HEADER) + "\n")
            out.writelines(",".join(str(x).lower() if isinstance(x, bool) else str(x) for x in r[1:]) + "\n" for r in rows[turn::4])
        os.rename(f"{source}/r1/.x{turn}", f"{source}/r1/x{turn}.csv")
        running_mean_differences(read_result_stream(spark, f"{source}/*"), "u", 0.05, target, state)
        if turn == 1:
            snapshot_means(spark, target, snapshots, first=True)
        seen = spark.createDataFrame([r for j in range(turn + 1) for r in rows[j::4]], SCHEMA)
        want = bag(V.mean_view(R.response_rows(seen, "u", 0.05), "u"))
        assert bag(means_so_far(spark, target, "u")) == want
        if turn > 1:
            assert bag(means_so_far(spark, target, "u", snapshots)) == want
    snapshot_means(spark, target, snapshots)
    assert bag(means_so_far(spark, target, "u", snapshots)) == bag(means_so_far(spark, target, "u"))


def test_batches_count_once(spark, tmp_path):
    root = str(tmp_path / "table")
    start_table(spark, root)
    assert read_committed(spark, root).count() == 0
    first, second = (spark.createDataFrame(sweep(job, run="r"), SCHEMA) for job in ("u", "alpha"))
    assert append_once(first, root, "a/1 ü") and not append_once(first, root, "a/1 ü")
    assert read_committed(spark, root).count() == first.count()
    # a driver that was lost before its commit, and tries again
    with pytest.raises(Exception, match="lost"):
        append_once(second.withColumn("converged", F.when(F.col("spin") == 2, F.raise_error(F.lit("lost"))).otherwise(True)), root, "b")
    second.limit(3).write.csv(f"{root}/rows/folder=lost")
    assert read_committed(spark, root).count() == first.count()
    assert append_once(second, root, "b")
    assert {(r.batch, r.n_rows) for r in committed(spark, root).collect()} == {("a/1 ü", first.count()), ("b", second.count())}
    assert bag(read_committed(spark, root).drop("batch")) == bag(first.union(second))


def test_bad_lines_are_kept(spark, tmp_path):
    head = ",".join(RESULT_HEADER)
    lines = {
        "good": ["./U_2_u/U_2_u_1/S, 1, 2, 0.5, 0.25, 1e-3, true", "x,,,,,,"],
        "Spin: no integer": ["./a, 1, two, 0.5, 0.25, 0.5, true"],
        "Last SCF: no number": ["./a, 1, 1, 0.5, 0.25, 0.5.5, true"],
        "Converged: no truth value": ["./a, 1, 1, 0.5, 0.25, 0.5, maybe"],
        "3 fields": ["a,b,c"],
        "8 fields": ["./a, 1, 1, 0.5, 0.25, 0.5, true, 1"],
    }
    os.makedirs(tmp_path / "r1")
    (tmp_path / "r1" / "x.csv").write_text("\n".join([head.replace(",", ", "), "", *[x for v in lines.values() for x in v], "   "]) + "\n")
    found = sort_lines(spark, f"{tmp_path}/*")
    assert [tuple(r) for r in found.good.orderBy("jobname").collect()] == [
        ("r1", "./U_2_u/U_2_u_1/S", 1, 2, 0.5, 0.25, 1e-3, True),
        ("r1", "x", None, None, None, None, None, None),
    ]
    bad = {r.reason: r for r in found.bad.collect()}
    assert {k: [bad[k].line] for k in bad} == {k: v for k, v in lines.items() if k != "good"}
    assert found.good.count() + found.bad.count() == sum(map(len, lines.values()))
    quarantine(found.bad, f"{tmp_path}/kept")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == found.bad.count()


def test_missing_ranges(spark):
    missing = {("r", "u", 0.0): [1, 2, 3, 7, 9, 10], ("r", "u", 2.0): [5], ("s", "alpha", 0.0): []}
    rows = [(*key, k, "missing" if k in gaps else "done") for key, gaps in missing.items() for k in range(12)]
    table = spark.createDataFrame(rows + rows[:20], "run_id string, job string, u double, k int, status string")
    got = {tuple(r) for r in coverage.missing_ranges(table).collect()}
    assert got == {("r", "u", 0.0, 1, 3, 3), ("r", "u", 0.0, 7, 7, 1), ("r", "u", 0.0, 9, 10, 2), ("r", "u", 2.0, 5, 5, 1)}


def test_signed_folders_stay(spark):
    rows = [("r", f"{name}/S", 1, spin, 1.0, 1.5, 2.0, True) for name in ("U_0.5_u_1", "U_-2_u_1", "U_1_u_1", "U_1_u") for spin in (1, 2)]
    found = R.response_rows(spark.createDataFrame(rows, SCHEMA), "u", 0.05, perturbed_by="folder", signed_u=True)
    assert sorted(r.u for r in found.collect()) == [-2.0, 0.5, 1.0]


def test_responses_under_two_names_are_listed(spark):
    rows = [("r", f"{top}/U_2_u/U_2_u_{k}/S", 1, 1, 1.0, 1.0 + d, 3.0, True) for top, d, ks in ((".", 1.0, (1, 2)), ("old", 0.5, (1,))) for k in ks]
    found = R.response_rows(spark.createDataFrame(rows, SCHEMA), "u", 0.05)
    listed = merge.repeated_responses(found).collect()
    assert sorted((r.jobname, round(r.n1_nf, 9), r.spellings) for r in listed) == [("./U_2_u/U_2_u_1/S", 0.025, 2), ("old/U_2_u/U_2_u_1/S", 0.075, 2)]


def test_jobs_of_a_cell_share_a_call_and_a_state():
    import pandas as pd

    from scfsweep.streaming.means import _add

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def batch(*rows):
        return pd.DataFrame(rows, columns=["run_id", "jobname", "channel_id", "before_scf", "first_scf", "last_scf"])

    state = State()
    first = next(_add((0,), iter([batch(("r", "a", 1, 1.0, 2.0, None), ("r", "a", 1, 1.0, 2.0, 3.0)), batch(("r", None, None, 5.0, 5.0, 5.0))]), state))
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in first.itertuples(index=False)]
    assert rows == [("r", "a", 1, False, 0.0, 0.0, 0.0, 2.0, 4.0, 3.0), ("r", None, None, False, 0.0, 0.0, 0.0, 5.0, 5.0, 5.0)]
    second = next(_add((0,), iter([batch(("r", "a", 1, 0.5, 0.0, 0.0), ("s", "a", 1, 7.0, 7.0, 7.0))]), state))
    assert [tuple(r) for r in second.itertuples(index=False)] == [
        ("r", "a", 1, True, 2.0, 4.0, 3.0, 2.5, 4.0, 3.0),
        ("s", "a", 1, False, 0.0, 0.0, 0.0, 7.0, 7.0, 7.0),
    ]
    assert len(state.get[0]) == 3
