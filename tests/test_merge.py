import random

import pytest
from brute import SCHEMA, means, merged_by_position, response, same, sweep

from scfsweep.operators import merge as M
from scfsweep.operators import response as R
from scfsweep.operators import views as V
from scfsweep.plans import analyze


def responses(spark, rows_u, rows_alpha):
    return [
        R.response_rows(spark.createDataFrame(rows, SCHEMA), job, 0.05)
        for job, rows in (("u", rows_u), ("alpha", rows_alpha))
    ]


def positional(spark, rows_u, rows_alpha):
    merged = M.merge_by_position(*responses(spark, rows_u, rows_alpha))
    columns = ("run_id", "channel_id", "position", "u", "u_pert", "n1_nf_u", "alpha_pert", "n1_nf_alpha")
    return sorted(tuple(r[c] for c in columns) for r in merged.collect())


def assert_rows(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=lambda r: r[:3])):
        assert a[:4] == b[:4]
        assert all(same(x, y, 1e-12) for x, y in zip(a[4:], b[4:]))


CASES = {
    "complete": (sweep("u"), sweep("alpha")),
    "shorter alpha": (sweep("u"), sweep("alpha", us=(0, 2), steps=2)),
    "longer alpha": (sweep("u", us=(2,)), sweep("alpha", us=(0, 2, 4, 6))),
    "more u channels": (sweep("u", channels=(1, 2, 3)), sweep("alpha", channels=(5, 7))),
    "more alpha channels": (sweep("u", channels=(4,)), sweep("alpha", channels=(1, 2))),
    "one run lacks alpha": (sweep("u") + sweep("u", run="r2"), sweep("alpha", run="r2")),
    "two seeds in a run": (sweep("u") + sweep("u", seed="A"), sweep("alpha")),
    "gaps": (
        sweep("u", us=range(0, 20, 2), steps=6, keep=0.6, rnd=random.Random(1)),
        sweep("alpha", us=range(0, 20, 2), steps=6, keep=0.5, rnd=random.Random(2)),
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_positional_merge_matches_brute_force(spark, case):
    rows_u, rows_alpha = CASES[case]
    want = merged_by_position(response(rows_u, "u", 0.05), response(rows_alpha, "alpha", 0.05))
    assert_rows(positional(spark, rows_u, rows_alpha), want)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_block_size_does_not_change_positions(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "BLOCK_BITS", bits)
    rows_u, rows_alpha = CASES["gaps"]
    want = merged_by_position(response(rows_u, "u", 0.05), response(rows_alpha, "alpha", 0.05))
    assert_rows(positional(spark, rows_u, rows_alpha), want)


def test_run_with_a_third_of_all_rows_is_numbered_in_blocks(spark):
    rows_u = sweep("u", run="hot", channels=(1,), us=(0,), steps=3000)
    rows_alpha = sweep("alpha", run="hot", channels=(1,), us=(0,), steps=2500)
    for i in range(20):
        rows_u += sweep("u", run=f"r{i}", channels=(1,), us=range(0, 14, 2), steps=20)
        rows_alpha += sweep("alpha", run=f"r{i}", channels=(1,), us=range(0, 14, 2), steps=20)
    want = merged_by_position(response(rows_u, "u", 0.05), response(rows_alpha, "alpha", 0.05))
    assert_rows(positional(spark, rows_u, rows_alpha), want)
    blocks = M._block_offsets(M._both(*responses(spark, rows_u, rows_alpha)))
    assert blocks.filter("run_id = 'hot' and job = 'u'").count() == 3


def test_no_window_runs_over_a_whole_channel(spark):
    merged = M.merge_by_position(*responses(spark, *CASES["complete"]))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    numbering = next(line for line in plan.split("\n") if "row_number()" in line)
    assert "_block" in numbering and "_u" in numbering
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_null_u_rows_come_first(spark):
    odd = [("r1", "./V_2_u/V_2_u_1/S", 1, s, 1.0, 2.0, 4.0, True) for s in (1, 2)]
    rows_u, rows_alpha = sweep("u", channels=(1,)) + odd, sweep("alpha", channels=(1,))
    got = positional(spark, rows_u, rows_alpha)
    assert got[0][3] is None and [g[3] for g in got[1:4]] == [0, 0, 0]


@pytest.mark.parametrize("case", ["complete", "gaps", "shorter alpha"])
def test_merged_means(spark, case):
    rows_u, rows_alpha = CASES[case]
    want = means(merged_by_position(response(rows_u, "u", 0.05), response(rows_alpha, "alpha", 0.05)))
    tables = [spark.createDataFrame(rows, SCHEMA) for rows in (rows_u, rows_alpha)]
    got = analyze(*tables, u_step=0.05, alpha_step=0.05).means.collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.run_id, r.channel_id, r.u]
        assert same(r.n1_nf_u, w[0]) and same(r.n1_nf_alpha, w[1])


def test_key_merge_equals_position_on_complete_sweeps(spark):
    tables = [spark.createDataFrame(rows, SCHEMA) for rows in CASES["complete"]]
    both = [
        {tuple(r)[:3]: tuple(r)[3:] for r in analyze(*tables, u_step=0.05, alpha_step=0.05, align=a).means.collect()}
        for a in ("position", "key")
    ]
    assert both[0].keys() == both[1].keys()
    assert all(same(x, y) for k in both[0] for x, y in zip(both[0][k], both[1][k]))


def test_key_merge_keeps_every_row_of_both_sides(spark):
    rows_u, rows_alpha = CASES["gaps"]
    ru, ra = response(rows_u, "u", 0.05), response(rows_alpha, "alpha", 0.05)
    keys = [{(run, channel, r["u"], r["k"]) for (run, _n, channel), r in side.items()} for side in (ru, ra)]
    merged = M.merge_by_key(*responses(spark, rows_u, rows_alpha))
    assert merged.count() == len(keys[0] | keys[1])
    assert merged.filter("n1_nf_u is not null and n1_nf_alpha is not null").count() == len(keys[0] & keys[1])


def test_channel_pairs(spark):
    got = M.channel_pairs(*responses(spark, *CASES["more u channels"])).orderBy("pair").collect()
    assert [tuple(r) for r in got] == [("r1", 1, 1, 5), ("r1", 2, 2, 7)]


def test_both_readings_share_one_scan(spark, tmp_path):
    for job, rows in zip(("u", "alpha"), CASES["complete"]):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{job}")
    tables = [R.response_rows(spark.read.parquet(f"{tmp_path}/{job}"), job, 0.05) for job in ("u", "alpha")]
    merged = M.merged_mean(M.merge_by_position(*tables))
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and plan.count("ReusedExchange") == 2


def test_blank_channel_ids_join_no_channel(spark):
    blank = [("r1", "./U_2_u/U_2_u_1/S", None, s, 1.0, 2.0, 4.0, True) for s in (1, 2)]
    rows_u, rows_alpha = CASES["complete"]
    plain, odd = (responses(spark, u, rows_alpha) for u in (rows_u, rows_u + blank))
    assert odd[0].filter("channel_id is null").count() == 1
    for table in (
        lambda r: M.channel_pairs(*r),
        lambda r: M.merged_mean(M.merge_by_position(*r)),
        lambda r: M.merged_mean(M.merge_by_key(*r)),
        lambda r: V.mean_view(r[0], "u"),
        lambda r: V.channel_view(r[0], "u"),
    ):
        assert table(odd).count() == table(plain).count()
        assert table(odd).filter("channel_id is null" if "channel_id" in table(odd).columns else "pair is null").count() == 0


def test_signed_values_merge_in_order(spark):
    rows = {j: sweep(j, channels=(1,), us=(-4, -2, 0, 2), steps=2) for j in ("u", "alpha")}
    tables = [
        R.response_rows(spark.createDataFrame(rows[j], SCHEMA), j, 0.05, signed_u=True) for j in ("u", "alpha")
    ]
    merged = M.merge_by_position(*tables).orderBy("position").collect()
    assert [r.u for r in merged] == [-4.0, -4.0, -2.0, -2.0, 0.0, 0.0, 2.0, 2.0]
    assert all(r.n1_nf_u is not None and r.n1_nf_alpha is not None for r in merged)
