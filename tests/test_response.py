import math

import pytest
from brute import SCHEMA, response, same, sweep

from scfsweep.operators import response as R
from scfsweep.operators import views as V
from scfsweep.plans import analyze, analyze_single, perturbation_values


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("job,add_u", [("u", True), ("alpha", True), ("alpha", False)])
def test_response_matches_brute_force(spark, job, add_u):
    rows = sweep(job) + sweep(job, run="r2", channels=(3,), steps=12)
    want = response(rows, job, 0.05, add_u)
    got = R.response_rows(table(spark, rows), job, 0.05, alpha_includes_u=add_u).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.run_id, r.jobname, r.channel_id]
        assert (r.u, r.k) == (w["u"], w["k"])
        for c in ("d_first", "d_last", "slope_first", "slope_last", "pert", "n1_nf"):
            assert same(r[c], w[c], 0 if c.startswith("d_") else 1e-15)


def test_total_view_columns(spark):
    total = R.total_view(R.response_rows(table(spark, sweep("u")), "u", 0.05))
    assert total.columns == list(R.TOTAL_COLUMNS)


def test_zero_difference_gives_infinity_and_nan(spark):
    name = "./U_2_u/U_2_u_1/S"
    rows = [("r", name, 1, 1, 1.0, 1.0, 3.0, True), ("r", name, 2, 1, 1.0, 1.0, 1.0, True)]
    one, two = R.response_rows(table(spark, rows), "u", 0.05).orderBy("channel_id").collect()
    assert one.slope_first == math.inf and one.n1_nf == math.inf
    assert two.slope_last == math.inf and math.isnan(two.n1_nf)


def test_sum_over_nulls_is_zero(spark):
    name = "./U_2_u/U_2_u_1/S"
    rows = [("r", name, 1, 1, None, 2.0, 3.0, True), ("r", name, 1, 2, None, 2.0, None, True)]
    got = R.spin_sums(R.select_results(table(spark, rows))).first()
    assert (got.s0, got.s1, got.sf) == (0.0, 4.0, 3.0)


def test_names_from_read_mode_need_the_folder_rule(spark):
    rows = [("r", "U_2_u_1/S", 1, s, 1.0, 2.0, 3.0, True) for s in (1, 2)]
    rows.append(("r", "U_2_u/S", 1, 1, 1.0, 2.0, 3.0, True))
    assert R.response_rows(table(spark, rows), "u", 0.05).count() == 0
    assert R.response_rows(table(spark, rows), "u", 0.05, perturbed_by="folder").count() == 1
    assert R.base_results(table(spark, rows), perturbed_by="folder").count() == 1
    with pytest.raises(ValueError):
        R.response_rows(table(spark, rows), "u", 0.05, perturbed_by="name")


def test_repeats_double_the_sums_unless_dropped(spark):
    rows = sweep("u")
    twice = table(spark, rows + rows)
    want = {k: v["d_first"] for k, v in response(rows, "u", 0.05).items()}
    for dedupe, factor in ((False, 2), (True, 1)):
        got = R.response_rows(twice, "u", 0.05, dedupe=dedupe).collect()
        assert {(r.run_id, r.jobname, r.channel_id): r.d_first for r in got} == {k: v * factor for k, v in want.items()}


def test_converged_repeat_wins(spark):
    name = "./U_2_u/U_2_u_1/S"
    rows = [("r", name, 1, 1, 9.0, 9.0, 9.0, False), ("r", name, 1, 1, 1.0, 2.0, 3.0, True)]
    assert tuple(R.drop_repeats(table(spark, rows)).first())[4:] == (1.0, 2.0, 3.0, True)


def test_converged_only(spark):
    rows = sweep("u", us=(0, 2, 4, 6, 8))
    want = response([r for r in rows if r[-1]], "u", 0.05)
    got = R.response_rows(table(spark, rows), "u", 0.05, converged_only=True)
    assert got.count() == len(want) < len(response(rows, "u", 0.05))


def test_signed_values(spark):
    rows = [("r", "./U_-2_u/U_-2_u_1/S", 1, 1, 1.0, 2.0, 3.0, True)]
    assert R.response_rows(table(spark, rows), "u", 0.05).first().u is None
    assert R.response_rows(table(spark, rows), "u", 0.05, signed_u=True).first().u == -2.0


def test_views(spark):
    rows = R.response_rows(table(spark, sweep("alpha")), "alpha", 0.05)
    view = V.channel_view(rows, "alpha", 2)
    assert view.columns == ["run_id", "channel_id", "u", "alpha_pert", "n1_nf_alpha"]
    assert view.select("channel_id").distinct().collect() == [(2,)]
    once = V.alpha_columns(view)
    assert once.columns == ["run_id", "channel_id", "alpha_pert", "n1_nf_alpha"]
    assert V.alpha_columns(once).columns == once.columns
    assert sorted(r.channel_id for r in V.channels(rows).collect()) == [1, 2]


@pytest.mark.parametrize("job", ["u", "alpha"])
def test_mean_view(spark, job):
    rows = sweep(job) + sweep(job, run="hot", us=range(0, 40, 2), steps=8)
    groups = {}
    for (run, _name, channel), r in response(rows, job, 0.05).items():
        groups.setdefault((run, channel, r["u"]), []).append(r["n1_nf"])
    got = analyze_single(table(spark, rows), job, 0.05).means.collect()
    assert len(got) == len(groups)
    for r in got:
        values = groups[r.run_id, r.channel_id, r.u]
        assert same(r[f"n1_nf_{job}"], sum(values) / len(values))


def test_modes(spark):
    assert perturbation_values("both", 0.1, 0.2) == {"u": 0.1, "alpha": 0.2}
    assert perturbation_values("alpha", None, 0.2) == {"alpha": 0.2}
    for bad in (("both", 0.1, None), ("u", None, 0.1), ("all", 1, 1)):
        with pytest.raises(ValueError):
            perturbation_values(*bad)
    u = table(spark, sweep("u"))
    with pytest.raises(ValueError):
        analyze(u, None, u_step=0.05, alpha_step=0.05)
    with pytest.raises(ValueError):
        analyze(u, u, u_step=0.05, alpha_step=0.05, align="time")
    assert analyze(u, None, mode="u", u_step=0.05).means.columns == ["run_id", "channel_id", "u", "n1_nf_u"]


def test_step_filter_reaches_the_scan_and_only_needed_columns_are_read(spark, tmp_path):
    table(spark, sweep("u")).write.parquet(f"{tmp_path}/t")
    rows = R.response_rows(spark.read.parquet(f"{tmp_path}/t"), "u", 0.05)
    plan = V.mean_view(rows, "u")._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "spin" not in schema and "converged" not in schema and "last_scf" in schema
    assert plan.count("Exchange hashpartitioning") == 2
    one = V.channel_view(rows, "u", 1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(channel_id,1)" in one
    assert "PythonUDF" not in plan
