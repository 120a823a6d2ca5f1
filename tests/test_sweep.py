import pytest
from brute import SCHEMA, sweep

from scfsweep.operators import coverage as C
from scfsweep.operators import pairing as P
from scfsweep.operators import sweep as W
from scfsweep.sources import parse_folders


def arguments(spark, rows, schema="run_id string, seed string, job string"):
    return W.sweep_arguments(spark.createDataFrame(rows, schema))


def test_defaults_and_rejections(spark):
    schema = "run_id string, seed string, job string, u_end string, pert_step string, base_value string"
    rows = [
        ("a", "S", "U", "", None, "1e-7"),
        ("b", "S", "alpha", "4", "1e-1", None),
        ("c", "S", "x", "0.5", "big", "1"),
    ]
    a, b, c = arguments(spark, rows, schema).orderBy("run_id").collect()
    assert (a.job, a.u_start, a.u_step, a.u_end, float(a.pert_step)) == ("u", 0, 2, 12, 0.05)
    assert float(a.base_value) == 1e-7 and a.energy_tol == 1e-5 and a.rejected == ""
    assert (b.job, int(b.u_end), float(b.pert_step), float(b.base_value)) == ("alpha", 4, 0.1, 1e-8)
    assert c.rejected == "u_end,pert_step,job" and c.u_end is None
    assert W.accepted(arguments(spark, rows, schema)).count() == 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plan_of_one_run(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_plan(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def check_plan(spark):
    plan = W.sweep_plan(arguments(spark, [("r", "S", "u"), ("r", "S", "Alpha")]))
    rows = {(p.job, int(p.u), p.k): p for p in plan.collect()}
    assert len(rows) == 2 * 7 * 6
    base, step = rows["u", 2, 0], rows["u", 2, 3]
    assert base.jobname == "./U_2_u/S" and step.jobname == "./U_2_u/U_2_u_3/S"
    assert (base.u_text, base.alpha_text) == ("2.000000010000000", "0.000000010000000")
    assert (step.u_text, step.alpha_text) == ("2.000000010000000", "0.150000010000000")
    base, step = rows["alpha", 10, 0], rows["alpha", 10, 5]
    assert (base.u_text, base.alpha_text) == ("0.000000010000000", "10.000000010000000")
    assert (step.u_text, step.alpha_text) == ("0.000000010000000", "10.250000010000000")
    assert (base.tol, step.tol) == (1e-5, 1e-5 / 10) and step.tol_text == "1.000000e-06"
    assert step.jobname == "./U_10_alpha/U_10_alpha_5/S"


def test_swept_values_and_times(spark):
    schema = "run_id string, seed string, job string, base_value string"
    row = W.swept_values(W.perturbation_times(arguments(spark, [("r", "S", "u", "0.5")], schema))).first()
    assert row.times == 5
    assert [float(v) for v in row.u_values] == [0.5, 2.5, 4.5, 6.5, 8.5, 10.5, 12.5]
    assert [float(v) for v in row.alpha_values] == [0.55, 0.6, 0.65, 0.7, 0.75]


def test_plan_has_no_join(spark):
    plan = W.sweep_plan(arguments(spark, [("r", "S", "u")]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan and "Exchange" not in plan


def results(spark):
    rows = [r[:-1] + (r[1] != "./U_2_u/U_2_u_1/SLAB",) for r in sweep("u", us=(0, 2)) if r[1] != "./U_0_u/U_0_u_3/SLAB"]
    return spark.createDataFrame(rows, SCHEMA)


def test_coverage(spark):
    schema = "run_id string, seed string, job string, u_end string, pert_end string"
    args = arguments(spark, [("r1", "SLAB", "u", "2", "0.15")], schema)
    plan, found = W.sweep_plan(args), results(spark)
    status = {r.jobname: (r.status, r.n_rows) for r in C.coverage(plan, found).collect()}
    assert len(status) == 8
    assert status["./U_0_u/U_0_u_3/SLAB"] == ("missing", None)
    assert status["./U_2_u/U_2_u_1/SLAB"] == ("not_converged", 4)
    assert status["./U_2_u/SLAB"] == ("done", 4)
    pending = {r.jobname for r in C.pending_jobs(plan, found).collect()}
    assert pending == {"./U_0_u/U_0_u_3/SLAB", "./U_2_u/U_2_u_1/SLAB"}
    done = {r.jobname for r in C.done_jobs(plan, found).collect()}
    assert done == set(status) - pending and C.done_jobs(plan, found).count() == 6
    counts = {(r.job, r.status): r.n_jobs for r in C.coverage_summary(C.coverage(plan, found)).collect()}
    assert counts == {("u", "done"): 6, ("u", "missing"): 1, ("u", "not_converged"): 1}


def test_a_rerun_to_convergence_counts_as_done(spark):
    name = "./U_0_u/SLAB"
    rows = [("r1", name, 1, 1, 1.0, 1.0, 1.0, False), ("r1", name, 1, 1, 1.0, 1.0, 1.0, True)]
    assert C.job_states(spark.createDataFrame(rows, SCHEMA)).first().converged


def folders(spark, names):
    return parse_folders(spark.createDataFrame([(n,) for n in names], "folder string"))


def test_pairs_prefer_equal_settings(spark):
    alphas = [
        "A_alpha_0_2_12_0.05_0.05_0.25_STEPS_5",
        "A_alpha_0_2_12_0.01_0.05_0.25_STEPS_5",
        "A_alpha_0_2_12_0.05_0.10_0.25_STEPS_5",
        "B_alpha_0_2_8_0.05_0.05_0.25_STEPS_5",
        "D_alpha_0_2_12_0.05_0.10_0.25_STEPS_3",
        "E_alpha_0_2_12_0.05_0.05_0.50_STEPS_10",
    ]
    us = ["%s_u_0_2_12_0.05_0.05_0.25_STEPS_5" % s for s in "ABCDE"] + ["A_u_0_2_12_0.05_0.05_0.15_STEPS_3", "bad"]
    parsed = folders(spark, us + alphas)
    pairs = {r.u_folder: r.alpha_folder for r in P.pair_runs(parsed).collect()}
    assert pairs == {us[0]: alphas[0], us[4]: alphas[5], us[5]: alphas[1]}
    reasons = {r.u_folder: r.reason for r in P.unpaired_runs(parsed).collect()}
    assert reasons == {us[1]: "U range differs", us[2]: "no alpha run", us[3]: "perturbation step differs"}


def test_a_seed_with_many_folders_yields_one_row_per_u_folder(spark):
    us = [f"A_u_0_2_12_0.05_0.05_{i}_STEPS_{i}" for i in range(1, 200)]
    alphas = [f"A_alpha_0_2_12_0.05_0.05_{i}_STEPS_{i}" for i in range(100, 300)]
    pairs = {r.u_folder: r.alpha_folder for r in P.pair_runs(folders(spark, us + alphas)).collect()}
    assert len(pairs) == len(us)
    assert pairs[us[149]] == "A_alpha_0_2_12_0.05_0.05_150_STEPS_150"
    assert pairs[us[0]] == alphas[0]


def test_named_pairs(spark):
    u, a = "ZnO_u_0_2_12_0.05_0.05_0.25_STEPS_5", "ZnO_alpha_0_2_12_0.05_0.05_0.25_STEPS_5"
    rows = [
        (u, a),
        (u, a.replace("ZnO", "NiO")),
        (u, a.replace("_12_", "_14_")),
        (u, a.replace("0.05_0.25", "0.1_0.25")),
        (u, u),
        (u, "no"),
    ]
    requests = spark.createDataFrame(rows, "u_folder string, alpha_folder string")
    got = {r.alpha_folder: r.reason for r in P.check_pairs(requests).collect()}
    assert list(got[b] for _, b in rows) == [
        None,
        None,
        "U range differs",
        "perturbation step differs",
        "unreadable name",
        "unreadable name",
    ]


def test_coverage_of_a_finished_run_by_its_folder_name(spark):
    folder = "SLAB_u_0_2_4_0.05_0.05_0.15_STEPS_3"
    rows = [(folder,) + r[1:-1] + (True,) for r in sweep("u", us=(0, 2), steps=2, seed="other")]
    reread = [r[:1] + (r[1].split("/", 2)[2] if r[1].count("/") == 3 else r[1][2:],) + r[2:] for r in rows]
    plan = W.folder_plan(folders(spark, [folder, "unreadable"]))
    assert plan.count() == 3 * 4
    for results in (rows, reread):
        found = spark.createDataFrame(results, SCHEMA)
        status = {(int(r.u), r.k): r.status for r in C.coverage(plan, found, by="folder").collect()}
        assert len(status) == 12
        assert {k for k, v in status.items() if v == "done"} == {(u, k) for u in (0, 2) for k in (0, 1, 2)}
        assert C.pending_jobs(plan, found, by="folder").count() == 6 == C.done_jobs(plan, found, by="folder").count()
    assert C.done_jobs(plan, spark.createDataFrame(rows, SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        C.coverage(plan, found, by="u")
