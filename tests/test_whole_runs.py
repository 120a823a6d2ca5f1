"""Run folders as they lie on disk, and that no run or row is lost on the way."""

import pytest

from scfsweep.operators import logs, merge, pairing, response, sweep
from scfsweep.plans import analyze, analyze_folders
from scfsweep.sources import parse_folders, read_results, read_run_results, run_folders
from scfsweep.streaming import append_stream, read_result_stream

HEADER = "Jobname,Channel ID,Spin,Before SCF,1st SCF,Last SCF,Converged"


def write(folder, job, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"result_{job}_final.csv").write_text("\n".join([HEADER, *rows]) + "\n")


def rows_of(job, us, steps, first, last, channel=1):
    """Two spins per job that add up to S0 = 0, S1 = first(u, k), SF = last(u, k)."""
    out = []
    for u in us:
        for k in steps:
            name = f"./U_{u}_{job}/U_{u}_{job}_{k}/S"
            out += [f"{name}, {channel}, {spin}, 0.0, {first(u, k) / 2}, {last(u, k) / 2}, true" for spin in (1, 2)]
    return out


# One channel, U = 0 and 2, steps 1 and 2. S1 - S0 = 0.5 and SF - S0 = 0.25 for all of job u, so its
# response is k*p*(2 - 4) = -2*k*p and the mean over both steps -3p. For alpha the numerator is k*p + U.
GOLDEN_U = {0: -3.0, 2: -3.0}
GOLDEN_ALPHA = {0: -3.0, 2: -3.0}


def tree(root, step, name="ZnO"):
    half, quarter = (lambda u, k: 0.5), (lambda u, k: 0.25)
    for job in ("u", "alpha"):
        write(root / f"{name}_{job}_0_2_2_{step}_{step}_{2 * step}_STEPS_2", job, rows_of(job, (0, 2), (1, 2), half, quarter))


def test_golden_means_by_hand(spark, tmp_path):
    tree(tmp_path, 0.05)
    u, alpha = (read_run_results(spark, str(tmp_path), job) for job in ("u", "alpha"))
    both = analyze(u, None, mode="u", u_step=0.05).means
    assert {r.u: r.n1_nf_u for r in both.collect()} == pytest.approx({k: v * 0.05 for k, v in GOLDEN_U.items()})
    one = analyze(None, alpha, mode="alpha", alpha_step=0.05).means
    # (k*p + U) * (2 - 4), averaged over k = 1, 2
    assert {r.u: r.n1_nf_alpha for r in one.collect()} == pytest.approx({0: -0.15, 2: -4.15})


@pytest.mark.parametrize("align", ["position", "key"])
def test_folders_of_two_roots_with_own_increments(spark, tmp_path, align):
    tree(tmp_path / "a", 0.05)
    tree(tmp_path / "b", 0.1)
    tree(tmp_path / "b", 0.1, name="NiO")
    means = analyze_folders(spark, [str(tmp_path / "a"), str(tmp_path / "b")], align=align).means.collect()
    assert len(means) == 3 * 2 and len({r.run_id for r in means}) == 3
    for r in means:
        step = 0.05 if "/a/" in r.run_id else 0.1
        assert r.n1_nf_u == pytest.approx(-3 * step) and r.n1_nf_alpha == pytest.approx(-3 * step - 2 * r.u)


def test_equal_names_under_two_roots_stay_apart(spark, tmp_path):
    for root, value in (("a", 1.0), ("b", 2.0)):
        write(tmp_path / root / "ZnO_u_1", "u", [f"./U_0_u/U_0_u_1/S,1,1,0,{value},{value},true"])
    rows = read_run_results(spark, [str(tmp_path / "a"), str(tmp_path / "b")], "u")
    assert sorted(r.s1 for r in response.spin_sums(response.select_results(rows)).collect()) == [1.0, 2.0]
    by_pattern = read_results(spark, f"{tmp_path}/*/ZnO_u_1/result_u_final.csv")
    assert by_pattern.select("run_id").distinct().count() == 2


def test_runs_that_pair_with_none_are_named(spark):
    names = [
        "A_u_0_2_12_0.05_0.05_0.25_STEPS_5", "A_alpha_0_2_12_0.05_0.05_0.25_STEPS_5", "A_alpha_0_2_12_0.05_0.05_0.25_STEPS_6",
        "B_alpha_0_2_12_0.05_0.05_0.25_STEPS_5",
    ]
    parsed = parse_folders(spark.createDataFrame([(n,) for n in names], "folder string"))
    assert {(r.alpha_folder, r.reason) for r in pairing.unpaired_alpha_runs(parsed).collect()} == {
        (names[2], "another one was taken"),
        (names[3], "no U run fits"),
    }


def test_one_bad_folder_name_spoils_nothing(spark):
    names = ["A_u_0_2_4_0.05_0.05_0.25_STEPS_99999999999", "A_u_0_2_4_0.05_0.05_0.25_STEPS_2000000000", "A_u_4_2_0_0.05_0.05_0.25_STEPS_1", "A_u_0_2_4_0.05_0.05_0.25_STEPS_1"]
    parsed = parse_folders(spark.createDataFrame([(n,) for n in names], "folder string"))
    assert {r.folder: r.missing for r in parsed.collect()} == {names[0]: "times", names[1]: "times", names[2]: "step_u", names[3]: ""}
    assert sweep.folder_plan(parsed).count() == 3 * 2


def test_runs_in_are_accepted_or_rejected(spark):
    given = [("a", "0", "2", "4", "0.05"), ("b", "4", "2", "0", "0.05"), ("c", "0", "0", "4", "0.05"), ("d", "0", "1", "10000000000", "0.05"), ("e", "0", "2", "4", "1e-15"), ("f", "0", "1", "9999999", "0.05"), ("g", "x", "2", "4", "0.05")]
    runs = spark.createDataFrame([(r, "S", "u", *a) for r, *a in given], "run_id string, seed string, job string, u_start string, u_step string, u_end string, pert_step string")
    checked = sweep.sweep_arguments(runs)
    bad = {r.run_id: r.rejected for r in sweep.rejected(checked).collect()}
    assert bad == {"b": "u_step", "c": "u_step", "d": "u_end", "e": "pert_step", "f": "u_step", "g": "u_start"}
    good = {r.run_id for r in sweep.sweep_grid(sweep.accepted(checked)).select("run_id").distinct().collect()}
    assert good | set(bad) == {r for r, *_ in given} and not good & set(bad)


def response_table(spark, job, names):
    return spark.createDataFrame([("r", n, 1, 0, 1, 0.05, float(k)) for k, n in enumerate(names)], "run_id string, jobname string, channel_id int, u int, k int, pert double, n1_nf double")


def test_key_merge_never_fans_out(spark):
    sides = [response_table(spark, job, [f"./U_0.{i}_{job}/U_0.{i}_{job}_1/S" for i in range(6)]) for job in ("u", "alpha")]
    rows = merge.merge_by_key(*sides).collect()
    assert len(rows) == 6 and all(r.n1_nf_u == r.n1_nf_alpha for r in rows)
    twice = [response_table(spark, job, [f"./U_0_{job}/U_0_{job}_1/S", f"U_0_{job}/U_0_{job}_1/S"]) for job in ("u", "alpha")]
    assert merge.merge_by_key(*twice).count() == 1


def test_position_follows_the_files(spark, tmp_path):
    """With the line order kept, U = 4, 0, 2 of job u meets alpha's own first, second and third row."""
    for job, us in (("u", (4, 0, 2)), ("alpha", (0, 2, 4))):
        write(tmp_path / "R", job, rows_of(job, us, (1,), lambda u, k: 0.5 + u, lambda u, k: 0.25 + u))
    sides = [response.response_rows(read_run_results(spark, str(tmp_path), job, keep_order=True), job, 0.05) for job in ("u", "alpha")]
    merged = merge.merge_by_position(*sides)
    expected = {r.u: r.n1_nf for r in sides[1].collect()}
    got = {r.position: (r.u, r.n1_nf_alpha) for r in merged.collect()}
    assert got == {1: (4, expected[0]), 2: (0, expected[2]), 3: (2, expected[4])}


def test_streams_are_as_strict_as_batch(spark, tmp_path):
    bad = {"value": [HEADER, "./U_0_u/U_0_u_1/S,1,1,0.5,oops,0.5,true"], "header": [HEADER.replace("1st SCF,Last SCF", "Last SCF,1st SCF"), "./U_0_u/U_0_u_1/S,1,1,0.5,1,2,true"]}
    for name, lines in bad.items():
        folder = tmp_path / name / "in" / "R"
        folder.mkdir(parents=True)
        (folder / "result_u_final.csv").write_text("\n".join(lines) + "\n")
        stream = read_result_stream(spark, f"{tmp_path}/{name}/in/*")
        with pytest.raises(Exception):
            append_stream(stream, f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/check")


def test_logs_of_a_seed_named_like_a_job_folder(spark):
    files = ["/logs/U_u_0_2_12_0.05_0.05_0.25_STEPS_5/U_2_u/U.castep", "/logs/U_u_0_2_12_0.05_0.05_0.25_STEPS_5/U_2_u/U_2_u_1/U.castep"]
    table = spark.createDataFrame([(f, 1, 1, 0.0, 0.0, 0.0, 2, True) for f in files], "file string, species int, spin int, before_scf double, first_scf double, last_scf double, n_obs long, converged boolean")
    rows = {(r.run_id, r.jobname) for r in logs.log_results(table).collect()}
    assert rows == {("U_u_0_2_12_0.05_0.05_0.25_STEPS_5", "./U_2_u/U"), ("U_u_0_2_12_0.05_0.05_0.25_STEPS_5", "./U_2_u/U_2_u_1/U")}


def test_paired_means_scan_the_results_twice(spark, tmp_path):
    from scfsweep.plans import catalog

    keys = [(o, o % 9, o % 3, o % 7, "R" if o % 2 else "A") for o in range(400)]
    row = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"
    lines = spark.createDataFrame(keys, row).selectExpr("*", "10.0d as l_quantity", "0.02d as l_tax", "l_linenumber / 50d as l_discount", "'F' as l_linestatus")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    means = catalog.queries()["paired_means"](spark, str(tmp_path))
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert sum("l_orderkey" in line for line in plan.splitlines() if "Relation [" in line) == 2
    assert {r.run_id.split("_")[0] for r in means.collect()} == {"P0", "P1", "P2"}
