import os

from pyspark.sql import functions as F

from scfsweep.operators import blocks, logs
from scfsweep.operators import response as R
from scfsweep.sources import log_lines, tag_lines


def line(species, spin, value):
    return f"  {species:10d}  {spin:10d} Total: {value:19.14f}       Mz:"


def write_log(root, path, observations, finished=True, eol="\n", noise=0):
    full = f"{root}/{path}"
    os.makedirs(os.path.dirname(full), exist_ok=True)
    out = ["Total energy, E = -1.0", " something 1 1 Charge: 2.0"]
    for o in observations:
        out += ["x" * 80] * noise + [line(*o)]
    if finished:
        out.append("Finalisation time =      2.00 s")
    with open(full, "w", newline="") as f:
        f.write(eol.join(out) + eol)


def picks(spark, root):
    rows = logs.pick_observations(tag_lines(log_lines(spark, str(root)))).collect()
    return {
        (r.file.split("/logs/")[1], r.species, r.spin): (r.before_scf, r.first_scf, r.last_scf, r.n_obs, r.converged)
        for r in rows
    }


def test_picks_first_second_and_last(spark, tmp_path):
    root = f"{tmp_path}/logs"
    full = [(1, 1, 4.5), (1, 2, 2.25), (1, 1, 4.25), (1, 2, 2.5), (1, 1, 4.75), (1, 2, 2.125)]
    write_log(root, "full.castep", full)
    write_log(root, "crlf.castep", full, eol="\r\n")
    write_log(root, "one.castep", [(1, 1, 3.0)], finished=False)
    write_log(root, "two.castep", [(1, 1, 3.0), (1, 1, 4.0)])
    write_log(root, "eleven.castep", [(11, 1, 7.0), (1, 1, 1.0), (11, 1, 8.0), (1, 1, 2.0)], finished=False)
    write_log(root, "none.castep", [])
    write_log(root, "other.txt", full)
    got = picks(spark, root)
    for name in ("full.castep", "crlf.castep"):
        assert got[name, 1, 1] == (4.5, 4.25, 4.75, 3, True)
        assert got[name, 1, 2] == (2.25, 2.5, 2.125, 3, True)
    assert got["one.castep", 1, 1] == (3.0, None, 3.0, 1, False)
    assert got["two.castep", 1, 1] == (3.0, 4.0, 4.0, 2, True)
    assert got["eleven.castep", 11, 1] == (7.0, 8.0, 8.0, 2, False)
    assert got["eleven.castep", 1, 1] == (1.0, 2.0, 2.0, 2, False)
    assert len(got) == 8
    flags = logs.finished_logs(tag_lines(log_lines(spark, root))).collect()
    assert {r.file.split("/logs/")[1]: r.converged for r in flags} == {
        "full.castep": True,
        "crlf.castep": True,
        "one.castep": False,
        "two.castep": True,
        "eleven.castep": False,
        "none.castep": True,
    }


def test_a_log_split_over_many_tasks(spark, tmp_path):
    root = f"{tmp_path}/logs"
    observations = [(1 + i % 3, 1 + i % 2, float(i)) for i in range(600)]
    write_log(root, "long.castep", observations, noise=3)
    write_log(root, "short.castep", observations[:12])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        lines = log_lines(spark, root)
        assert lines.select("block").distinct().count() > 5
        got = picks(spark, root)
        numbered = logs.observations(tag_lines(lines)).filter(F.col("file").endswith("long.castep"))
        order = [r.value for r in numbered.filter("species = 2 and spin = 2").orderBy("position").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for species in (1, 2, 3):
        for spin in (1, 2):
            series = [v for s, p, v in observations if (s, p) == (species, spin)]
            assert got["long.castep", species, spin] == (series[0], series[1], series[-1], len(series), True)
    assert order == [v for s, p, v in observations if (s, p) == (2, 2)]


def test_absent_series_are_reported(spark, tmp_path):
    root = f"{tmp_path}/logs"
    write_log(root, "a.castep", [(1, 1, 3.0), (1, 1, 4.0), (3, 1, 9.0)])
    tagged = tag_lines(log_lines(spark, root))
    file = tagged.first().file
    expected = [(file, 2), ("/logs/nowhere.castep", 1), ("/logs/zero.castep", 0)]
    counts = spark.createDataFrame(expected, "file string, n_species int")
    rows = logs.complete_series(logs.pick_observations(tagged), counts).collect()
    got = {(r.file == file, r.species, r.spin): (r.before_scf, r.n_obs, r.converged) for r in rows}
    assert got == {
        (True, 1, 1): (3.0, 2, True),
        (True, 1, 2): (None, 0, True),
        (True, 2, 1): (None, 0, True),
        (True, 2, 2): (None, 0, True),
        (False, 1, 1): (None, 0, False),
        (False, 1, 2): (None, 0, False),
    }


def test_logs_become_result_rows(spark, tmp_path):
    root = f"{tmp_path}/logs"
    series = [(1, s, v) for v in (1.0, 2.0, 4.0) for s in (1, 2)]
    write_log(root, "run_a/U_2_u/SLAB.castep", series)
    write_log(root, "run_a/U_2_u/U_2_u_1/SLAB.castep", series)
    write_log(root, "run_b/U_4_u/U_4_u_2/SLAB.castep", series[:2], finished=False)
    picked = logs.pick_observations(tag_lines(log_lines(spark, root)))
    rows = logs.log_results(picked)
    names = {(r.run_id, r.jobname) for r in rows.collect()}
    assert names == {
        ("run_a", "./U_2_u/SLAB"),
        ("run_a", "./U_2_u/U_2_u_1/SLAB"),
        ("run_b", "./U_4_u/U_4_u_2/SLAB"),
    }
    assert logs.log_results(picked, keep_incomplete=False).filter("run_id = 'run_b'").count() == 0
    response = R.response_rows(rows.filter("run_id = 'run_a'"), "u", 0.05).first()
    assert (response.u, response.k, response.d_first, response.d_last) == (2, 1, 2.0, 6.0)


def test_species_count(spark):
    text = "%BLOCK HUBBARD_U\n eV\n\tFe 1 d: 0.5\n U 2 d: 1.2 f: 2.1\n%ENDBLOCK HUBBARD_U\n"
    files = spark.createDataFrame([("a", text), ("b", "empty")], "file string, text string")
    assert {r.file: r.n_species for r in blocks.species_count(files).collect()} == {"a": 2, "b": 0}


def test_plan_keeps_whole_logs_out_of_one_task(spark, tmp_path):
    root = f"{tmp_path}/logs"
    write_log(root, "a.castep", [(1, 1, 3.0)])
    plan = logs.pick_observations(tag_lines(log_lines(spark, root)))._jdf.queryExecution().executedPlan().toString()
    windows = [l for l in plan.split("\n") if "row_number()" in l]
    assert windows and all("block" in l for l in windows)
    assert plan.count("FileScan") == 1
