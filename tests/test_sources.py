import os
import shutil

import pytest
from brute import SCHEMA, sweep
from pyspark.sql import functions as F

from scfsweep import sources as S
from scfsweep.operators import response as R
from scfsweep.plans import append_results, reset_results
from scfsweep.schema import RESULT_HEADER


def write_csv(path, rows, header=True, sep=","):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        if header:
            out.write(sep.join(RESULT_HEADER) + "\n")
        for row in rows:
            out.write(sep.join(str(x).lower() if isinstance(x, bool) else str(x) for x in row[1:]) + "\n")


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_runs_are_told_by_their_folder(spark, tmp_path):
    rows = {run: sweep("u", run=run) for run in ("ZnO_u_0_2", "a b+c%d")}
    for run, table in rows.items():
        write_csv(f"{tmp_path}/{run}/result_u_final.csv", table)
    write_csv(f"{tmp_path}/ZnO_u_0_2/result_alpha_final.csv", sweep("alpha"))
    got = S.read_run_results(spark, str(tmp_path), "u")
    assert bag(got) == sorted(rows["ZnO_u_0_2"] + rows["a b+c%d"])
    assert S.read_run_results(spark, str(tmp_path), "alpha").count() == len(sweep("alpha"))
    with pytest.raises(ValueError):
        S.read_run_results(spark, str(tmp_path), "beta")


def test_blanks_after_commas(spark, tmp_path):
    write_csv(f"{tmp_path}/r/result_u_final.csv", sweep("u", run="r"), sep=", ")
    assert bag(S.read_run_results(spark, str(tmp_path), "u")) == sorted(sweep("u", run="r"))


def test_wrong_header_is_refused(spark, tmp_path):
    path = f"{tmp_path}/r/result_u_final.csv"
    write_csv(path, sweep("u"))
    text = open(path).read().replace("Channel ID,Spin", "Spin,Channel ID")
    open(path, "w").write(text)
    with pytest.raises(Exception, match="header"):
        S.read_results(spark, path).collect()


def test_bad_rows(spark, tmp_path):
    path = f"{tmp_path}/r/result_u_final.csv"
    write_csv(path, sweep("u"))
    with open(path, "a") as out:
        out.write("./U_0_u/U_0_u_9/SLAB,1,1,0.5,true\n")
    with pytest.raises(Exception):
        S.read_results(spark, path).collect()
    n = len(sweep("u"))
    assert S.read_results(spark, path, on_bad="drop").count() in (n, n + 1)
    lenient = S.read_results(spark, path, on_bad="null")
    assert len(lenient.collect()) == n + 1
    assert lenient.filter("last_scf is null").count() == 1


def test_parts_without_header(spark, tmp_path):
    rows = sweep("u", run="r")
    for u in (0, 2, 4):
        part = [r for r in rows if f"U_{u}_u" in r[1]]
        write_csv(f"{tmp_path}/r/U_{u}_u/result_u.csv", part, header=False)
    whole = S.read_run_parts(spark, str(tmp_path), "u")
    assert bag(whole) == sorted(rows)
    one = S.read_results(spark, f"{tmp_path}/r/U_0_u/result_u.csv", header=False, run_level=2)
    assert S.append_parts([one, one]).count() == 2 * one.count()


def test_first_seen_order_over_many_splits(spark, tmp_path):
    rows = sweep("u", run="r", channels=(2, 1), us=(4, 0, 2), steps=40)
    write_csv(f"{tmp_path}/r/result_u_final.csv", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = S.read_run_results(spark, str(tmp_path), "u", keep_order=True)
        assert read.rdd.getNumPartitions() > 3
        ordered = R.in_sweep_order(R.response_rows(read, "u", 0.05))
        got = [(r.jobname, r.channel_id) for r in ordered.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = list(dict.fromkeys((r[1], r[2]) for r in rows if r[1].count("/") == 3))
    assert got == want


def test_append_and_reset(spark, tmp_path):
    path = f"{tmp_path}/run/result"
    table = spark.createDataFrame(sweep("u"), SCHEMA)
    reset_results(spark, path)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert [open(f"{path}/{f}").read().strip() for f in files] == [",".join(RESULT_HEADER)]
    append_results(table, path)
    append_results(table, path)
    assert S.read_results(spark, path).count() == 2 * table.count()
    reset_results(spark, path)
    assert S.read_results(spark, path).count() == 0


def test_conform(spark):
    table = spark.createDataFrame(sweep("u"), SCHEMA).withColumn("spin", F.col("spin").cast("string"))
    assert dict(S.conform(table).dtypes)["spin"] == "int"


def test_folder_names(spark):
    names = [
        "ZnO_u_0_2_12_0.05_0.05_0.25_STEPS_5",
        "my_slab_Alpha_0_2_12_0.05_0.05_0.25_STEPS_5",
        "ZnO_u_0_2_12_0.05_0.05_0.25_5",
        "ZnO_beta_0_2_12_0.05_0.05_0.25_STEPS_5",
        "ZnO_u_0_x_12_0.05_0.05_0.25_STEPS_5.5",
        "short",
    ]
    parsed = S.parse_folders(spark.createDataFrame([(n,) for n in names], "folder string"))
    rows = {r.folder: r for r in parsed.collect()}
    good = rows[names[0]]
    assert (good.seed, good.job, good.init_u, good.step_u, good.final_u) == ("ZnO", "u", 0, 2, 12)
    assert (good.pert_init, good.pert_step, good.pert_final, good.times) == (0.05, 0.05, 0.25, 5)
    assert rows[names[1]].seed == "my_slab" and rows[names[1]].job == "alpha"
    assert [rows[n].valid for n in names] == [True, True, False, False, False, False]
    assert rows[names[3]].missing == "job"
    assert rows[names[4]].missing == "step_u,times"
    assert rows["short"].missing == "job,init_u,step_u,final_u,times"


def test_run_folders_are_found(spark, tmp_path):
    for run in ("A_u_0_2_4_0.05_0.05_0.25_STEPS_5", "B"):
        write_csv(f"{tmp_path}/{run}/result_u_final.csv", sweep("u"))
    shutil.copytree(f"{tmp_path}/B", f"{tmp_path}/B/nested")
    got = sorted(r.folder for r in S.run_folders(spark, str(tmp_path)).collect())
    assert got == ["A_u_0_2_4_0.05_0.05_0.25_STEPS_5", "B"]


CELL = """%BLOCK SPECIES_MASS
      Fe     55.8470001221
%ENDBLOCK SPECIES_MASS

%BLOCK HUBBARD_U
eV
      Fe       1       d: 0.500000000000000
       U 2  d: 1.2 f: 2.1
       O  P: 1e-1
%ENDBLOCK HUBBARD_U
{alpha}
QUANTIZATION_AXIS :    0.0000    0.0000    1.0000
"""
ALPHA = """%block hubbard_alpha
      Fe       1       d: 0.25
%endblock hubbard_alpha
"""


def test_cell_blocks(spark, tmp_path):
    (tmp_path / "a.cell").write_text(CELL.format(alpha=""))
    (tmp_path / "b.cell").write_bytes(CELL.format(alpha=ALPHA).replace("\n", "\r\n").encode())
    (tmp_path / "c.cell").write_text("nothing here")
    (tmp_path / "x.castep").write_text(CELL)
    files = S.input_files(spark, str(tmp_path), ".cell")
    items = {r.file.rsplit("/", 1)[1]: [tuple(i) for i in r["items"]] for r in S.cell_items(files).collect()}
    u = [
        ("U", 1, "Fe", 1, "d", 0.5),
        ("U", 2, "U", 2, "d", 1.2),
        ("U", 2, "U", 2, "f", 2.1),
        ("U", 3, "O", None, "p", 0.1),
    ]
    assert items == {"a.cell": u, "b.cell": u + [("ALPHA", 1, "Fe", 1, "d", 0.25)], "c.cell": []}


def test_products_are_not_inputs(spark, tmp_path):
    for name in ("a.cell", "a.param", "a.castep", "log_u.txt", "result.csv", "a.xsd", "a.xms"):
        (tmp_path / name).write_text(name)
    got = sorted(r.text for r in S.input_files(spark, str(tmp_path)).collect())
    assert got == ["a.cell", "a.param"]


def test_param_settings(spark, tmp_path):
    text = "task : SinglePoint\r\ncomment : a: b\r\n\r\n!continuation : default\r\nno colon\r\nspin :        4\r\n"
    text += "elec_energy_tol :   5.000000000000000e-007\r\nempty :\r\n"
    (tmp_path / "a.param").write_bytes(text.encode())
    got = S.param_settings(S.input_files(spark, str(tmp_path), ".param")).orderBy("pos").collect()
    assert [(r.pos, r.key, r.value, r.value_num) for r in got] == [
        (1, "task", "SinglePoint", None),
        (2, "comment", "a: b", None),
        (6, "spin", "4", 4.0),
        (7, "elec_energy_tol", "5.000000000000000e-007", 5e-7),
        (8, "empty", "", None),
    ]


def test_results_at_any_depth(spark, tmp_path):
    from scfsweep.sources import read_results

    for run, part in (("r1", "U_0_u"), ("r1", "U_2_u"), ("r2", "U_0_u")):
        folder = tmp_path / run / part
        folder.mkdir(parents=True)
        (folder / "result_u.csv").write_text("./U_0_u/S, 1, 2, 1.0, 2.0, 3.0, true\n")
    options = {"header": False, "run_level": 2, "by_name": True}
    deep = read_results(spark, str(tmp_path), any_depth=True, **options)
    by_pattern = read_results(spark, f"{tmp_path}/*/*", **options)
    assert sorted(map(tuple, deep.collect())) == sorted(map(tuple, by_pattern.collect()))
    assert sorted(r.run_id for r in deep.collect()) == ["r1", "r1", "r2"]
