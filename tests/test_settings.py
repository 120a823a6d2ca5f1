from pyspark.sql import functions as F

from scfsweep.operators import blocks as B
from scfsweep.operators import settings as P
from scfsweep.operators import sweep as W
from scfsweep.sources import cell_items, param_settings

U_ONLY = "%BLOCK HUBBARD_U\n Fe 1 d: 0.5\n U 2 d: 1.2 f: 2.1\n%ENDBLOCK HUBBARD_U\n"
BOTH = U_ONLY + "%BLOCK HUBBARD_ALPHA\n Fe 1 d: 0.1\n%ENDBLOCK HUBBARD_ALPHA\n"


def cells(spark):
    return cell_items(spark.createDataFrame([("one", U_ONLY), ("two", BOTH)], "file string, text string"))


def long(df):
    return sorted((r.file, r.block, r.element, r.orbital, r.value) for r in B.explode_items(df).collect())


def test_alpha_block_is_copied_only_where_absent(spark):
    got = long(cells(spark).withColumn("items", B.derive_alpha(F.col("items"), F.lit(9.0))))
    assert [g for g in got if g[1] == "ALPHA"] == [
        ("one", "ALPHA", "Fe", "d", 9.0),
        ("one", "ALPHA", "U", "d", 9.0),
        ("one", "ALPHA", "U", "f", 9.0),
        ("two", "ALPHA", "Fe", "d", 9.0),
    ]
    assert [g[4] for g in got if g[1] == "U"] == [0.5, 1.2, 2.1] * 2


def test_base_and_perturbed_values(spark):
    base = cells(spark).withColumn("items", B.prepare_base(F.col("items"), F.lit(3.0), F.lit(0.5)))
    assert {(g[1], g[4]) for g in long(base)} == {("U", 3.0), ("ALPHA", 0.5)}
    moved = base.withColumn("items", B.perturb(F.col("items"), F.lit(0.75)))
    assert {(g[1], g[4]) for g in long(moved)} == {("U", 3.0), ("ALPHA", 0.75)}


def test_update_where_and_first_value(spark):
    changed = cells(spark).withColumn(
        "items", B.update_where(F.col("items"), lambda i: i["element"] == "U", F.lit(3.2))
    )
    assert {(g[2], g[4]) for g in long(changed) if g[1] == "U"} == {("Fe", 0.5), ("U", 3.2)}
    firsts = cells(spark).select("file", B.first_value(F.col("items")).alias("a"), B.first_value(F.col("items"), "U").alias("u"))
    assert {tuple(r) for r in firsts.collect()} == {("one", None, 0.5), ("two", 0.1, 0.5)}


def test_item_text(spark):
    item = F.transform("items", B.item_text)
    got = {r.file: r.lines for r in cells(spark).select("file", item.alias("lines")).collect()}
    assert got["one"] == [
        "  Fe 1 d:    0.500000000000000",
        "   U 2 d:    1.200000000000000",
        "   U 2 f:    2.100000000000000",
    ]


def test_planned_items(spark):
    runs = spark.createDataFrame([("one", "S", "alpha"), ("two", "S", "u")], "run_id string, seed string, job string")
    plan = W.sweep_plan(W.sweep_arguments(runs))
    planned = B.planned_items(plan, cells(spark).withColumnRenamed("file", "run_id"))
    assert planned.count() == 2 * 7 * 6
    row = planned.filter("job = 'u' and u = 4 and k = 2").first()
    assert {(i.block, i.value) for i in row["items"]} == {("U", 4.00000001), ("ALPHA", 0.10000001)}


PARAM = """task : SinglePoint
continuation : other
grid_scale :        2.0
fine_grid_scale :        3.0
elec_energy_tol :   5.0e-007
spin_fix :        6
"""


def test_settings_before_and_after(spark):
    table = param_settings(spark.createDataFrame([("a", PARAM), ("b", PARAM)], "file string, text string"))
    before = P.settings_before(table, "1e-5")
    rows = [(r.key, r.value, r.value_num) for r in before.filter("file = 'a'").orderBy("pos").collect()]
    assert rows == [
        ("task", "SinglePoint", None),
        ("grid_scale", "1.750000000000000", 1.75),
        ("elec_energy_tol", "1e-5", 1e-5),
        ("spin_fix", "6", 6.0),
    ]
    after = P.settings_perturbed(before)
    rows = {r.key: (r.pos, r.value) for r in after.filter("file = 'b'").collect()}
    assert rows["continuation"] == (1, "default") and rows["elec_energy_tol"][1] == "1.000000e-06"
    assert after.count() == before.count() + 2
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == 1


def test_absent_settings_are_written_on_request(spark):
    table = param_settings(spark.createDataFrame([("a", "task : SinglePoint\ncomment : x"), ("b", PARAM)], "file string, text string"))
    before = P.settings_before(table, "1e-5", add_missing=True)
    rows = [(r.key, r.value) for r in before.filter("file = 'a'").orderBy("pos").collect()]
    assert rows == [("task", "SinglePoint"), ("comment", "x"), ("elec_energy_tol", "1e-5"), ("grid_scale", "1.750000000000000")]
    assert before.filter("file = 'b'").count() == 4


def test_cells_join_runs_before_their_plan(spark):
    runs = W.sweep_arguments(spark.createDataFrame([(r, "S", j) for r in ("one", "two", "none", None) for j in ("alpha", "u")], "run_id string, seed string, job string"))
    of_run = cells(spark).withColumnRenamed("file", "run_id")
    early = B.planned_items(W.sweep_plan(B.with_cells(runs, of_run)))
    columns = ["run_id", "jobname", "items", "cell_status"]
    late = B.planned_items(W.sweep_plan(runs), of_run).select(columns)
    assert early.count() == late.count() == 8 * 7 * 6
    assert early.select(columns).exceptAll(late).count() == 0
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    # the jobs are made above the join, so it moves a row per run
    assert plan.index("Generate") < plan.index("Join") and "Generate explode" not in plan[plan.index("Join") :]
