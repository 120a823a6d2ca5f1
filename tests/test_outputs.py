import csv
import glob

import pytest
from brute import SCHEMA, same, sweep

from scfsweep.operators import series
from scfsweep.operators import response as R
from scfsweep.plans import analyze, analyze_single, export_analysis, write_means, write_total_view
from scfsweep.plans.export import RUN_CHANNEL
from scfsweep.scratch import scratch_folder


def tables(spark, runs=("r1", "r2")):
    return [
        spark.createDataFrame([row for run in runs for row in sweep(job, run=run)], SCHEMA) for job in ("u", "alpha")
    ]


def read(folder):
    out = []
    for path in sorted(glob.glob(f"{folder}/part-*.csv")):
        with open(path) as f:
            rows = list(csv.reader(f))
        out.append(rows)
    return out


def test_single_mode_files(spark, tmp_path):
    one = analyze_single(tables(spark)[1], "alpha", 0.05)
    folder = export_analysis(one, str(tmp_path))
    assert folder.endswith("plot_Alpha")
    total = read(f"{folder}/sorted_Alpha")
    published = ["Channel ID", "U", "S1-S0", "SF-S0", "alpha/S1-S0", "alpha/SF-S0", "alpha_pert", "n1-nF"]
    assert total[0][0] == ["run_id"] + published
    order = [(r[0], int(r[2]), float(r[7]), int(r[1])) for t in total for r in t[1:]]
    assert len(order) == 36 and order == sorted(order)
    view = read(f"{folder}/channel_total/channel_id=2")
    assert view[0][0] == ["run_id", "Channel ID", "U", "alpha_pert", "n1-nF_Alpha"]
    assert sum(len(t) - 1 for t in view) == 18 and {r[1] for t in view for r in t[1:]} == {"2"}
    mean = read(f"{folder}/channel_mean_Alpha/channel_id=1")
    assert mean[0][0] == ["run_id", "U", "n1-nF_Alpha"]
    assert [(r[0], r[1]) for t in mean for r in t[1:]] == [(run, u) for run in ("r1", "r2") for u in ("0", "2", "4")]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_both_mode_files_of_each_run(spark, tmp_path):
    both = analyze(*tables(spark), u_step=0.05, alpha_step=0.05)
    folder = export_analysis(both, str(tmp_path), folders=RUN_CHANNEL)
    want = {(r.run_id, r.channel_id, str(r.u)): (r.n1_nf_u, r.n1_nf_alpha) for r in both.means.collect()}
    seen = {}
    for run in ("r1", "r2"):
        for channel in (1, 2):
            (rows,) = read(f"{folder}/channel_mean/run_id={run}/channel_id={channel}")
            assert rows[0] == ["U", "n1-nF_U", "n1-nF_Alpha"]
            assert [r[0] for r in rows[1:]] == ["0", "2", "4"]
            seen.update({(run, channel, r[0]): (float(r[1]), float(r[2])) for r in rows[1:]})
    assert seen.keys() == want.keys()
    assert all(same(a, b, 1e-12) for k in want for a, b in zip(seen[k], want[k]))


def test_folders_are_a_choice(spark, tmp_path):
    one = analyze_single(tables(spark)[0], "u", 0.05)
    write_means(one.means, f"{tmp_path}/m", folders=())
    assert read(f"{tmp_path}/m")[0][0] == ["run_id", "Channel ID", "U", "n1-nF_U"]
    write_total_view(one.rows["u"], "u", f"{tmp_path}/t", folders=("run_id",))
    assert read(f"{tmp_path}/t/run_id=r1")[0][0][:2] == ["Channel ID", "U"]


def test_many_runs_make_few_files(spark, tmp_path):
    table = spark.createDataFrame([row for i in range(200) for row in sweep("u", run=f"r{i}")], SCHEMA)
    write_means(analyze_single(table, "u", 0.05).means, f"{tmp_path}/m")
    assert len(glob.glob(f"{tmp_path}/m/*/part-*.csv")) <= 2 + 8


def test_series(spark):
    u, alpha = tables(spark, ("r1",))
    both = analyze(u, alpha, u_step=0.05, alpha_step=0.05, align="key")
    long = series.series_long(both.means).collect()
    assert len(long) == 2 * 2 * 3 and {r.series for r in long} == {"n1-nF_U", "n1-nF_Alpha"}
    for r in series.series_arrays(both.means).collect():
        points = sorted((p.u, p.y) for p in long if (p.channel_id, p.series) == (r.channel_id, r.series))
        assert r.xs == ["0", "2", "4"]
        assert all(same(a, b[1], 1e-12) for a, b in zip(r.ys, points))


def test_missing_points_stay_aligned_unless_dropped(spark):
    means = spark.createDataFrame(
        [("r", 1, 10, None), ("r", 1, 2, 5.0), ("r", 1, 4, 6.0)], "run_id string, channel_id int, u int, n1_nf_u double"
    )
    row = series.series_arrays(means).first()
    assert (row.series, row.xs, row.ys) == ("n1-nF_U", ["2", "4", "10"], [5.0, 6.0, None])
    assert series.series_arrays(means, drop_missing=True).first().ys == [5.0, 6.0]


def test_sweep_order_without_kept_order(spark):
    rows = R.response_rows(tables(spark, ("r1",))[0], "u", 0.05)
    got = [(r.u, r.k, r.channel_id) for r in R.in_sweep_order(rows).collect()]
    assert got == sorted(got)


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two and one.startswith(base)


def test_scratch_folders_lie_in_the_named_folder_or_the_warehouse():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, name, *default):
            return self.values.get(name, *default)

    def folder(**values):
        class Session:
            conf = Conf({k.replace("_", "."): v for k, v in values.items()})

        return scratch_folder(Session(), "x").rpartition("/")[0]

    warehouse = {"spark_sql_warehouse_dir": "s3a://lake/warehouse"}
    assert folder(spark_checkpoint_dir="hdfs:///tmp/", **warehouse) == "hdfs:///tmp"
    assert folder(**warehouse) == "s3a://lake/warehouse/_scratch"
