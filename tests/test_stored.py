"""Results stored by run, and means refreshed for changed runs only."""

import glob
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import SCHEMA, sweep
from scfsweep import adapters
from scfsweep.operators.merge import merge_by_key, merged_mean
from scfsweep.operators.response import both_responses, response_rows
from scfsweep.plans import catalog, refresh
from scfsweep.plans.analyze import analyze_single
from scfsweep.plans.layout import store_by_run, stored_means
from scfsweep.plans.refresh import refresh_means, start_store, stored_run_means
from scfsweep.schema import RESULT_HEADER


def bag(df):
    return Counter(tuple(repr(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("columns", [("run_id",), ("run_id", "channel_id")])
def test_stored_rows_do_not_move(spark, columns):
    rows = [r for k in range(6) for job in ("u", "alpha") for r in sweep(job, run=f"r{k}")]
    table = spark.createDataFrame(rows, SCHEMA)
    name = "stored_" + "_".join(columns)
    store_by_run(table, name, 4, columns)
    try:
        found = stored_means(spark, name, 0.05, 0.1)
        want = merged_mean(merge_by_key(*[response_rows(table.filter(f"contains(jobname, '_{job}')"), job, step) for job, step in (("u", 0.05), ("alpha", 0.1))]))
        assert bag(found) == bag(want)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        spark.sql(f"drop table {name}")


@pytest.mark.parametrize("options", [{}, {"alpha_includes_u": False, "signed_u": True}, {"dedupe": True}])
def test_both_jobs_in_one_pass(spark, options):
    rows = sweep("u") + sweep("alpha") + sweep("u")[:5]
    table = spark.createDataFrame(rows, SCHEMA)
    got = both_responses(table, {"u": 0.05, "alpha": 0.1}, **options)
    columns = ["run_id", "jobname", "channel_id", "u", "k", "d_first", "d_last", "pert", "n1_nf"]
    for job, step in (("u", 0.05), ("alpha", 0.1)):
        want = response_rows(table.filter(f"contains(jobname, '_{job}_')"), job, step, **options)
        assert bag(got.filter(f"job = '{job}'").select(*columns)) == bag(want.select(*columns))


def write(root, run, rows, when):
    os.makedirs(f"{root}/{run}", exist_ok=True)
    path = f"{root}/{run}/result_u_final.csv"
    with open(path, "w") as out:
        out.write(",".join(RESULT_HEADER) + "\n")
        out.writelines(",".join(str(x).lower() if isinstance(x, bool) else str(x) for x in r[1:]) + "\n" for r in rows)
    os.utime(path, (when, when))


def test_only_changed_runs_are_read(spark, tmp_path):
    root, store = str(tmp_path / "runs"), str(tmp_path / "store")
    now = int(time.time()) - 1000
    rows = {f"r{k}": sweep("u", run=f"r{k}") for k in range(4)}
    for run, own in rows.items():
        write(root, run, own, now if run == "r0" else now - 50)
    start_store(spark, store)
    paths = f"{root}/*/result_u_final.csv"
    assert refresh_means(spark, paths, "u", 0.05, store) == 4
    rows["r1"] = rows["r1"][:20]
    rows["r5"] = sweep("u", run="r5", us=(0, 2))
    for run in ("r1", "r5"):
        write(root, run, rows[run], now + 100)
    # a file that isn't read may hold anything
    write(root, "r2", [("r2", "no", "row")], now - 50)
    # r0 is as old as the last one seen, and read again
    assert refresh_means(spark, paths, "u", 0.05, store) == 3
    want = analyze_single(spark.createDataFrame([r for own in rows.values() for r in own], SCHEMA), "u", 0.05).means
    found = stored_run_means(spark, store)
    from pyspark.sql import functions as F

    named = found.withColumn("run_id", F.substring_index("run_id", "/", -1)).select(*want.columns)
    assert bag(named) == bag(want)


def write_shared(root, folder, rows, when):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    path = f"{root}/{folder}/results.csv"
    with open(path, "w") as out:
        out.write(",".join(("run_id", *RESULT_HEADER)) + "\n")
        out.writelines(",".join(str(x).lower() if isinstance(x, bool) else str(x) for x in r) + "\n" for r in rows)
    os.utime(path, (when, when))


def test_runs_that_share_folders_are_read_by_folder(spark, tmp_path):
    root, store = str(tmp_path / "runs"), str(tmp_path / "store")
    now = int(time.time()) - 1000
    # r0 is in two folders, which makes it two runs
    rows = {(folder, run): sweep("u", run=run) for folder, runs in {"a": ("r0", "r1", "r2"), "b": ("r0", "r3"), "c": ("r4",)}.items() for run in runs}
    rows["b", "r0"] = rows["b", "r0"][:10]
    lines = lambda folder: [r for (own, _), of_run in rows.items() if own == folder for r in of_run]
    for folder, when in (("a", now - 50), ("b", now), ("c", now - 50)):
        write_shared(root, folder, lines(folder), when)
    start_store(spark, store)
    assert refresh_means(spark, f"{root}/*", "u", 0.05, store, shared=True) == 3
    # of a replaced file one run is gone, one has fewer rows and one is as it was
    rows["a", "r0"] = rows["a", "r0"][:20]
    del rows["a", "r1"]
    write_shared(root, "a", lines("a"), now + 100)
    # a file that isn't read may hold anything
    write_shared(root, "c", [("r4", "no", "row")], now - 50)
    # b is as old as the last one seen, and read again
    assert refresh_means(spark, f"{root}/*", "u", 0.05, store, shared=True) == 2
    named = [(f"{folder}/{run}", *r[1:]) for (folder, run), own in rows.items() for r in own]
    want = analyze_single(spark.createDataFrame(named, SCHEMA), "u", 0.05).means
    found = stored_run_means(spark, store)
    assert bag(found.select(*want.columns)) == bag(want)


def test_refreshed_means_write_no_file_for_each_run(spark, tmp_path):
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, l_discount double, l_returnflag string, l_linestatus string"
    lines = [(k % 11, 40 * (k % 70), k % 5, k % 6 + 1, float(k % 50 + 1), k % 9 / 100, k % 7 / 100, "RRA"[k % 13 % 3], "FO"[k % 2]) for k in range(3000)]
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{scratch}/runs-*"))
    found = catalog.queries()["refreshed_means"](spark, str(tmp_path))
    results = adapters.results(spark, str(tmp_path), "alpha")
    want = analyze_single(results, "alpha", catalog.STEP).means
    assert results.select("run_id").distinct().count() == 70
    assert bag(found.select(*want.columns)) == bag(want)
    (root,) = set(glob.glob(f"{scratch}/runs-*")) - before
    # as many folders as the session has shuffle partitions, rounded up to threes
    assert 1 < len(glob.glob(f"{root}/*=*")) <= int(spark.conf.get("spark.sql.shuffle.partitions")) + 2


def test_files_replaced_during_a_refresh_are_read_by_the_next(spark, tmp_path, monkeypatch):
    root, store = str(tmp_path / "runs"), str(tmp_path / "store")
    now = int(time.time()) - 1000
    rows = {f"r{k}": sweep("u", run=f"r{k}") for k in range(2)}
    for run, own in rows.items():
        write(root, run, own, now - 50)

    def meanwhile(results, *rest, **options):
        read = results.localCheckpoint()
        rows["r0"] = rows["r0"][:20]
        write(root, "r0", rows["r0"], now + 100)
        write(root, "r1", rows["r1"], now + 200)
        return analyze_single(read, *rest, **options)

    start_store(spark, store)
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "analyze_single", meanwhile)
        assert refresh_means(spark, f"{root}/*", "u", 0.05, store) == 2
    assert refresh_means(spark, f"{root}/*", "u", 0.05, store) == 2
    want = analyze_single(spark.createDataFrame([r for own in rows.values() for r in own], SCHEMA), "u", 0.05).means
    assert bag(stored_run_means(spark, store).withColumn("run_id", F.substring_index("run_id", "/", -1)).select(*want.columns)) == bag(want)
