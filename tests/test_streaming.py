import os

from brute import SCHEMA, same, sweep

from scfsweep.operators import response as R
from scfsweep.operators import views as V
from scfsweep.schema import RESULT_HEADER
from scfsweep.streaming import append_stream, latest, read_result_stream, running_rows, running_spin_sums, running_spins, take_snapshot


def drop_file(root, run, name, rows):
    os.makedirs(f"{root}/{run}", exist_ok=True)
    with open(f"{root}/{run}/.{name}", "w") as out:
        out.write(",".join(RESULT_HEADER) + "\n")
        for row in rows:
            out.write(",".join(str(x).lower() if isinstance(x, bool) else str(x) for x in row[1:]) + "\n")
    os.rename(f"{root}/{run}/.{name}", f"{root}/{run}/{name}")


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_stream_takes_each_file_once(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    first, second = sweep("u", run="r1"), sweep("u", run="r2")
    drop_file(source, "r1", "result_u.csv", first)
    stream = lambda: read_result_stream(spark, f"{source}/*")
    append_stream(stream(), target, state)
    append_stream(stream(), target, state)
    assert bag(spark.read.parquet(target)) == sorted(first)
    drop_file(source, "r2", "result_u.csv", second)
    append_stream(stream(), target, state)
    assert bag(spark.read.parquet(target)) == sorted(first + second)


def test_running_sums_equal_the_batch(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    rows = sweep("alpha", run="r1")
    for i in range(4):
        drop_file(source, "r1", f"part{i}.csv", rows[i::4])
        # One file per batch: sums of a job grow over several batches and restarts.
        running_spin_sums(read_result_stream(spark, f"{source}/*", files_per_batch=1), target, state)
        seen = [r for j in range(i + 1) for r in rows[j::4]]
        want = R.spin_sums(R.select_results(batch(spark, seen)))
        assert bag(latest(spark, target)) == bag(want)
    got = {tuple(r)[:3]: r[3] for r in V.mean_view(running_rows(spark, target, "alpha", 0.05), "alpha").collect()}
    want = V.mean_view(R.response_rows(batch(spark, rows), "alpha", 0.05), "alpha").collect()
    assert len(got) == len(want) and all(same(got[tuple(r)[:3]], r[3]) for r in want)


def test_repeated_rows(spark, tmp_path):
    source = f"{tmp_path}/in"
    rows = sweep("u", run="r1", us=(0, 2))
    drop_file(source, "r1", "a.csv", rows)
    drop_file(source, "r1", "b.csv", rows)
    stream = lambda: read_result_stream(spark, f"{source}/*", files_per_batch=1)
    running_spin_sums(stream(), f"{tmp_path}/sums", f"{tmp_path}/c1")
    doubled = R.spin_sums(R.select_results(batch(spark, rows + rows)))
    assert bag(latest(spark, f"{tmp_path}/sums")) == bag(doubled)
    running_spins(stream(), f"{tmp_path}/spins", f"{tmp_path}/c2")
    keys = ("run_id", "jobname", "channel_id", "spin")
    kept = latest(spark, f"{tmp_path}/spins", keys)
    assert bag(kept) == bag(R.drop_repeats(batch(spark, rows)))
    once = R.response_rows(kept, "u", 0.05).select(R.TOTAL_COLUMNS[1], "u", "k", "n1_nf")
    assert bag(once) == bag(R.response_rows(batch(spark, rows), "u", 0.05).select(R.TOTAL_COLUMNS[1], "u", "k", "n1_nf"))


def test_snapshots_replace_old_versions(spark, tmp_path):
    source, target, state, kept = (f"{tmp_path}/{n}" for n in ("in", "out", "state", "kept"))
    rows = sweep("u", run="r1")
    for i in range(4):
        drop_file(source, "r1", f"part{i}.csv", rows[i::4])
        running_spin_sums(read_result_stream(spark, f"{source}/*", files_per_batch=1), target, state)
        if i in (1, 2):
            assert take_snapshot(spark, target, kept, first=i == 1) == i
    want = bag(R.spin_sums(R.select_results(batch(spark, rows))))
    assert bag(latest(spark, target)) == want
    current = latest(spark, target, snapshots=kept)
    assert bag(current) == want
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert bag(running_rows(spark, target, "u", 0.05, kept)) == bag(R.response_rows(batch(spark, rows), "u", 0.05))
