"""Stored state: the log by local day, the roll-up, the snapshot, safe replacement and repeatable appends."""

import contextlib
import io
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import counted, d, rows, ts
from ledgermill import schemas
from ledgermill.plans import history, jobs, monitor, rollup, snapshot
from ledgermill.session import in_warehouse, stored
from ledgermill.sources import writers
from ledgermill.sources.joblog import append_jobs, changed_days, read_jobs
from test_monitoring import P, job, job_log

FIRST, SECOND = datetime(2024, 1, 20), datetime(2024, 1, 21)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def files(path):
    return sorted(os.path.join(folder, f) for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "jobs")
    days = [job(f"2024-01-{n:02d} 12:00:00", job_id=f"airflow_{n}", table=f"t{n % 3}") for n in range(5, 16)]
    night = job("2024-01-12 02:00:00", job_id="airflow_night", table="t9")  # 23:00 of the 11th
    append_jobs(job_log(spark, *days, night), path, FIRST)
    return path


def test_jobs_lie_in_the_folder_of_their_local_day(spark, log):
    read = read_jobs(spark, log)
    assert rows(read.filter("job_id = 'airflow_night'"), "dia_local") == [(d("2024-01-11"),)]
    costed = jobs.job_costs(read, "2024-01-20", days=8)
    assert "PartitionFilters: [isnotnull(dia_local" in plan(costed) and "dia_local" not in costed.columns
    plain = jobs.job_costs(spark.read.schema(schemas.JOB_LOG).parquet(log), "2024-01-20", days=8)
    assert counted(costed) == counted(plain) and costed.count() == 4
    runs = monitor.daily_runs(read, "2024-01-12", since="2024-01-11")
    assert "PartitionFilters: [isnotnull(dia_local" in plan(runs)
    assert counted(runs, "table_id", "day") == {("t9", d("2024-01-11")): 1, ("t2", d("2024-01-11")): 1, ("t0", d("2024-01-12")): 1}


def test_a_table_of_days_prunes_the_log_when_the_query_runs(spark, log):
    append_jobs(job_log(spark, job("2024-01-06 12:00:00", job_id="airflow_late")), log, SECOND)
    days = changed_days(spark, log, FIRST)
    assert rows(days) == [(d("2024-01-06"),)]
    found = rollup.of_days(read_jobs(spark, log), days)
    assert "dynamicpruning" in plan(found)
    assert {r[0] for r in rows(found, "job_id")} == {"airflow_6", "airflow_late"}
    # Nothing changed: nothing is read and nothing written.
    assert rows(changed_days(spark, log, SECOND)) == []


def test_the_roll_up_computes_restated_days_only(spark, log, tmp_path):
    path, read = str(tmp_path / "runs"), read_jobs(spark, log)
    whole = counted(schemas.conform(monitor.daily_runs(read, "2024-01-15"), schemas.DAILY_RUNS))
    rollup.refresh_runs(spark, read, path, ["2024-01-15"])
    assert counted(rollup.read_runs(spark, path)) == whole
    before = files(path)

    # A lost day comes back; the others keep their files.
    writers.remove_load_days(spark, path, [d("2024-01-10")], "day")
    assert rollup.read_runs(spark, path).count() == sum(whole.values()) - 1
    rollup.refresh_runs(spark, read, path, ["2024-01-10", "2024-01-11"])
    assert counted(rollup.read_runs(spark, path)) == whole
    assert {f for f in before if "2024-01-10" not in f and "2024-01-11" not in f} < set(files(path))
    restated = rollup.of_days(read, [d("2024-01-10"), d("2024-01-11")])
    assert "PartitionFilters" in plan(restated) and restated.select("dia_local").distinct().count() == 2

    # A day that has no jobs any more loses its rows; days before the lifetime are not stored.
    rollup.refresh_runs(spark, read.filter("dia_local <> '2024-01-10'"), path, ["2024-01-10"])
    assert rollup.read_runs(spark, path).filter("day = '2024-01-10'").count() == 0
    rollup.refresh_runs(spark, read, path, ["2024-01-10", "2021-12-31"])
    assert counted(rollup.read_runs(spark, path)) == whole
    rollup.refresh_runs(spark, read, path, changed_days(spark, log, SECOND))  # no day at all
    assert counted(rollup.read_runs(spark, path)) == whole

    # Late jobs of an old day.
    append_jobs(job_log(spark, job("2024-01-06 12:30:00", job_id="airflow_late")), log, SECOND)
    rollup.refresh_runs(spark, read_jobs(spark, log), path, changed_days(spark, log, FIRST))
    assert rows(rollup.read_runs(spark, path).filter("day = '2024-01-06'"), "table_id", "runs") in (
        [("t0", 1), ("t1", 1)], [("t1", 1), ("t0", 1)],
    )
    again = counted(schemas.conform(monitor.daily_runs(read_jobs(spark, log), "2024-01-15"), schemas.DAILY_RUNS))
    assert counted(rollup.read_runs(spark, path)) == again


def history_rows(spark, *data):
    made = [
        (P, "ds", table, d("2024-01-01"), True, False, False, ts(at), "airflow", ts(at), 1.0, 2.0, 0.5, 1, "novo", ts(at))
        for table, at in data
    ]
    return spark.createDataFrame(made, schemas.HISTORY)


def test_the_snapshot_replaces_changed_days_only(spark, tmp_path):
    kept, path, facts_path = (str(tmp_path / n) for n in ("history", "snapshot", "facts"))
    used = (P, [], ["service"])
    past = history_rows(spark, ("a", "2024-01-01 10:00:00"), ("b", "2024-01-02 10:00:00"), ("a", "2024-01-03 10:00:00"), ("c", "2024-01-04 10:00:00"))
    writers.replace_load_days(past, kept, "data_carga")
    log = spark.createDataFrame([("a", "ds", d("2024-01-01"), "ana@x"), ("b", "ds", d("2024-01-01"), "bo@x")], schemas.ACCESS_LOG)
    costs = spark.createDataFrame([(P, "ds", "c", 3.5)], schemas.TABLE_COSTS)

    def run(log, costs, days=()):
        stored_history = writers.read_stored(spark, kept, schemas.HISTORY)
        facts = snapshot.table_facts(log, costs, *used)
        changed = snapshot.refresh_snapshot(spark, stored_history, facts, path, facts_path, days, P)
        whole = history.daily_snapshot(stored_history, log, costs, *used)
        found = writers.read_stored(spark, path, schemas.SNAPSHOT)
        assert counted(found, *schemas.SNAPSHOT.names) == counted(whole, *schemas.SNAPSHOT.names)
        return [day.day for day in changed]

    assert run(log, costs) == [1, 2, 3, 4]
    before = files(path), files(facts_path)
    assert run(log, costs, [d("2024-01-03"), d("2024-01-09")]) == []
    assert (files(path), files(facts_path)) == before

    # A new last user of one table: only the days that show it.
    newer = log.union(spark.createDataFrame([("a", "ds", d("2024-01-05"), "cy@x")], schemas.ACCESS_LOG))
    assert run(newer, costs) == [1, 3]
    assert {f for f in before[0] if "01-02" in f or "01-04" in f} < set(files(path))
    # Another cost, and a cost that is no longer named.
    assert run(newer, spark.createDataFrame([(P, "ds", "b", 1.0)], schemas.TABLE_COSTS)) == [2, 4]
    # A changed history day, and one that is empty now.
    writers.replace_load_days(history_rows(spark, ("b", "2024-01-03 11:00:00")), kept, "data_carga")
    writers.remove_load_days(spark, kept, [d("2024-01-01")])
    last = spark.createDataFrame([(P, "ds", "b", 1.0)], schemas.TABLE_COSTS)
    assert run(newer, last, [d("2024-01-01"), d("2024-01-03")]) == [1, 3]


def test_a_failing_rename_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.replace_table(spark.range(3), path)
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = paths(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    with pytest.raises(Exception):
        writers.swap(system, paths(f"{tmp_path}/nothing-here"), place, paths(f"{tmp_path}/aside"))
    assert spark.read.parquet(path).count() == 3 and not os.path.exists(f"{tmp_path}/aside")

    class Refusing:
        def exists(self, place):
            return system.exists(place)

        def rename(self, one, two):
            return False if "fresh" in one.toString() else system.rename(one, two)

    writers.replace_table(spark.range(5), f"{tmp_path}/fresh")
    with pytest.raises(OSError, match="could not become"):
        writers.swap(Refusing(), paths(f"{tmp_path}/fresh"), place, paths(f"{tmp_path}/aside"))
    assert spark.read.parquet(path).count() == 3


def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = schemas._table(k=schemas.STRING, at=schemas.CLOCK)
    make = lambda *data: spark.createDataFrame([(k, ts(at)) for k, at in data], schema)
    writers.append_run(make(("a", "2024-01-01 10:00:00"), ("b", None)), path, schema, "r1", "at")
    writers.append_run(make(("c", "2024-01-02 10:00:00")), path, schema, "r2", "at")
    writers.append_run(make(("d", "2024-01-02 11:00:00")), path, schema, "r1", "at")
    found = writers.read_stored(spark, path, schema)
    assert counted(found, "k") == {("c",): 1, ("d",): 1}
    assert counted(writers.on_load_days(found, [d("2024-01-02")])) == {("c", ts("2024-01-02 10:00:00")): 1, ("d", ts("2024-01-02 11:00:00")): 1}
    with pytest.raises(ValueError, match="not in the table"):
        writers.append_run(stored(make(("e", None)).withColumn("more", F.lit(1))), path, schema, "r3", "at")


def test_form_lines_that_do_not_fit_are_kept_aside(spark, tmp_path):
    path, rejected = f"{tmp_path}/forms", f"{tmp_path}/rejected"
    os.makedirs(path)
    head = ",".join(schemas.RECEIPT_FORM.names)
    with open(f"{path}/a.csv", "w", encoding="utf-8") as file:
        file.write(f"{head}\naluguel,2024-01-05,2024-01-01,10.5\nx,2024-13-05,2024-01-01,1.0\n,,,\nshort,2024-01-05\nx,2024-01-05,2024-01-01,dez\n")
    with open(f"{path}/b.csv", "w", encoding="utf-8") as file:
        file.write(f"{head}\nçédille,2024-02-05,2024-02-01,-1\nlong,2024-01-05,2024-01-01,1.0,more\n")
    found = writers.load_forms(spark, path, schemas.RECEIPT_FORM, rejected)
    want = {
        ("aluguel", d("2024-01-05"), d("2024-01-01"), 10.5): 1, (None, None, None, None): 1,
        ("çédille", d("2024-02-05"), d("2024-02-01"), -1.0): 1,
    }
    assert counted(found) == want
    # A query that needs one column rejects the same lines.
    assert counted(found, "descricao") == {(k[0],): 1 for k in want}
    kept = spark.read.parquet(rejected)
    assert counted(kept, "arquivo") == {("a.csv",): 3, ("b.csv",): 1}
    assert "x,2024-13-05,2024-01-01,1.0" in {r[0] for r in rows(kept, "linha")}
    os.remove(f"{path}/b.csv")
    with open(f"{path}/a.csv", "w", encoding="utf-8") as file:
        file.write(f"{head}\naluguel,2024-01-05,2024-01-01,10.5\n")
    assert writers.load_forms(spark, path, schemas.RECEIPT_FORM, rejected).count() == 1
    assert spark.read.parquet(rejected).count() == 0
    with open(f"{path}/a.csv", "w", encoding="utf-8") as file:
        file.write("a,b,c,d\naluguel,2024-01-05,2024-01-01,10.5\n")
    with pytest.raises(Exception):
        writers.load_forms(spark, path, schemas.RECEIPT_FORM, rejected)


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    assert in_warehouse("file:/x/w", "local[8]") == "file:/x/w/_intermediate"
    assert in_warehouse("hdfs://n/w/", "yarn") == "hdfs://n/w/_intermediate"
    for warehouse in ("file:/x/w", "/x/w", "w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            in_warehouse(warehouse, "yarn")
