from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from helpers import counted, d, rows, ts
from ledgermill import schemas
from ledgermill.plans import access, history, inventory, jobs, monitor
from ledgermill.session import stored

P = "proj"

PREFIXES = ("service", "bio")


def job(start, job_id="job_1", parent=None, table="t1", dataset="ds", project=P, tb=1.0, kind="SELECT", seconds=90):
    """One job; ``start`` is UTC."""
    start = ts(start)
    billed = None if tb is None else int(tb * 1024**4)
    return (
        kind, "ana@x.example", job_id, "QUERY", start, datetime.fromtimestamp(start.timestamp() + seconds),
        "select 1", "DONE", billed, 1500, 0, parent, (project, dataset, table),
    )


def job_log(spark, *data):
    return spark.createDataFrame(list(data), schemas.JOB_LOG)


def detail(table, run, executor="airflow", cost=1.0, dataset="ds", project=P, access=None, size=1.0,
           modified="2024-01-01", flags=(True, False, False), storage=0.5, scan=5.0):
    return (
        project, dataset, table, 10.0, storage, size, scan, d(modified), "07", d(access), *flags,
        ts(run), executor, cost,
    )


def details(spark, *data):
    return spark.createDataFrame(list(data), schemas.DETAILS)


def test_job_costs_window_is_local_and_anonymous_tables_drop_out(spark):
    log = job_log(
        spark,
        job("2024-01-10 02:00:00", "old"),  # local 9 January
        job("2024-01-10 03:00:00", "new"),
        job("2024-01-11 03:00:00", "anon", table="anon123"),
        job("2024-01-11 03:00:00", "short", table="anon1"),
        job("2024-01-12 03:00:00", "listed", table="t2"),
    )
    got = jobs.job_costs(log, "2024-01-20", days=10)
    assert {r[0] for r in rows(got, "job_id")} == {"new", "short", "listed"}
    assert {r[0] for r in rows(jobs.job_costs(log, "2024-01-20", 10, tables=["t2"]), "job_id")} == {"listed"}
    one = got.filter("job_id = 'new'").first()
    assert one.start_time == datetime(2024, 1, 10, 0, 0)
    assert (one.time_in_seconds, one.tb_billed, one.cost_us_dol, one.total_slot) == (90, 1.0, 5.0, 1.5)
    assert got.columns == [
        "statement_type", "user_email", "job_id", "job_type", "start_time", "query", "state",
        "total_bytes_billed", "total_slot_ms", "transferred_bytes", "parent_job_id", "time_in_seconds",
        "tb_billed", "cost_us_dol", "total_slot", "project_id", "dataset_id", "table_id", "dataset",
        "dataset_others", "executor_anon_job", "executor_parent_cons_prog_job",
        "executor_parent_airflow_job", "executor_job", "dataset_id_job",
    ]


def test_job_extract_filters(spark):
    log = job_log(
        spark,
        job("2024-01-10 12:00:00", table="keep", dataset="_script1a2b"),
        job("2024-01-10 12:00:00", table="gone", kind="DELETE"),
        job("2024-01-10 12:00:00", table="unknown", kind=None),
        job("2024-01-10 12:00:00", table="far", project="other"),
        job("2024-01-10 12:00:00", table=None),
        job("2024-01-10 12:00:00", table="nods", dataset=None),
    )
    got = jobs.job_extract(jobs.job_costs(log, "2024-01-10"), P)
    assert rows(got) == [(P, "temp", "keep", datetime(2024, 1, 10, 9), "manual", 5.0)]


def test_table_inventory(spark):
    catalog = spark.createDataFrame(
        [
            (P, "ds", "t1", 5, 10_000_000_000, 0, 1_700_000_000_000, 1),
            (P, "ds", "t2", 5, 2_345_678_900_000, 0, 0, 3),
            (P, "ds", "t3", 5, None, 0, 0, 4),
        ],
        schemas.CATALOG,
    )
    got = {r.table_id: r for r in inventory.table_inventory(catalog, "2024-01-01 08:00:00").collect()}
    assert (got["t1"].size_mb, got["t1"].size_gb, got["t1"].pre_cost_storage) == (10000.0, 10.0, 0.0)
    assert (got["t2"].size_tb, got["t2"].pre_cost_us_dol, got["t2"].pre_cost_storage) == (2.35, 11.75, 46.9136)
    assert [got[t].type for t in ("t1", "t2", "t3")] == ["table", "external table", None]
    assert (got["t3"].size_gb, got["t3"].pre_cost_storage) == (None, 0.0)
    assert got["t1"].last_modified_time == datetime.fromtimestamp(1_700_000_000)
    assert inventory.table_inventory(catalog, "2024-01-01", tables=["t2"]).count() == 1


def test_dataset_names_are_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], schemas.SCHEMATA)
    assert sorted(rows(inventory.dataset_names(df))) == [("a",), ("b",)]


ACCESS = [
    ("t1", "ds", "2024-01-02", "bio-1@x.example"),
    ("t1", "ds", "2024-01-03", "service-1@x.example"),
    ("t1", "ds", "2024-01-03", "ana@x.example"),
    ("t2", "ds", "2024-01-03", None),
    ("t3", "ds", "2024-01-03", "dash@x.example"),
    ("t4", "ds", None, "ana@x.example"),
    ("t5", None, "2024-01-03", "ana@x.example"),
    ("unlisted", "ds", "2024-01-03", "ana@x.example"),
    ("t6", "ds", "1969-12-30", "bio-1@x.example"),
]


def access_log(spark):
    return spark.createDataFrame([(t, s, d(a), e) for t, s, a, e in ACCESS], schemas.ACCESS_LOG)


def test_last_access_flags(spark):
    tables = spark.createDataFrame([(f"t{i}",) for i in range(1, 9)], "table_id string")
    got = access.last_access_flags(access_log(spark), tables, P, ["dash@x.example"], PREFIXES)
    assert got.columns == [
        "project_id", "dataset_id", "table_id", "access_date", "flag_user_sa_bio",
        "flag_user_nominal", "flag_sem_acesso", "nrows",
    ]
    assert {r[2]: r[3:7] for r in rows(got)} == {
        "t1": (d("2024-01-03"), False, True, True),
        "t2": (d("2024-01-03"), False, False, False),
        "t3": (d("2024-01-03"), False, False, False),
        "t4": (None, False, False, False),
        "t5": (d("2024-01-03"), False, False, False),
        "t6": (d("1969-12-30"), True, False, False),
    }


def test_flags_can_come_newest_first(spark):
    tables = spark.createDataFrame([(f"t{i}",) for i in range(1, 9)], "table_id string")
    got = access.last_access_flags(access_log(spark), tables, P, [], PREFIXES, newest_first=True)
    days = [r[0] for r in rows(got, "access_date") if r[0]]
    assert days == sorted(days, reverse=True)


def test_last_users(spark):
    got = access.last_users(access_log(spark), P, ["dash@x.example"], PREFIXES)
    kinds = {r[2]: r[4:] for r in rows(got)}
    assert kinds["t1"] == ("ana@x.example", "usuario nominal")
    assert kinds["t2"] == (None, "usuario nominal")
    assert kinds["t3"] == ("dash@x.example", "usuario de dash")


def test_table_details_fan_out_per_job_and_keep_idle_tables(spark):
    catalog = spark.createDataFrame(
        [(P, "ds", t, 5, 10**9, 0, 1_704_067_200_000 + 3_600_000 * 7, 1) for t in ("t1", "t2", "t9")],
        schemas.CATALOG,
    )
    tables = inventory.table_inventory(catalog, "2024-01-01")
    flags = access.last_access_flags(access_log(spark), tables, P, [], PREFIXES)
    log = job_log(spark, job("2024-01-10 12:00:00"), job("2024-01-11 12:00:00"), job("2024-01-11 12:00:00", table="tx"))
    runs = jobs.job_extract(jobs.job_costs(log, "2024-01-12"), P)
    got = inventory.table_details(tables, flags, runs)
    assert got.schema.names == schemas.DETAILS.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.DETAILS]
    assert Counter(r[0] for r in rows(got, "table_id")) == {"t1": 2, "t2": 1, "t9": 1}
    idle = got.filter("table_id = 't9'").first()
    assert (idle.data_ult_modificacao, idle.hora_ult_modificacao) == (d("2024-01-01"), "07")
    assert (idle.data_acesso, idle.flag_user_nominal, idle.executor_job) == (None, None, None)


AS_OF = "2024-01-10 18:30:00"


def test_executed_tables(spark):
    df = details(
        spark,
        detail("a", "2024-01-10 08:00:00", cost=1.004, access="2024-01-09"),
        detail("a", "2024-01-10 09:00:00", cost=2.006, access="2024-01-09"),
        detail("a", "2024-01-10 09:00:00", cost=1.0, access="2024-01-10"),  # same instant
        detail("a", "2024-01-10 09:30:00", executor="manual", cost=7.0),
        detail("free_end", "2024-01-10 08:00:00", cost=3.0),
        detail("free_end", "2024-01-10 09:00:00", cost=0.0),
        detail("null_end", "2024-01-10 09:00:00", cost=None),
        detail("other_day", "2024-01-11 00:00:00", cost=3.0),
        detail("far", "2024-01-10 09:00:00", project="other"),
        detail("nobody", "2024-01-10 09:00:00", executor=None),
    )
    got = history.executed_tables(df, AS_OF, P).select(schemas.HISTORY.names)
    last, noaccess = ts("2024-01-10 09:00:00"), ts("2024-01-10 09:30:00")
    flags = (True, False, False)
    assert counted(got) == Counter(
        [
            (P, "ds", "a", d("2024-01-10"), *flags, last, "airflow", last, 1.0, 3.01, 0.5, 2, "novo", last),
            (P, "ds", "a", d("2001-01-01"), *flags, noaccess, "manual", noaccess, 1.0, 7.0, 0.5, 1, "novo", noaccess),
        ]
    )


def test_idle_tables(spark):
    df = details(
        spark,
        detail("never", None, executor=None, cost=None),
        detail("yesterday", "2024-01-09 23:59:59", executor="airflow"),
        detail("yesterday", "2024-01-09 01:00:00", executor="airflow"),
        detail("yesterday", "2024-01-09 01:00:00", executor="manual"),
        detail("older", "2024-01-08 23:59:59"),
        detail("today", "2024-01-10 00:00:00"),
        detail("today", "2024-01-09 00:00:00"),
        detail("namesake", "2024-01-10 00:00:00", dataset="elsewhere", project="other"),
        detail("namesake", None),
        detail("unknown", None, modified=None),
        detail("far", None, project="other"),
    )
    got = history.idle_tables(df, AS_OF, P)
    assert counted(got, "table_id", "executor_job", "data_hora_execucao_job") == Counter(
        [
            ("never", "null", ts("2020-01-01 00:00:00")),
            ("yesterday", "null", ts("2024-01-09 23:59:59")),  # the last run of all executors
        ]
    )
    one = got.filter("table_id = 'never'").first()
    assert (one.custo_query, one.custo_storage, one.qtde_execucao) == (5.0, 0.5, 0)
    assert (one.data_carga, one.data_ult_modificacao) == (ts(AS_OF), ts("2024-01-01 00:00:00"))


def test_history_merge_corrects_once_and_inserts_later_runs(spark):
    empty = spark.createDataFrame([], schemas.HISTORY)
    morning = details(spark, detail("a", "2024-01-10 08:00:00", cost=1.0), detail("idle", None, executor=None))
    first = stored(history.merge_history(morning, empty, AS_OF, P))
    assert counted(first, "table_id", "status", "custo_query") == Counter([("a", "novo", 1.0), ("idle", "novo", 5.0)])
    second = stored(history.merge_history(morning, first, AS_OF, P))
    assert counted(second, "table_id", "status") == Counter([("a", "atualizado"), ("idle", "atualizado")])
    third = history.merge_history(morning, second, AS_OF, P)
    assert counted(third) == counted(second)
    # The run time is a key: a later run of the same day adds a row.
    evening = morning.unionByName(details(spark, detail("a", "2024-01-10 20:00:00", cost=4.0)))
    fourth = history.merge_history(evening, second, AS_OF, P)
    assert counted(fourth, "table_id", "custo_query") == Counter([("a", 1.0), ("a", 5.0), ("idle", 5.0)])


def test_merging_several_days_at_once_equals_one_after_the_other(spark):
    df = details(
        spark,
        *[detail(t, f"2024-01-{day:02d} 0{h}:00:00", cost=float(h), executor=e)
          for t, day, h, e in [("a", 7, 1, "airflow"), ("a", 8, 2, "airflow"), ("c", 10, 3, "airflow"),
                               ("b", 9, 1, "airflow"), ("b", 9, 0, "airflow"), ("c", 10, 4, "manual")]],
        detail("never", None, executor=None, cost=None),
    )
    moments = monitor.restated_moments(AS_OF)
    assert [str(m)[:10] for m in moments] == ["2024-01-11", "2024-01-10", "2024-01-09", "2024-01-08", "2024-01-07"]
    past = stored(history.merge_history(df, spark.createDataFrame([], schemas.HISTORY), moments[2], P))
    step_by_step = past
    for moment in moments:
        step_by_step = stored(history.merge_history(df, step_by_step, moment, P))
    assert counted(history.merge_history(df, past, moments, P)) == counted(step_by_step)
    sources = monitor.restate(lambda m: history.history_source(df, m, P), AS_OF)
    assert counted(sources) == counted(history.history_source(df, moments, P))


def past_row(table, loaded, executor="airflow", query=1.5, size=2.0, storage=None, project=P):
    return (
        project, "ds", table, d("2024-01-09"), True, False, False, ts(loaded), executor, ts(loaded),
        size, query, storage, 1, "novo", ts(loaded),
    )


def test_daily_snapshot(spark):
    past = spark.createDataFrame(
        [
            past_row("t1", "2024-01-10 08:00:00"),
            past_row("t1", "2024-01-10 09:00:00", query=10.0, size=None),
            past_row("t1", "2024-01-09 09:00:00", query=None, storage=0.25),
            past_row("zz", "2024-01-09 09:00:00"),
            past_row("t1", "2024-01-09 09:00:00", project="other"),
        ],
        schemas.HISTORY,
    )
    yearly = spark.createDataFrame([(P, "ds", "t1", 12.5), (P, "ds", "t1", 7.0)], schemas.TABLE_COSTS)
    got = history.daily_snapshot(past, access_log(spark), yearly, P, [], PREFIXES)
    assert got.schema.names == schemas.SNAPSHOT.names
    columns = ("user_email", "table_id", "size_tb", "custo_query", "custo_storage", "custo_ano_bee", "data_carga")
    ten, nine, who = d("2024-01-10"), d("2024-01-09"), "ana@x.example"
    assert counted(got, *columns) == Counter(
        [(who, "t1", None, "10", "0", "12,5", ten)]
        + [(who, "t1", "2", "0", "0,25", "12,5", nine)]
        + [(None, "zz", "2", "1,5", "0", "0", nine)]
    )


def snapshot(spark, *data):
    full = [(None, None, None, P, "ds", t, ts(f"{day} 09:00:00"), "2", "1", "1", "0", d(day)) for t, day in data]
    return spark.createDataFrame(full, schemas.SNAPSHOT)


def test_active_monitor(spark):
    log = job_log(
        spark,
        job("2021-12-31 12:00:00", tb=1.0),  # before the lifetime
        job("2022-01-01 12:00:00", tb=1.0),
        job("2024-01-10 12:00:00", tb=1.0, job_id="airflow_77"),
        job("2024-01-10 12:00:00", tb=2.0, job_id="job"),  # same instant: the dearer one
        job("2024-01-10 13:00:00", tb=0.1, job_id="airflow_77"),
        job("2024-01-10 14:00:00", tb=0.0),  # free
        job("2024-01-11 02:59:59", tb=0.0, job_id="free"),
        job("2024-01-11 12:00:00", tb=1.0),  # after the day
        job("2024-01-10 12:00:00", tb=1.0, table="anon123"),  # kept: no anonymous filter here
    )
    shot = snapshot(spark, ("t1", "2024-01-10"), ("t1", "2024-01-09"), ("quiet", "2024-01-10"), ("anon123", "2024-01-10"))
    got = {r.table_id: r for r in monitor.monitor_source(log, shot, ["2024-01-10"]).collect()}
    assert set(got) == {"t1", "quiet", "anon123"}
    one = got["t1"]
    assert (one.qtde_execucao, one.custo_hist, one.custo_query_execucao_job) == (3, "15,5", "5,17")
    assert one.pri_data_hora_execucao_job == ts("2022-01-01 09:00:00")
    assert (one.qtde_execucao_dia, one.custo_dia, one.custo_query_execucao_dia) == (2, "10,5", "5,25")
    assert (one.executor_job_dia, one.ulti_data_hora_execucao_job_dia) == ("airflow", ts("2024-01-10 10:00:00"))
    quiet = got["quiet"]
    assert (quiet.qtde_execucao, quiet.custo_hist, quiet.executor_job_dia, quiet.custo_dia) == (None, "0", None, "0")
    assert got["anon123"].qtde_execucao_dia == 1


def test_monitor_merge_keeps_lifetime_figures(spark):
    log = job_log(spark, job("2024-01-10 12:00:00", tb=1.0))
    shot = snapshot(spark, ("t1", "2024-01-10"))
    first = monitor.merge_active_tables(log, shot, spark.createDataFrame([], schemas.MONITOR), "2024-01-10")
    more = log.unionByName(job_log(spark, job("2024-01-10 13:00:00", tb=1.0)))
    second = monitor.merge_active_tables(more, shot, first, "2024-01-10").collect()
    assert [(r.qtde_execucao, r.qtde_execucao_dia, r.custo_hist, r.custo_dia) for r in second] == [(1, 2, "5", "10")]


def test_restating_the_monitor_equals_single_days(spark):
    log = job_log(
        spark, *[job(f"2024-01-{day:02d} {h:02d}:00:00", tb=h / 10) for day in range(5, 13) for h in range(8, 12)]
    )
    shot = snapshot(spark, *[("t1", f"2024-01-{day:02d}") for day in range(6, 12)])
    moments = monitor.restated_moments("2024-01-10")
    target = spark.createDataFrame([], schemas.MONITOR)
    step_by_step = target
    for moment in moments:
        step_by_step = stored(monitor.merge_active_tables(log, shot, step_by_step, moment))
    assert counted(monitor.merge_active_tables(log, shot, target, moments)) == counted(step_by_step)


def test_clock_and_instant_logs_give_the_same_costs(spark):
    log = job_log(spark, job("2024-01-10 02:00:00"), job("2024-01-10 03:00:00"), job("2024-01-12 12:00:00"))
    clock = log.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})
    assert counted(jobs.job_costs(log, "2024-01-20"), "job_id", "start_time") == counted(
        jobs.job_costs(clock, "2024-01-20"), "job_id", "start_time"
    )
